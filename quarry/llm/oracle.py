"""DuckDB SQL of the training-data queries that SQL can express: operators 1,
4, 6 and 10 to 13.  The others rest on trained models, random keys or token merges
and are tested against brute force in ``tests/llm``."""

from __future__ import annotations

from quarry.llm.quality_rules import STOP_WORDS

SQL: dict[str, str] = {}

SPACES = r"[\x20\x09-\x0D]"
WORDS = r"""texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
listed AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM listed)"""

SQL["op1_pivot_permutation"] = """WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT m.vec_id, coalesce(l.n, 0) AS n_links, least(m.vec_id, coalesce(r.c, m.vec_id)) AS component_id,
  m.vec_id <= coalesce(r.c, m.vec_id) AS kept
FROM embeddings m LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = m.vec_id
LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = m.vec_id"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL["op4_quality_rules"] = rf"""WITH {WORDS},
windows AS (SELECT doc_id, pos, string_agg(word, ' ') OVER f AS k, count(*) OVER f AS n FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
twice AS (SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows WHERE n = 5)
  WHERE c > 1),
covered AS (SELECT doc_id, CAST(sum(least(5, coalesce(next - pos, 5))) AS BIGINT) AS n FROM (
  SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM twice) GROUP BY doc_id),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM listed),
measured AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{SPACES}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, len(l) AS n_lines,
    len(list_filter(w, lambda x: lower(trim(x, '.,;:!?"''()[]')) IN ({_STOP}))) AS n_stop,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…){SPACES}*$'))) AS n_ellipsis,
    len(list_filter(l, lambda x: regexp_matches(x, '^{SPACES}*[-*•]'))) AS n_bullets
  FROM lined d LEFT JOIN covered c ON c.doc_id = d.doc_id),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  greatest(n_words, 1) AS per_word, greatest(n_lines, 1) AS per_line FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / per_word BETWEEN 3 AND 10 AND n_symbols / per_word <= 0.1
  AND n_alpha / per_word >= 0.8 AND n_upper / greatest(word_chars, 1) <= 0.3 AND n_stop >= 2
  AND n_stop / per_word >= 0.05 AND n_dup_lines / per_line <= 0.3 AND n_ellipsis / per_line <= 0.3
  AND n_bullets / per_line <= 0.9 AS kept
FROM based"""

SQL["op6_substring_dedup"] = f"""WITH {WORDS},
windows AS (SELECT doc_id, pos, string_agg(word, ' ') OVER f AS k, count(*) OVER f AS n FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
later AS (SELECT doc_id, pos, 1 AS hit FROM (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS r FROM windows WHERE n = 20) WHERE r > 1),
marked AS (SELECT w.doc_id, w.pos, w.word, max(coalesce(l.hit, 0)) OVER (PARTITION BY w.doc_id ORDER BY w.pos
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM words w LEFT JOIN later l ON l.doc_id = w.doc_id AND l.pos = w.pos),
summed AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone = 1) AS removed,
  string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_words, coalesce(s.removed, 0) AS n_removed,
  sha256(coalesce(s.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN summed s ON s.doc_id = d.doc_id"""

_ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '<\|')"
SQL["op10_chat_formatting"] = rf"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
joined AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS body,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(length('<|im_start|>') + length(replace({_ESCAPED.format('role')}, chr(10), '<\/')) + 1
        + length({_ESCAPED.format('text')}) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(body) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM joined"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL["op11_line_dedup"] = f"""WITH listed AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM listed),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS k FROM lines),
common AS (SELECT k AS c FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON k = c GROUP BY doc_id"""

_TERMS = f"""regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
SQL["op12_best_position"] = f"""WITH d AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS l FROM n),
m AS (SELECT doc_id, 100 - 50 + (50 * n * big_n) // l AS m FROM n, s),
f AS (SELECT doc_id, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM f, s GROUP BY t),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50"""

SQL["op13_hard_negatives"] = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.a, p.b, p.s, n.b AS nb, n.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS r
  FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s)
SELECT a AS anchor_id, b AS positive_id, CAST(r AS INTEGER) AS rank, nb AS negative_id, s AS positive_score,
  ns AS negative_score FROM n WHERE r <= 3"""
