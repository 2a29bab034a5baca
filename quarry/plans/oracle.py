"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark code but uses the same fixed
patterns (``quarry.functions.text``) and the same exact-rounding arithmetic
(integer division for averages, fixed-point sums for scores), so both
engines produce identical values.  Views ``documents``, ``embeddings``,
``benchmark`` ... are registered by the caller.
"""

from __future__ import annotations

from quarry.functions.text import (CAMEL_BOUNDARY, MAX_CODE_CHARS, PREVIEW_LIMIT,
                                   SUBTOKEN_SEPARATOR, TOKEN_PATTERN, TRUNCATED_CODE_SUFFIX,
                                   UNKNOWN_FUNCTION, WHITESPACE_CLASS)

DBL = "CAST({} AS DOUBLE)".format
SCALE = 1_000_000_000


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_text(s: str) -> str:
    """SQL expression for a literal that may hold newlines."""
    parts = s.split("\n")
    return " || chr(10) || ".join(q(p) for p in parts) if len(parts) > 1 else q(s)


WS = WHITESPACE_CLASS + "+"


def normalize_ws(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, {q(WS)}, ' ', 'g'), "
            f"{q('^ +| +\\z')}, '', 'g')")


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '|' + WS + '\\z')}, '', 'g')"


def subtokens(x: str) -> str:
    spaced = (f"regexp_replace(regexp_replace({x}, {q(SUBTOKEN_SEPARATOR)}, ' ', 'g'), "
              f"{q(CAMEL_BOUNDARY)}, '\\1 \\2', 'g')")
    return f"list_filter(string_split({spaced}, ' '), lambda p: p <> '')"


def tokenize(x: str) -> str:
    parts = subtokens("m")
    return (f"flatten(list_transform(regexp_extract_all({x}, {q(TOKEN_PATTERN)}), "
            f"lambda m: CASE WHEN len({parts}) > 0 THEN list_transform({parts}, lambda p: lower(p)) "
            f"ELSE [lower(m)] END))")


def blank_null(x: str) -> str:
    return f"nullif({x}, '')"


def to_fixed(x: str) -> str:
    return f"CAST(floor(({x}) * {DBL(SCALE)} + 0.5) AS BIGINT)"


def from_fixed(x: str, digits: int = 6) -> str:
    step = SCALE // 10 ** digits
    return f"(floor((({x}) + {step // 2}) / {DBL(step)}) / {DBL(10 ** digits)})"


def round6(x: str) -> str:
    return from_fixed(to_fixed(x))


def round_ratio(a: str, b: str, digits: int) -> str:
    p = 10 ** digits
    a, b = f"CAST(({a}) AS BIGINT)", f"CAST(({b}) AS BIGINT)"
    return f"((({2 * p} * {a} + {b}) // (2 * {b})) / {DBL(p)})"


def document_text(name: str, doc: str, code: str) -> str:
    return f"concat_ws(chr(10) || chr(10), {blank_null(name)}, {blank_null(doc)}, {blank_null(code)})"


# --- common table expressions ------------------------------------------------

RAW = f"""raw AS (
  SELECT doc_id AS id,
         CASE ((doc_id % 20) + 20) % 20 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END AS split,
         concat_ws('_', source, lang) AS func_name,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END
           AS func_code_string,
         text AS whole_func_string, doc_id AS ordinal,
         split_part(text, chr(10), 1) AS func_documentation_string,
         lang AS language, source AS repository_name,
         printf('%s/%s/%d.py', source, lang, doc_id) AS func_path_in_repository,
         printf('repo://%s/blob/main/%s/%d.py', source, lang, doc_id) AS func_code_url
  FROM documents)"""

STAGED = f"""staged AS (
  SELECT id, split,
         {strip("coalesce(func_name, '')")} AS func_name,
         {normalize_ws("coalesce(" + blank_null("func_documentation_string") + ", '')")} AS docstring,
         {strip("coalesce(" + blank_null("func_code_string") + ", " + blank_null("whole_func_string") + ", '')")} AS code,
         language, repository_name, func_path_in_repository, func_code_url, ordinal
  FROM raw)"""

PREPARED = f"""tokd AS (
  SELECT *, {tokenize("func_name")} || {tokenize("docstring")} || {tokenize("code")} AS tokens
  FROM staged),
prepared AS (
  SELECT *, CASE WHEN func_name = '' THEN 'missing_name' WHEN code = '' THEN 'missing_code'
                 WHEN len(tokens) = 0 THEN 'empty_lexical' END AS drop_reason
  FROM tokd)"""

DOCS = f"""docs AS (
  SELECT id, split, func_name, docstring, code,
         {document_text("func_name", "docstring", "code")} AS document_text,
         array_to_string(tokens, ' ') AS lexical_document,
         CAST(len(tokens) AS BIGINT) AS lexical_token_count,
         length(docstring) > 0 AS has_docstring, ordinal
  FROM prepared WHERE drop_reason IS NULL)"""

INDEX = f"""idx_docs AS (
  SELECT id AS doc_id, split, func_name, string_split(lexical_document, ' ') AS toks
  FROM docs WHERE lexical_document <> ''),
idx_documents AS (
  SELECT doc_id, split, func_name, CAST(len(toks) AS BIGINT) AS lexical_token_count FROM idx_docs),
postings AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS term_frequency, any_value(dl) AS doc_length
  FROM (SELECT doc_id, CAST(len(toks) AS BIGINT) AS dl, unnest(toks) AS term FROM idx_docs)
  GROUP BY doc_id, term),
totals AS (
  SELECT CAST(count(*) AS BIGINT) AS document_count,
         CAST(coalesce(sum(lexical_token_count), 0) AS BIGINT) AS total_token_count
  FROM idx_documents),
vocab AS (
  SELECT term, CAST(count(*) AS BIGINT) AS document_frequency,
         CAST(sum(term_frequency) AS BIGINT) AS collection_frequency,
         ln(1.0 + ((SELECT {DBL("document_count")} FROM totals) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
  FROM postings GROUP BY term),
stats AS (
  SELECT document_count, total_token_count,
         {round_ratio("total_token_count", "greatest(document_count, 1)", 4)} AS average_document_length,
         (SELECT CAST(count(*) AS BIGINT) FROM vocab) AS vocabulary_size,
         {DBL(1.5)} AS k1, {DBL(0.75)} AS b
  FROM totals)"""

QUERIES = f"""queries AS (
  SELECT id AS query_id, {strip("docstring")} AS query_text, id AS relevant_doc_id, func_name, ordinal
  FROM docs WHERE split = 'test' AND {strip("docstring")} <> '')"""


def bm25_ctes(name: str, queries_cte: str, depth: int) -> str:
    """CTEs ``{name}_scores`` (query_id, doc_id, score_fp) and ``{name}``
    (query_id, rank, doc_id, score, score_fp) for a queries CTE with
    (query_id, query_text)."""
    impact = ("v.idf * (p.term_frequency * (s.k1 + 1.0)) / "
              "(p.term_frequency + s.k1 * (1.0 - s.b + s.b * p.doc_length / s.average_document_length))")
    return f"""{name}_terms AS (
  SELECT DISTINCT query_id, unnest(list_distinct({tokenize("coalesce(query_text, '')")})) AS term
  FROM {queries_cte}),
{name}_scores AS (
  SELECT t.query_id, p.doc_id, CAST(sum({to_fixed(impact)}) AS BIGINT) AS score_fp
  FROM {name}_terms t JOIN vocab v ON v.term = t.term JOIN postings p ON p.term = t.term
       CROSS JOIN stats s
  GROUP BY t.query_id, p.doc_id),
{name} AS (
  SELECT query_id, rank, doc_id, {from_fixed("score_fp")} AS score, score_fp FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score_fp DESC, doc_id ASC) AS rank
    FROM {name}_scores) WHERE rank <= {depth})"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (RAW, STAGED, PREPARED, DOCS)
INDEXED = BASE + (INDEX,)
EVAL = INDEXED + (QUERIES, bm25_ctes("bm25", "queries", 50))

PER_QUERY = """SELECT q.query_id, r.rank AS relevant_rank,
       CASE WHEN r.rank <= 10 THEN CAST(1.0 AS DOUBLE) / r.rank ELSE 0.0 END AS rr_at_10,
       CASE WHEN r.rank <= 10 THEN 1.0 ELSE 0.0 END AS recall_at_10,
       CASE WHEN r.rank <= 50 THEN 1.0 ELSE 0.0 END AS recall_at_50,
       CASE WHEN r.rank <= 10 THEN CAST(1.0 AS DOUBLE) / log2(r.rank + 1) ELSE 0.0 END AS ndcg_at_10
FROM {queries} q LEFT JOIN {ranking} r ON r.query_id = q.query_id AND r.doc_id = q.relevant_doc_id"""


def metrics_select(per_query: str) -> str:
    n = "greatest(count(*), 1)"
    return f"""SELECT CAST(count(*) AS BIGINT) AS query_count,
       {round6(f"CAST(sum(rr_at_10) AS DOUBLE) / {n}")} AS mrr_at_10,
       {round6(f"CAST(sum(recall_at_10) AS DOUBLE) / {n}")} AS recall_at_10,
       {round6(f"CAST(sum(recall_at_50) AS DOUBLE) / {n}")} AS recall_at_50,
       {round6(f"CAST(sum(ndcg_at_10) AS DOUBLE) / {n}")} AS ndcg_at_10
FROM ({per_query})"""


def dot(a: str, b: str) -> str:
    """Left fold of the element products, in index order (as in Spark)."""
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), "
            f"lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)), lambda x, y: x + y)")


def l2_normalize(v: str) -> str:
    n = f"greatest(sqrt(list_reduce(list_transform({v}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda x, y: x + y)), {DBL('1e-12')})"
    return f"list_transform({v}, lambda x: CAST(x AS DOUBLE) / {n})"


HEX = "'0123456789abcdef'"


def explode_vector(src: str, key: str, vec: str) -> str:
    return (f"SELECT {key}, CAST(unnest(range(0, len({vec}))) AS BIGINT) AS dim, "
            f"unnest(list_transform({vec}, lambda x: {round6('x')})) AS value FROM {src}")


def per_query(queries: str, ranking: str) -> str:
    return PER_QUERY.format(queries=queries, ranking=ranking)


def hashed_units(term: str) -> str:
    """The 64 integer components ``2 * byte - 255`` of a token's md5 digests."""
    hx = " || ".join(f"md5('{s}:' || {term})" for s in range(4))
    byte = (f"((instr({HEX}, substr(hx, 2 * j + 1, 1)) - 1) * 16 + "
            f"(instr({HEX}, substr(hx, 2 * j + 2, 1)) - 1))")
    return f"(SELECT list_transform(range(64), lambda j: CAST({byte} AS BIGINT) * 2 - 255) FROM (SELECT {hx} AS hx))"


def hashed_vectors(name: str, src: str, key: str, term: str, weight: str) -> str:
    """CTEs ``{name}`` (key, embedding): per-key exact integer sums of the
    weighted components, as a list in dimension order, L2-normalised."""
    return f"""{name}_u AS (
  SELECT {key} AS k, CAST({weight} AS BIGINT) AS w, {hashed_units(term)} AS u FROM {src}),
{name}_s AS (
  SELECT k, dim, sum(u[dim + 1] * w) AS s
  FROM (SELECT k, w, u, unnest(range(64)) AS dim FROM {name}_u) GROUP BY k, dim),
{name} AS (
  SELECT k AS {key}, {l2_normalize("v")} AS embedding
  FROM (SELECT k, list(CAST(s AS DOUBLE) ORDER BY dim) AS v FROM {name}_s GROUP BY k))"""


def _hashed_docs() -> str:
    return hashed_vectors("hashed_docs", "postings", "doc_id", "term", "term_frequency")


def hashed_queries(name: str, src: str) -> str:
    toks = tokenize("coalesce(query_text, '')")
    return f"""{name}_tok AS (
  SELECT query_id, unnest({toks}) AS tok FROM {src}),
""" + hashed_vectors(name, f"{name}_tok", "query_id", "tok", "1")


def rerank_ctes(name: str, cands: str, qvecs: str, dvecs: str, depth: int) -> str:
    """``{name}`` (query_id, rank, doc_id, score, bm25_score) from candidates
    (query_id, doc_id, score_fp), query vectors (query_id, embedding) and doc
    vectors (doc_id, embedding)."""
    cos = f"CASE WHEN dv.embedding IS NULL OR qv.embedding IS NULL THEN {DBL(-2.0)} ELSE {dot('qv.embedding', 'dv.embedding')} END"
    return f"""{name}_scored AS (
  SELECT c.query_id, c.doc_id, c.score_fp, {to_fixed(cos)} AS cos_fp
  FROM {cands} c LEFT JOIN {qvecs} qv ON qv.query_id = c.query_id
       LEFT JOIN {dvecs} dv ON dv.doc_id = c.doc_id),
{name} AS (
  SELECT query_id, rank, doc_id, {from_fixed("cos_fp")} AS score, {from_fixed("score_fp")} AS bm25_score
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cos_fp DESC, score_fp DESC, doc_id) AS rank
        FROM {name}_scored) WHERE rank <= {depth})"""


STORED = """vectors AS (
  SELECT d.id AS doc_id, e.embedding FROM docs d JOIN embeddings e ON e.vec_id = d.id
  UNION ALL
  SELECT doc_id, list_transform(embedding, lambda x: CAST(x AS FLOAT)) FROM hashed_docs
  WHERE doc_id NOT IN (SELECT vec_id FROM embeddings))"""

# one encoder on both sides; stored vectors are float32, and so are those encoded on a miss beside them
ONE_ENCODER = """vectors AS (
  SELECT doc_id, list_transform(embedding, lambda x: CAST(x AS FLOAT)) AS embedding FROM hashed_docs)"""

DENSE = EVAL + (_hashed_docs(), hashed_queries("hq", "queries"), ONE_ENCODER,
                rerank_ctes("rr", "bm25", "hq", "vectors", 50))

BENCH_Q = "bench_q AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"
CONV_Q = ("conv_q AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS query_id, "
          "text AS query_text FROM conversations)")


def preview(x: str, limit: int = PREVIEW_LIMIT) -> str:
    flat = normalize_ws(f"coalesce({x}, '')")
    return f"CASE WHEN length({flat}) <= {limit} THEN {flat} ELSE substr({flat}, 1, {limit - 3}) || '...' END"


def truncate_code(x: str, limit: int = MAX_CODE_CHARS) -> str:
    c = f"coalesce({x}, '')"
    return f"CASE WHEN length({c}) <= {limit} THEN {c} ELSE substr({c}, 1, {limit}) || {sql_text(TRUNCATED_CODE_SUFFIX)} END"


LOOKUP = """lookup AS (
  SELECT d.*, nullif(m.repository_name, '') AS repository_name,
         nullif(m.func_path_in_repository, '') AS func_path_in_repository,
         nullif(m.func_code_url, '') AS func_code_url, nullif(m.language, '') AS language
  FROM docs d LEFT JOIN meta m ON m.id = d.id)"""
META = """meta AS (
  SELECT id, split, language, repository_name, func_path_in_repository, func_name, func_code_url
  FROM prepared WHERE drop_reason IS NULL)"""

STATS_SQL = f"""split_stats AS (
  SELECT *, {round_ratio("document_char_total", "greatest(kept_records, 1)", 2)} AS document_char_avg,
         {round_ratio("lexical_token_total", "greatest(kept_records, 1)", 2)} AS lexical_token_avg,
         {round_ratio("docstring_char_total", "greatest(kept_records, 1)", 2)} AS docstring_char_avg,
         {round_ratio("records_without_docstring", "greatest(kept_records, 1)", 4)} AS missing_docstring_rate
  FROM (
    SELECT split, count(*) AS raw_records,
           count(*) FILTER (WHERE drop_reason IS NULL) AS kept_records,
           count(*) FILTER (WHERE drop_reason = 'missing_name') AS dropped_missing_name,
           count(*) FILTER (WHERE drop_reason = 'missing_code') AS dropped_missing_code,
           count(*) FILTER (WHERE drop_reason = 'empty_lexical') AS dropped_empty_lexical,
           count(*) FILTER (WHERE drop_reason IS NULL AND length(docstring) > 0) AS records_with_docstring,
           count(*) FILTER (WHERE drop_reason IS NULL AND length(docstring) = 0) AS records_without_docstring,
           CAST(coalesce(sum(length({document_text("func_name", "docstring", "code")})) FILTER (WHERE drop_reason IS NULL), 0) AS BIGINT) AS document_char_total,
           CAST(coalesce(sum(len(tokens)) FILTER (WHERE drop_reason IS NULL), 0) AS BIGINT) AS lexical_token_total,
           CAST(coalesce(sum(length(docstring)) FILTER (WHERE drop_reason IS NULL), 0) AS BIGINT) AS docstring_char_total
    FROM prepared GROUP BY split))"""


ORACLE: dict[str, str] = {}

ORACLE["q_normalize_ws"] = f"SELECT doc_id, {normalize_ws('text')} AS normalized FROM documents"

ORACLE["q_split_identifier"] = f"""SELECT doc_id, CAST(len(p) AS BIGINT) AS piece_count,
  array_to_string(p, ' ') AS pieces FROM (SELECT doc_id, {subtokens('text')} AS p FROM documents)"""

ORACLE["q_tokenize"] = f"""SELECT doc_id, CAST(unnest(range(1, len(t) + 1)) AS BIGINT) AS pos, unnest(t) AS token
FROM (SELECT doc_id, {tokenize('text')} AS t FROM documents)"""

ORACLE["q_document_text"] = with_ctes(*BASE) + \
    f"SELECT id, {document_text('func_name', 'docstring', 'code')} AS document_text FROM prepared"

ORACLE["q_preview"] = f"SELECT doc_id, {preview('text')} AS text_preview FROM documents"

ORACLE["q_documents"] = with_ctes(*BASE) + "SELECT * FROM docs"

ORACLE["q_metadata"] = with_ctes(*BASE, META) + "SELECT * FROM meta"

# what the records made from labels lack, beside those of documents
FLAWED = """flawed AS (SELECT id, split, drop_reason FROM prepared UNION ALL
  SELECT doc_id, CASE ((doc_id % 20) + 20) % 20 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END,
    CASE WHEN quality IS DISTINCT FROM 1 THEN 'missing_name' WHEN toxic = 1 THEN 'missing_code'
         WHEN doc_id % 2 <> 0 THEN 'empty_lexical' END FROM labels)"""

ORACLE["q_rejected_records"] = with_ctes(*BASE, FLAWED) + \
    "SELECT id, split, drop_reason FROM flawed WHERE drop_reason IS NOT NULL"

ORACLE["q_drop_reasons"] = with_ctes(*BASE, FLAWED) + """SELECT split, drop_reason, count(*) AS n_records
FROM flawed WHERE drop_reason IS NOT NULL GROUP BY split, drop_reason"""

ORACLE["q_corpus_stats"] = with_ctes(*BASE, STATS_SQL) + """SELECT s.*,
  (SELECT CAST(sum(kept_records) AS BIGINT) FROM split_stats) AS total_kept_records FROM split_stats s"""

ORACLE["q_length_histogram"] = with_ctes(*BASE) + """SELECT split,
  printf('%04d-%04d', CAST(floor(lexical_token_count / 50) * 50 AS BIGINT),
         CAST(floor(lexical_token_count / 50) * 50 + 49 AS BIGINT)) AS bucket,
  count(*) AS n_documents
FROM docs GROUP BY ALL"""

ORACLE["q_postings"] = with_ctes(*INDEXED) + "SELECT doc_id, term, term_frequency FROM postings"

ORACLE["q_vocabulary"] = with_ctes(*INDEXED) + f"""SELECT term, document_frequency,
  collection_frequency, {round6("idf")} AS idf FROM vocab"""

ORACLE["q_index_stats"] = with_ctes(*INDEXED) + "SELECT * FROM stats"

ORACLE["q_index_stats_kv"] = with_ctes(*INDEXED) + """SELECT 'document_count' AS key, CAST(to_json(document_count) AS VARCHAR) AS value FROM stats
UNION ALL SELECT 'average_document_length', CAST(to_json(average_document_length) AS VARCHAR) FROM stats
UNION ALL SELECT 'vocabulary_size', CAST(to_json(vocabulary_size) AS VARCHAR) FROM stats
UNION ALL SELECT 'total_token_count', CAST(to_json(total_token_count) AS VARCHAR) FROM stats
UNION ALL SELECT 'bm25_parameters', CAST(to_json({'k1': k1, 'b': b}) AS VARCHAR) FROM stats"""

ORACLE["q_queries"] = with_ctes(*BASE, QUERIES) + "SELECT * FROM queries"

ORACLE["q_bm25_scores"] = with_ctes(*EVAL) + \
    f"SELECT query_id, doc_id, {from_fixed('score_fp')} AS score FROM bm25_scores"

ORACLE["q_bm25_topk"] = with_ctes(*EVAL) + "SELECT query_id, rank, doc_id, score FROM bm25"

# pruning must not change a single row: same SQL as the exhaustive ranking
ORACLE["q_bm25_topk_pruned"] = ORACLE["q_bm25_topk"]

ORACLE["q_bm25_per_query"] = with_ctes(*EVAL) + f"""SELECT query_id, relevant_rank,
  {round6("rr_at_10")} AS rr_at_10, {round6("recall_at_10")} AS recall_at_10,
  {round6("recall_at_50")} AS recall_at_50, {round6("ndcg_at_10")} AS ndcg_at_10
FROM ({per_query("queries", "bm25")})"""

ORACLE["q_bm25_metrics"] = with_ctes(*EVAL) + metrics_select(per_query("queries", "bm25"))

ORACLE["q_sample_rankings"] = with_ctes(*EVAL) + """SELECT f.query_id, f.func_name, f.query_text,
  r.rank, r.doc_id, r.score
FROM (SELECT query_id, func_name, query_text FROM queries ORDER BY ordinal, query_id LIMIT 5) f
LEFT JOIN (SELECT * FROM bm25 WHERE rank <= 5) r ON r.query_id = f.query_id"""

ORACLE["q_adhoc_search"] = with_ctes(*INDEXED, BENCH_Q, bm25_ctes("adhoc", "bench_q", 10)) + \
    "SELECT query_id, rank, doc_id, score FROM adhoc"

ORACLE["q_conversation_search"] = with_ctes(*INDEXED, CONV_Q, bm25_ctes("conv", "conv_q", 10)) + \
    "SELECT query_id, rank, doc_id, score FROM conv"

EXAMPLES = f"""ex_cands AS (
  SELECT d.id AS query_id, {strip("d.docstring")} AS query_text, d.ordinal AS line_no
  FROM docs d
  WHERE d.split = 'test' AND {strip("d.docstring")} <> '' AND length({strip("d.docstring")}) <= 150
    AND strpos({strip("d.docstring")}, chr(10)) = 0),
{bm25_ctes("probe", "ex_cands", 1)},
ex_hits AS (
  SELECT c.query_text, c.line_no, c.query_id FROM ex_cands c JOIN probe p ON p.query_id = c.query_id
  WHERE p.doc_id = c.query_id),
ex_first AS (
  SELECT query_text, min(line_no) AS line_no, arg_min(query_id, line_no) AS doc_id
  FROM ex_hits GROUP BY query_text),
chosen AS (
  SELECT CAST(row_number() OVER (ORDER BY line_no) AS BIGINT) AS example_rank, query_text, doc_id
  FROM (SELECT * FROM ex_first ORDER BY line_no LIMIT 8))"""
FALLBACK = " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS BIGINT), {q(t)}, CAST(NULL AS BIGINT)"
    for i, t in enumerate(("read a json file and return a dict", "establish an ssh connection",
                           "compute the sha256 hash of a string", "split a list into chunks of size n",
                           "download a url and save to disk", "parse an iso 8601 timestamp")))
ORACLE["q_examples"] = with_ctes(*INDEXED, EXAMPLES) + f"""SELECT * FROM chosen
UNION ALL SELECT * FROM ({FALLBACK}) WHERE (SELECT count(*) FROM chosen) = 0"""

ORACLE["q_l2_normalize"] = explode_vector(
    f"(SELECT vec_id AS doc_id, {l2_normalize('embedding')} AS e FROM embeddings)", "doc_id", "e")

ORACLE["q_cosine"] = with_ctes(*DENSE) + f"""SELECT c.query_id, c.doc_id,
  {round6(dot("qv.embedding", "v.embedding"))} AS cosine
FROM bm25 c JOIN hq qv ON qv.query_id = c.query_id JOIN vectors v ON v.doc_id = c.doc_id"""

ORACLE["q_mean_pool"] = with_ctes(*INDEXED, _hashed_docs()) + explode_vector(
    "hashed_docs", "doc_id", "embedding")

ORACLE["q_rerank_topk"] = with_ctes(*DENSE) + "SELECT * FROM rr"

ORACLE["q_rerank_metrics"] = with_ctes(*DENSE) + metrics_select(per_query("queries", "rr"))

HASHED = EVAL + (_hashed_docs(), hashed_queries("hq", "queries"),
                 rerank_ctes("hrr", "bm25", "hq", "hashed_docs", 50))

ORACLE["q_rerank_hashed_topk"] = with_ctes(*HASHED) + "SELECT * FROM hrr"

ORACLE["q_rerank_hashed_metrics"] = with_ctes(*HASHED) + metrics_select(per_query("queries", "hrr"))

METRIC_ROWS = (("query_count", "Queries evaluated"), ("mrr_at_10", "MRR@10"),
               ("recall_at_10", "Recall@10"), ("recall_at_50", "Recall@50"),
               ("ndcg_at_10", "nDCG@10"))


def _metrics_long(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS metric, CAST({k} AS DOUBLE) AS value FROM {src}" for k, _ in METRIC_ROWS)


ORACLE["q_metrics_table"] = with_ctes(
    *DENSE,
    f"m_bm25 AS ({metrics_select(per_query('queries', 'bm25'))})",
    f"m_rr AS ({metrics_select(per_query('queries', 'rr'))})",
    "names AS (" + " UNION ALL ".join(
        f"SELECT '{k}' AS metric, '{label}' AS label, CAST({i} AS INTEGER) AS position"
        for i, (k, label) in enumerate(METRIC_ROWS)) + ")",
) + f"""SELECT n.metric, n.label, n.position, b.value AS bm25, r.value AS rerank
FROM names n FULL OUTER JOIN ({_metrics_long("m_bm25")}) b ON b.metric = n.metric
FULL OUTER JOIN ({_metrics_long("m_rr")}) r ON r.metric = n.metric"""

ORACLE["q_compare_pipelines"] = with_ctes(
    *INDEXED, BENCH_Q,
    "cmp_q AS (SELECT * FROM bench_q WHERE " + strip("coalesce(query_text, '')") + " <> '')",
    bm25_ctes("cmp", "cmp_q", 50), _hashed_docs(), hashed_queries("cmp_qv", "cmp_q"),
    rerank_ctes("cmp_rr", "cmp", "cmp_qv", "hashed_docs", 10),
    """cmp_both AS (
  SELECT query_id, 'bm25' AS pipeline, rank, doc_id, score, score AS bm25_score FROM cmp WHERE rank <= 10
  UNION ALL SELECT query_id, 'rerank', rank, doc_id, score, bm25_score FROM cmp_rr)""",
) + """SELECT b.*, h.bm25_hits, c.shown, CAST(NULL AS VARCHAR) AS rerank_error FROM cmp_both b
JOIN (SELECT query_id, count(*) AS bm25_hits FROM cmp GROUP BY query_id) h ON h.query_id = b.query_id
JOIN (SELECT query_id, pipeline, count(*) AS shown FROM cmp_both GROUP BY ALL) c
  ON c.query_id = b.query_id AND c.pipeline = b.pipeline"""

ORACLE["q_dense_summary"] = with_ctes(*DENSE) + f"""SELECT d.split, count(*) AS documents,
  count(v.doc_id) AS vectors, CAST(max(len(v.embedding)) AS BIGINT) AS embedding_dimension,
  CASE WHEN d.split = 'test' THEN (SELECT count(*) FROM queries q JOIN hq ON hq.query_id = q.query_id) ELSE 0 END
    AS queries_with_vector
FROM docs d LEFT JOIN vectors v ON v.doc_id = d.id WHERE {strip("d.document_text")} <> '' GROUP BY d.split"""

ORACLE["q_encode_on_miss"] = with_ctes(*INDEXED, _hashed_docs(), STORED) + explode_vector(
    "vectors", "doc_id", "embedding")

# one, two or three tokens may count: the sum in token order over their number
_TOKENS = ("e[i]", "e[len(e) + 1 - i]", "-e[i]")
_POOLED = " + ".join(f"CASE WHEN e[{k + 1}] > 0 THEN {t} ELSE 0.0 END" for k, t in enumerate(_TOKENS))
_COUNTED = " + ".join(f"CASE WHEN e[{k + 1}] > 0 THEN 1 ELSE 0 END" for k in range(3))
ORACLE["q_masked_mean_pool"] = explode_vector(
    f"""(SELECT vec_id AS doc_id, list_transform(range(1, len(e) + 1),
          lambda i: ({_POOLED}) / greatest(CAST({_COUNTED} AS DOUBLE), {DBL('1e-9')})) AS p
        FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings))""",
    "doc_id", "p")

ORACLE["q_latest_turn"] = """SELECT conv_id, role, text, turn AS last_turn FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1"""

ORACLE["q_vector_sink"] = explode_vector(
    f"(SELECT vec_id AS doc_id, list_transform({l2_normalize('embedding')}, lambda x: CAST(x AS FLOAT)) AS e "
    "FROM embeddings)", "doc_id", "e")

ORACLE["q_max_queries"] = with_ctes(*BASE, QUERIES) + "SELECT * FROM queries ORDER BY ordinal, query_id LIMIT 20"

ORACLE["q_evaluation_run"] = with_ctes(*EVAL) + f"""SELECT m.*, (SELECT document_count FROM stats) AS document_count,
  f.query_id, r.rank, r.doc_id, r.score
FROM (SELECT query_id FROM queries ORDER BY ordinal, query_id LIMIT 5) f
JOIN bm25 r ON r.query_id = f.query_id AND r.rank <= 5
CROSS JOIN ({metrics_select(per_query("queries", "bm25"))}) m"""

ORACLE["q_postings_lookup"] = with_ctes(*INDEXED) + """SELECT term, doc_id, term_frequency FROM postings
WHERE term IN ('the', 'und', 'que')"""

ORACLE["q_jsonl_records"] = with_ctes(RAW) + """SELECT split || '-' || CAST(n AS VARCHAR) AS id, split, n AS ordinal,
  func_name, func_code_url, md5(whole_func_string) AS text_md5
FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY ordinal) AS n FROM raw)"""

ORACLE["q_document_lookup"] = with_ctes(*BASE, META, LOOKUP) + "SELECT * FROM lookup"

ORACLE["q_result_cards"] = with_ctes(*EVAL, META, LOOKUP) + f"""SELECT r.query_id, r.rank, r.doc_id,
  coalesce(nullif(l.func_name, ''), {q(UNKNOWN_FUNCTION)}) AS display_name,
  coalesce(l.repository_name, '') AS repository_name, coalesce(l.func_code_url, '') AS func_code_url,
  r.score, {strip("coalesce(l.docstring, '')")} AS docstring,
  {strip("coalesce(l.code, '')")} AS code,
  {truncate_code(strip("coalesce(l.code, '')"))} AS code_preview
FROM bm25 r LEFT JOIN lookup l ON l.id = r.doc_id WHERE r.rank <= 10"""

ORACLE["q_dq_counts"] = with_ctes(*BASE, META) + """SELECT coalesce(d.split, m.split) AS split,
  coalesce(d.n, 0) AS documents, coalesce(m.n, 0) AS metadata,
  coalesce(d.n, 0) = coalesce(m.n, 0) AS counts_match
FROM (SELECT split, count(*) AS n FROM docs GROUP BY split) d
FULL OUTER JOIN (SELECT split, count(*) AS n FROM meta GROUP BY split) m ON m.split = d.split"""

ORACLE["q_dq_id_mismatch"] = with_ctes(*BASE, META) + """SELECT coalesce(d.split, m.split) AS split,
  count(*) FILTER (WHERE d.id IS NOT NULL AND m.id IS NOT NULL) AS matched_ids,
  count(*) FILTER (WHERE m.id IS NULL) AS documents_only,
  count(*) FILTER (WHERE d.id IS NULL) AS metadata_only,
  count(DISTINCT d.id) AS distinct_document_ids, count(DISTINCT m.id) AS distinct_metadata_ids
FROM (SELECT split, id FROM docs) d FULL OUTER JOIN (SELECT split, id FROM meta) m
  ON m.split = d.split AND m.id = d.id
GROUP BY 1"""


def _blank(c: str) -> str:
    return f"{strip(f'coalesce({c}, {chr(39)}{chr(39)})')} = ''"


ORACLE["q_dq_empty_fields"] = with_ctes(*BASE) + f"""SELECT split, count(*) AS documents,
  count(*) FILTER (WHERE {_blank("func_name")}) AS empty_func_name,
  count(*) FILTER (WHERE {_blank("code")}) AS empty_code,
  count(*) FILTER (WHERE {_blank("lexical_document")}) AS empty_lexical_document
FROM docs GROUP BY split"""

ORACLE["q_dq_sample"] = with_ctes(*BASE) + f"""SELECT split, sample_rank, id, func_name, has_docstring,
  lexical_token_count, {preview("docstring")} AS docstring_preview, {preview("code")} AS code_preview,
  {preview("lexical_document")} AS lexical_preview
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY md5('13:' || CAST(id AS VARCHAR)), id) AS BIGINT)
        AS sample_rank FROM docs) WHERE sample_rank <= 3"""

ORACLE["q_dq_stats_present"] = with_ctes(*BASE, STATS_SQL) + """SELECT e.split,
  s.kept_records IS NOT NULL AS present, s.kept_records, s.missing_docstring_rate, s.lexical_token_avg
FROM (SELECT 'train' AS split UNION ALL SELECT 'valid' UNION ALL SELECT 'test') e
LEFT JOIN split_stats s ON s.split = e.split"""

ORACLE["q_dq_vector_alignment"] = with_ctes(*DENSE) + """SELECT
  (SELECT count(*) FROM queries) AS queries,
  (SELECT count(*) FROM queries q JOIN hq v ON v.query_id = q.query_id) AS queries_with_vector,
  (SELECT count(*) FROM hq v WHERE v.query_id NOT IN (SELECT query_id FROM queries)) AS vectors_without_query,
  (SELECT count(*) FROM embeddings) AS document_vectors,
  (SELECT CAST(min(len(embedding)) AS BIGINT) FROM embeddings) AS min_dimension,
  (SELECT CAST(max(len(embedding)) AS BIGINT) FROM embeddings) AS max_dimension"""


def _split(key: str) -> str:
    return f"CASE (({key} % 20) + 20) % 20 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END"


def _id_sets(other: str, key: str) -> str:
    return f"""WITH d AS (SELECT {_split('doc_id')} AS split, doc_id AS id FROM documents),
m AS (SELECT {_split(key)} AS split, {key} AS id FROM {other})
"""


ORACLE["q_dq_label_counts"] = _id_sets("labels", "doc_id") + """SELECT d.split, d.n AS documents,
  coalesce(m.n, 0) AS metadata, d.n = coalesce(m.n, 0) AS counts_match
FROM (SELECT split, count(*) AS n FROM d GROUP BY split) d
LEFT JOIN (SELECT split, count(*) AS n FROM m GROUP BY split) m ON m.split = d.split"""

ORACLE["q_dq_label_ids"] = _id_sets("labels", "doc_id") + """SELECT coalesce(d.split, m.split) AS split,
  count(*) FILTER (WHERE d.id IS NOT NULL AND m.id IS NOT NULL) AS matched_ids,
  count(*) FILTER (WHERE m.id IS NULL) AS documents_only,
  count(*) FILTER (WHERE d.id IS NULL) AS metadata_only,
  count(DISTINCT d.id) AS distinct_document_ids, count(DISTINCT m.id) AS distinct_metadata_ids
FROM d FULL OUTER JOIN m ON m.split = d.split AND m.id = d.id GROUP BY 1"""

ORACLE["q_dq_vector_ids"] = _id_sets("embeddings", "vec_id") + """SELECT coalesce(d.split, m.split) AS split,
  coalesce(d.id, m.id) AS id, CASE WHEN d.id IS NULL THEN 'metadata_only' ELSE 'documents_only' END AS side
FROM d FULL OUTER JOIN m ON m.split = d.split AND m.id = d.id WHERE d.id IS NULL OR m.id IS NULL"""

ORACLE["q_dq_raw_empty_fields"] = with_ctes(RAW) + f"""SELECT split, count(*) AS documents,
  count(*) FILTER (WHERE {_blank("func_name")}) AS empty_func_name,
  count(*) FILTER (WHERE {_blank("func_code_string")}) AS empty_code,
  count(*) FILTER (WHERE {_blank("func_documentation_string")}) AS empty_lexical_document
FROM raw GROUP BY split"""

ORACLE["q_lookup_overrides"] = with_ctes(*BASE) + """SELECT d.id, d.func_name,
  CASE WHEN l.quality = 1 THEN 'quality/' || CAST(l.doc_id AS VARCHAR) END AS repository_name,
  CASE WHEN l.toxic = 1 THEN 'toxic/' || CAST(l.doc_id AS VARCHAR) END AS func_path_in_repository,
  CAST(NULL AS VARCHAR) AS func_code_url, CAST(NULL AS VARCHAR) AS language
FROM docs d LEFT JOIN labels l ON l.doc_id = d.id"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
