import math
import sys
from collections import Counter, defaultdict
from os.path import dirname

import numpy as np
import pytest

sys.path.insert(0, dirname(__file__))
import brute  # noqa: E402

from quarry.llm import lm_scoring, order_minhash, quality_rules, source_mixing, substring_dedup  # noqa: E402
from quarry.llm.common import word_hashes  # noqa: E402


def test_quality_measures_and_columns(docs, rows):
    got = quality_rules.judge(docs)
    assert got.columns.count("n_words") == 1 and got.columns.count("kept") == 1
    out = got.select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     "kept").collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r)[1:7] == brute.base_quality(r.text), r.text
        assert not (r.base_failed and r.kept)
    kept = {r.text for r in out if r.kept}
    assert not any(t and t.startswith("### ***") for t in kept) and any(t and len(t) > 10000 for t in kept)


def test_quality_filter_is_not_pushed_into_the_projections(docs):
    plan = quality_rules.judge(docs).filter("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_quality_bounds_are_inclusive(spark):
    rule = (quality_rules.Rule("r", "mean_word_length", 2.0, 4.0),)
    d = spark.createDataFrame([(1, "ab " * 10), (2, "abcd " * 10), (3, "abcde " * 10), (4, "a " * 10)], "i int, text string")
    d = quality_rules.judge(d, rules=rule)
    assert {r.i: r.broken_rules for r in d.collect()} == {1: [], 2: [], 3: ["r"], 4: ["r"]}


def test_substring_dedup(docs, rows):
    got = substring_dedup.remove_repeats(docs).collect()
    assert Counter(map(tuple, got)) == Counter(brute.substring([r[:2] for r in rows]))
    assert sum(r.n_removed for r in got) > 100


def test_substring_sketch_rows_and_widths(docs, rows):
    got = substring_dedup.remove_repeats(docs, width=7, depth=3).collect()
    assert Counter(map(tuple, got)) == Counter(brute.substring([r[:2] for r in rows], 7))


def test_dedup_texts_keeps_columns_and_follows_n_chars(docs, rows):
    got = substring_dedup.dedup_texts(docs)
    assert got.columns == docs.columns
    want = {(i, s) for i, n, gone, s in brute.substring([r[:2] for r in rows]) if not gone or gone < n}
    out = got.collect()
    assert {r.doc_id for r in out} == {i for i, _ in want}
    original = {r[1] for r in rows}
    cut = [r for r in out if r.text not in original]
    assert cut and all(r.n_chars == len(r.text) and (r.doc_id, brute.SHA(r.text.encode())) in want for r in cut)


def test_mixing(docs, rows, spark):
    got = source_mixing.budgets(docs, extra=("source",)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    want, taken = brute.targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, source_mixing.budgets(
        docs.repartition(7), extra=("source",)).collect()))
    mixed = source_mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.source] += len(brute.words(r.text))
    assert words == {s: n for s, n in taken.items() if n}


def test_mixing_reshares_the_excess(spark):
    d = spark.createDataFrame([(1, "a", "a " * 10), (2, "b", "b " * 1000), (3, "c", "c " * 20), (4, None, None)],
                              "doc_id int, source string, text string")
    got = {r.source: r.target for r in source_mixing.budgets(d, extra=("source",)).collect()}
    assert got == pytest.approx({"a": 30.0, "b": 940.0, "c": 60.0, None: 0.0})


def test_lm_base_scores_and_gain(docs, rows):
    got = lm_scoring.score(docs).collect()
    key = lambda r: tuple(map(str, r))
    flat = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=key)
    want = sorted(((*r[:5], round(r[5], 6)) for r in brute.unigram([r[:2] for r in rows])), key=key)
    assert flat == want
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)


def test_lm_weights_follow_the_better_estimate():
    strong = lm_scoring.learn_weights([(3, 80, 8, 100)])  # the bigram's estimate is far larger
    weak = lm_scoring.learn_weights([(3, lm_scoring.NONE, 40, 100)])
    assert strong[3][0] > 0.9 and weak[3][1] > 0.9
    assert abs(strong[3].sum() - 1) < 1e-9


def test_order_minhash_classes(docs, rows):
    words = {}
    for r in rows:
        if r[0] is not None:
            words[r[0]] = brute.words(r[1])
    ids = sorted(words)
    edges = [(a, b) for a in ids for b in ids if a < b and brute.near_copies(words[a], words[b])]
    want = brute.components(ids, edges)
    got = order_minhash.classes(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert len(set(want.values())) < len(want)


def test_order_minhash_smallest_and_distinct():
    """op8 sorts no places and no text twice: the same places as a full sort, also where values are equal."""
    r = np.random.default_rng(4)
    for v in (r.permutation(4000).reshape(8, 500), r.integers(0, 9, (8, 40)), r.permutation(24).reshape(6, 4)):
        v = v.astype(np.uint64)
        at = order_minhash._smallest(v, 5)
        take = min(5, v.shape[1])
        assert at.shape == (len(v), take) and (np.diff(at, axis=1) > 0).all()
        assert (np.sort(np.take_along_axis(v, at, 1), 1) == np.sort(v, 1)[:, :take]).all()
    for x in (r.integers(0, 50, 200), r.integers(0, 50, 1), r.integers(0, 50, 0)):
        assert order_minhash._distinct(x).tolist() == sorted(set(x.tolist()))
    x = np.unique(r.integers(0, 2**63, 70_000).astype(np.uint64))
    short = (x >> np.uint64(32)).astype(np.uint32)
    low = [int(((short ^ b) * a).min()) for a, b in zip(*order_minhash._lanes)]
    bits = [int(order_minhash.mix64(np.array([m], np.uint64))[0]) & 3 for m in low]
    assert [(v >> 2 * j) & 3 for v in order_minhash.signature(x) for j in range(32)] == bits


def test_order_minhash_alignment_is_order_sensitive():
    a = [f"w{i}" for i in range(60)]
    k = lambda w: order_minhash.kmers(" ".join(w))
    swapped = a[30:] + a[:30]
    for b in (a, a[:55], swapped, a[:20] + ["x"] + a[21:], ["y"], a + a):
        want = brute.ordered_similarity(a, b)
        got = order_minhash.similarity(k(a), k(b))
        assert got == pytest.approx(want) if want >= 0.8 else got < 0.8
    assert len(word_hashes(None)) == 0


def test_order_minhash_common_line(spark):
    """One line repeated in both does not make two texts near-copies."""
    line = "a very common line indeed. " * 200
    own = [" ".join(f"x{k}_{i}" for i in range(60)) for k in range(3)]
    d = spark.createDataFrame([(i, f"{t}\n{line}") for i, t in enumerate(own)] + [(9, f"{own[0]}\n{line}")],
                              "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in order_minhash.classes(d).collect()} == {0: 0, 1: 1, 2: 2, 9: 0}


def test_order_minhash_price_of_the_set_test():
    """Few own words beside a much repeated line: the alignment alone would link them (README)."""
    own = [f"x{i}" for i in range(60)]
    line = "a very common line indeed.".split() * 200
    a, b = own + line, [f"y{i}" if i in (10, 30, 50) else w for i, w in enumerate(own)] + line
    x, y = (order_minhash.shingles(word_hashes(" ".join(w))) for w in (a, b))
    aligned = order_minhash.similarity(order_minhash.labelled(x), order_minhash.labelled(y))
    assert aligned == pytest.approx(brute.ordered_similarity(a, b)) and round(aligned, 3) == 0.972
    assert order_minhash.compare(x, y) == (0.625, False) and not brute.near_copies(a, b)


def test_order_minhash_signature_bound_loses_next_to_nothing():
    """A pair of set similarity 0.8 agrees in each lane with probability 0.85."""
    n, least = order_minhash.LANES, order_minhash.LEAST_EQUAL
    assert sum(math.comb(n, i) * 0.85**i * 0.15**(n - i) for i in range(least)) < 1e-5


def test_order_minhash_keep_one(docs):
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    gone = {r.doc_id for r in order_minhash.classes(docs).collect() if not r.kept}
    assert gone and not gone & set(ids) and ids[None] == 2


def test_order_minhash_hub_that_differs(spark):
    """Members of a bucket that its hub does not link are compared too."""
    import random
    r = random.Random(3)
    base = [f"w{r.randint(0, 500)}" for _ in range(200)]

    def edited(seed, n):
        q, w = random.Random(seed), list(base)
        for i in q.sample(range(200), n):
            w[i] = f"e{seed}_{i}"
        return w

    texts = {i: edited(i, 4) for i in range(1, 25)} | {30: base}
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    ids = sorted(texts)
    want = brute.components(ids, [(a, b) for a in ids for b in ids
                                  if a < b and brute.near_copies(texts[a], texts[b])])
    assert {r.doc_id: r.component_id for r in order_minhash.classes(d).collect()} == want


def test_empty_tables(empty):
    assert quality_rules.judge(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert source_mixing.budgets(empty).count() == 0
    assert lm_scoring.score(empty).count() == 0
    assert order_minhash.classes(empty).count() == 0
