"""BM25 ranking vector, edge cases and the physical plan of the query phase."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import blockmax, rerank, search
from quarry.operators import evaluate as E
from quarry.operators.index import bucket_labels, build_index
from quarry.session import settings


@pytest.fixture(scope="module")
def tiny(spark):
    docs = spark.createDataFrame(
        [("d1", "train", "f", "a a b"), ("d2", "train", "g", "a c"), ("d3", "train", "h", "c c c"),
         ("d4", "train", "e", "")],
        "id string, split string, func_name string, lexical_document string")
    return build_index(docs).materialized()


def _q(spark, *texts):
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)],
                                 "query_id string, query_text string")


def test_statistics(tiny):
    s = tiny.statistics.first()
    assert s["document_count"] == 3          # empty lexical text is not indexed
    assert s["total_token_count"] == 8
    assert s["average_document_length"] == 2.6667
    assert s["vocabulary_size"] == 3


def test_idf(tiny):
    v = {r["term"]: r for r in tiny.vocabulary.collect()}
    assert v["a"]["idf"] == pytest.approx(math.log(1 + 1.5 / 2.5))
    assert v["a"]["document_frequency"] == 2 and v["a"]["collection_frequency"] == 3
    assert v["c"]["collection_frequency"] == 4


def test_scores_match_formula(spark, tiny):
    top = search.bm25_topk(tiny, _q(spark, "a"), 10).orderBy("rank").collect()
    assert [r["doc_id"] for r in top] == ["d1", "d2"]  # d3 has no 'a'
    idf = math.log(1 + 1.5 / 2.5)

    def w(tf, dl):
        return idf * (tf * 2.5) / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / 2.6667))
    assert top[0]["score"] == pytest.approx(w(2, 3), abs=1e-6)
    assert top[1]["score"] == pytest.approx(w(1, 2), abs=1e-6)


def test_repeated_terms_oov_and_empty(spark, tiny):
    r = search.bm25_topk(tiny, _q(spark, "a a", "a", "z", "", "A"), 10)
    by_q = {}
    for row in r.collect():
        by_q.setdefault(row["query_id"], []).append((row["rank"], row["doc_id"], row["score"]))
    assert sorted(by_q["q0"]) == sorted(by_q["q1"]) == sorted(by_q["q4"])
    assert "q2" not in by_q and "q3" not in by_q


def test_no_exchange_between_join_and_aggregate(spark, tiny):
    plan = search.bm25_scores(tiny, _q(spark, "a c"))._jdf.queryExecution() \
        .executedPlan().toString()
    # the aggregate over (query_id, doc_id) is satisfied by the bucketing
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning(query_id" not in plan


def test_metrics_closed_form(spark):
    queries = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "query_id long, relevant_doc_id long")
    ranking = spark.createDataFrame([(1, 1, 1), (2, 3, 2), (3, 60, 3)],
                                    "query_id long, rank int, doc_id long")
    m = E.metrics(E.per_query(queries, ranking)).first()
    assert m["query_count"] == 3
    assert m["mrr_at_10"] == round((1 + 1 / 3) / 3, 6)
    assert m["recall_at_10"] == round(2 / 3, 6)
    assert m["ndcg_at_10"] == round((1 + 1 / math.log2(4)) / 3, 6)
    pq = E.per_query(queries, ranking).collect()
    assert all(r["ndcg_at_10"] >= r["rr_at_10"] for r in pq)


def test_many_queries_are_one_scan(spark, tiny):
    """All queries share one scan of the lists, which stay in their buckets."""
    qs = _q(spark, *["a", "b c", "a c", "c", "a b c", "b", "z", "a a"] * 40)
    with settings(spark, blockmax.KEEP_BUCKETS):
        found = blockmax.rank_buckets(tiny, search.weighted_queries(tiny, qs), 3, search.scoring_constants(tiny))
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("max_factor") and plan.count("Bucketed: true") == 1
    assert plan.count("Exchange hashpartitioning(bucket") == 1  # the queries'
    left = plan[plan.index("FlatMapCoGroups"):plan.index("Bucketed: true")]
    assert "Exchange" not in left
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
    whole, other = search.bm25_topk(tiny, qs, 3), search.bm25_topk_exhaustive(tiny, qs, 3)
    assert whole.count() > 0 and whole.exceptAll(other).count() == 0 and other.exceptAll(whole).count() == 0


def test_postings_point_lookup_is_pushed_down(spark, tiny):
    df = search.postings_for_terms(tiny, ["a", "zzz"])
    assert sorted((r["term"], r["doc_id"], r["term_frequency"]) for r in df.collect()) == \
        [("a", "d1", 2), ("a", "d2", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan or "PushedFilters: [IsNotNull(term), In(term" in plan


def _same(a, b):
    a, b = (x.select("query_id", "rank", "doc_id", "score_fp") for x in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_pruned_topk_equals_exhaustive(pipeline):
    qs = pipeline.queries.select("query_id", "query_text")
    for k in (1, 3, 50):
        assert _same(search.bm25_topk(pipeline.index, qs, k), search.bm25_topk_exhaustive(pipeline.index, qs, k))


def test_chunks_of_queries(pipeline, monkeypatch):
    qs = pipeline.queries.select("query_id", "query_text")
    want = search.bm25_topk(pipeline.index, qs, 7)
    monkeypatch.setattr(blockmax, "QUERY_BYTES", 4000)
    assert _same(search.bm25_topk(pipeline.index, qs, 7), want)


def test_two_levels_beyond_the_bucket_limit(spark, pipeline):
    """A tiny token target asks for more document buckets than Spark may make:
    files hold several, rows and plans are the same, nothing is moved."""
    tokens = pipeline.index.statistics.first()["total_token_count"]
    with settings(spark, {"spark.sql.sources.bucketing.maxBuckets": "4"}):
        idx = build_index(pipeline.documents, -(-tokens // 3000)).materialized()
    assert idx.files == 4 and idx.parts > 5
    per = idx.lists.select("bucket", "part").distinct().groupBy("bucket").count().collect()
    assert len(per) == 4 and all(r["count"] > 5 for r in per)
    qs = pipeline.queries.select("query_id", "query_text")
    assert _same(search.bm25_topk(idx, qs, 10), search.bm25_topk(pipeline.index, qs, 10))
    for df in (search.bm25_scores(idx, qs), rerank.hashed_document_vectors(idx)):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert idx.postings.select("doc_id", "term", "term_frequency").exceptAll(
        pipeline.index.postings.select("doc_id", "term", "term_frequency")).count() == 0


def test_bucket_labels_fill_every_file(spark):
    for n in (1, 7, 64):
        labels = bucket_labels(spark, n)
        spread = labels.select(F.pmod(F.hash("bucket"), F.lit(n)).alias("p"), "slot").collect()
        assert sorted(r["p"] for r in spread) == list(range(n)) and all(r["p"] == r["slot"] for r in spread)


def test_block_maxima_skip_postings():
    """Lists that cannot bring a document into the top-k are only looked up."""
    r = np.random.default_rng(3)
    n = 5000
    rows = []
    for term, share in (("rare", 0.02), ("mid", 0.2), ("common", 0.9), ("most", 1.0)):
        docs = np.flatnonzero(r.random(n) < share)
        rows.append({"term": term, "max_factor": 2.5, "ids": docs, "tfs": r.integers(1, 9, len(docs)),
                     "dls": np.full(len(docs), 100)})
    bucket = blockmax.Bucket(pa.Table.from_pylist(rows), 100.0, 1.5, 0.75)
    terms, idfs = ["common", "rare", "most", "mid"], np.array([0.05, 6.0, 0.01, 2.0])
    at = np.array([bucket.terms.to_pylist().index(t) for t in terms])
    places, scores = bucket.best(at, idfs, 10)
    full = np.zeros(n, np.int64)
    for i, w in zip(at, idfs):
        docs, impact = bucket.impacts(i, w)
        full[docs] += impact
    want = np.lexsort((np.arange(n), -full))[:10]
    assert places.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
    assert not bucket.sums.any()


def test_index_build_has_one_exchange_by_bucket(pipeline):
    plan = build_index(pipeline.documents).postings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(bucket" in plan


def test_hashed_vectors_need_no_exchange(pipeline):
    plan = rerank.hashed_document_vectors(pipeline.index)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_unhinted_path_scores_equal_broadcast_scores(spark, pipeline):
    # beyond the limit no broadcast hint is given (the planner may still pick
    # a broadcast for tiny inputs); the scores must not change
    idx, q = pipeline.index, pipeline.queries
    a = search.bm25_scores(idx, q)
    b = search.bm25_scores(idx, q, broadcast_limit=0)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # with automatic broadcasts off, the fallback is a real shuffle join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = search.bm25_scores(idx, q, broadcast_limit=0)
        assert "SortMergeJoin" in c._jdf.queryExecution().executedPlan().toString()
        assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_term_store_opens_few_files(spark, pipeline):
    from quarry.operators.term_store import write_term_store
    store = write_term_store(pipeline.index, files=40)
    assert store.manifest.count() > 20
    vocab = pipeline.index.vocabulary.orderBy(F.desc("document_frequency"))
    hot = [r["term"] for r in vocab.limit(2).collect()]
    rare = [r["term"] for r in vocab.filter("document_frequency = 1").orderBy("term").limit(1).collect()]
    for terms in (rare, hot + rare, ["zzzzzzzzqq"], []):
        got, want = store.postings(terms), search.postings_for_terms(pipeline.index, terms)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert len(got.inputFiles()) <= 2 * len(terms) + 1  # a hot term's lists may span files
    assert store.postings(hot + rare).count() > 0


def test_examples_widen_until_enough(spark, monkeypatch):
    """Batches grow by place until enough texts qualify; the rows are those of
    one search over all candidates."""
    from quarry.operators import report
    n = 90
    text = lambda i: f"word{i % 70} shared" if i % 3 else "shared"  # noqa: E731  ids 1 and 71 have the same text
    docs = spark.createDataFrame([(i, "test" if i % 2 else "train", "f", text(i), text(i)) for i in range(n)],
                                 "id long, split string, func_name string, docstring string, lexical_document string")
    idx = build_index(docs.select("id", "split", "func_name", "lexical_document")).materialized()
    sizes = []
    monkeypatch.setattr(report, "bm25_topk", lambda i, q, k: sizes.append(q.count()) or search.bm25_topk(i, q, k))
    run = lambda first, count=8: [tuple(r) for r in report.example_queries(
        idx, docs, count=count, first_batch=first).orderBy("example_rank").collect()]
    want = run(1000)
    assert sizes == [45] and len(want) == 8 and len({t for _, t, _ in want}) == 8
    sizes.clear()
    assert run(3) == want and sizes[0] == 3 and sum(sizes) < 45
    sizes.clear()
    assert len(run(3, 1000)) < 45 and sum(sizes) == 45 and len(sizes) <= 4


def test_scores_query_returns_every_pair(spark, tmp_path):
    """more documents share a term with a query than any rank keeps, and all come back."""
    from quarry.plans import catalog, oracle
    rows = [(i, f"shared word{i}\ncode shared", "en", "s", 10) for i in range(130)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.q_bm25_scores(spark, str(tmp_path))
    assert got.count() == 7 * 130 and got.groupBy("query_id").count().filter("count = 130").count() == 7
    assert "<= 50" not in oracle.ORACLE["q_bm25_scores"].rsplit("SELECT query_id, doc_id", 1)[1]


def test_pairs_are_summed_without_a_hash_aggregate(spark, tiny):
    """nothing of the size of all pairs is hashed, sorted or spilled."""
    plan = search.bm25_scores(tiny, _q(spark, "a c"))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan
    assert "Aggregate" not in plan and "Generate" not in plan


def test_pairs_leave_in_batches(monkeypatch):
    """A bucket's pairs are handed on as they are made; an id that comes again in a list counts with both."""
    monkeypatch.setattr(blockmax, "PAIR_ROWS", 3)
    lists = pa.Table.from_pylist([
        {"term": "a", "max_factor": 2.5, "ids": ["x", "x", "y", "z"], "tfs": [1, 2, 1, 1], "dls": [9, 5, 9, 9]},
        {"term": "b", "max_factor": 2.5, "ids": [None, "z"], "tfs": [3, 1], "dls": [9, 9]}])
    bucket = blockmax.Bucket(lists, 9.0, 1.5, 0.75)
    asked = pa.array([[{"query_id": 7}, {"query_id": 8}], [{"query_id": 8}]])
    out = list(bucket.pairs(asked, np.array([1.0, 2.0])))
    assert len(out) == 2
    w = lambda idf, tf, dl: int(np.floor(idf * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * dl / 9.0)) * 1e9 + 0.5))
    a = {"x": w(1.0, 1, 9) + w(1.0, 2, 5), "y": w(1.0, 1, 9), "z": w(1.0, 1, 9)}
    want = {(7, d): s for d, s in a.items()} | {(8, d): s for d, s in a.items()}
    want[8, "z"] += w(2.0, 1, 9)
    want[8, None] = w(2.0, 3, 9)
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert {(q, d): s for q, d, s in rows} == want and len(rows) == len(want)


def test_bucket_postings_count_each_document_once(monkeypatch):
    """The lists of a bucket from its texts: rows of one id and length are one document, ids
    may be null or come again, and the lists leave in bounded batches."""
    from collections import Counter

    from quarry.operators import index
    monkeypatch.setattr(index, "BATCH_POSTINGS", 2)
    rows = [("b", "x y x"), ("a", "y"), (None, "x"), ("b", "y x z"), ("b", "x")]
    ids, texts = (pa.chunked_array([pa.array(list(c), pa.string())]) for c in zip(*rows))
    out = list(index.bucket_postings(ids, texts, 2.0, 1.5, 0.75))
    assert len(out) > 1
    want = Counter((t, i, len(text.split(" "))) for i, text in rows for t in text.split(" "))
    got = [r for b in out for r in b.to_pylist()]
    assert {(r["term"], d["doc_id"], d["doc_length"]): d["term_frequency"] for r in got for d in r["docs"]} == want
    for r in got:
        tf = [d["term_frequency"] for d in r["docs"]]
        assert r["df"] == len(tf) and r["cf"] == sum(tf)
        assert [d["doc_id"] or "" for d in r["docs"]] == sorted(d["doc_id"] or "" for d in r["docs"])
        assert r["max_factor"] == max(d["term_frequency"] * 2.5 / (d["term_frequency"] + 1.5 * (0.25 + 0.75 * d["doc_length"] / 2.0))
                                      for d in r["docs"])


def test_first_buckets_bound_the_others(spark, pipeline, monkeypatch):
    """With more buckets than cores a first wave gives each query a lower bound, with which
    the other buckets return few rows; the ranking is that of all pairs."""
    cores = spark.sparkContext.defaultParallelism
    idx = build_index(pipeline.documents, 5 * cores).materialized()
    first = blockmax.first_buckets(idx)
    assert len(first) == cores and blockmax.first_buckets(pipeline.index) == []
    returned = []
    ranked = blockmax.rank_buckets
    monkeypatch.setattr(blockmax, "rank_buckets", lambda *a, **kw: returned.append((kw, ranked(*a, **kw))) or returned[-1][1])
    qs = pipeline.queries.select("query_id", "query_text")
    assert _same(search.bm25_topk(idx, qs, 3), search.bm25_topk_exhaustive(idx, qs, 3))
    assert [sorted(kw) for kw, _ in returned] == [["only"], ["but"]]
    bounded = returned[1][1].count()
    unbounded = ranked(idx, search.weighted_queries(idx, qs), 3, search.scoring_constants(idx), but=first).count()
    assert bounded < unbounded


@pytest.mark.parametrize("look_up", [0, 4000])
def test_known_bound_changes_no_row(monkeypatch, look_up):
    """Documents that score the bound are kept, whether the other lists are summed or searched."""
    monkeypatch.setattr(blockmax, "LOOK_UP", look_up)
    r = np.random.default_rng(5)
    n = 400
    rows = [{"term": f"t{i}", "max_factor": 2.5, "ids": np.flatnonzero(r.random(n) < 0.1 * (i + 1)).tolist()} for i in range(9)]
    for x in rows:
        x["tfs"], x["dls"] = [1] * len(x["ids"]), [100] * len(x["ids"])
    bucket = blockmax.Bucket(pa.Table.from_pylist(rows), 100.0, 1.5, 0.75)
    at, idfs = np.arange(9), np.linspace(5.0, 0.1, 9)
    places, scores = bucket.best(at, idfs, 10)
    full = np.zeros(n, np.int64)
    for i, w in zip(at, idfs):
        docs, impact = bucket.impacts(i, w)
        full[docs] += impact
    want = np.lexsort((np.arange(n), -full))[:10]
    assert places.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
    for least in (1, int(scores[-1]) // 2, int(scores[-1])):
        p, s = bucket.best(at, idfs, 10, least)
        assert p.tolist() == places.tolist() and s.tolist() == scores.tolist()
    assert bucket.best(at, idfs, 10, int(scores[0]) + 1)[0].tolist() == []


def test_long_lists_are_looked_up_and_queries_taken_a_few_at_a_time(monkeypatch):
    """Lists that cannot bring a document are looked up at the documents left, neither summed
    nor kept as postings; a task holds arrays of a few queries; the rows are those of all sums."""
    monkeypatch.setattr(blockmax, "LOOK_UP", 100)
    monkeypatch.setattr(blockmax, "DENSE_BYTES", 3 * 8 * 500)  # three lists
    monkeypatch.setattr(blockmax, "QUERIES", 7)
    r = np.random.default_rng(3)
    n, lists = 500, 12
    rows = [{"term": f"t{i:02}", "max_factor": 1.0, "ids": np.flatnonzero((r.random(n) < 0.08 * (i + 1)) | (np.arange(n) == 7)).tolist()}
            for i in range(lists)]
    for x in rows:
        x["tfs"], x["dls"] = [1] * len(x["ids"]), [100] * len(x["ids"])
    idfs = np.linspace(6.0, 0.05, lists)
    make = lambda: blockmax.Bucket(pa.Table.from_pylist(rows), 100.0, 1.5, 0.75)
    asked = [sorted(r.choice(lists, 8, replace=False).tolist()) for _ in range(20)] + [[], [lists - 1]]
    full, whole = [], make()
    for a in asked:
        sums = np.zeros(n, np.int64)
        for i in a:
            docs, impact = whole.impacts(i, idfs[i])
            sums[docs] += impact
        best = np.lexsort((np.arange(n), -sums))[:4]
        full.append([(int(d), int(sums[d])) for d in best if sums[d]])
    least = [x[-1][1] if x else 0 for x in full]
    bucket, sizes = make(), []
    few = bucket.search_few
    monkeypatch.setattr(bucket, "search_few", lambda t, k: sizes.append(t.num_rows) or few(t, k))
    t = pa.table({"query_id": list(range(len(asked))), "terms": pa.array([[f"t{i:02}" for i in a] for a in asked], pa.list_(pa.string())),
                  "idfs": pa.array([idfs[a].tolist() for a in asked], pa.list_(pa.float64())), "least": pa.array(least, pa.int64())})
    got = bucket.search(t, 4).to_pylist()
    assert [(x["query_id"], x["doc_id"], x["score_fp"]) for x in got] == [(q, d, s) for q, x in enumerate(full) for d, s in x]
    assert sizes == [7, 7, 7, 1]
    assert 0 < len(bucket.known_dense) <= 3
    assert all(bucket.size[i] >= bucket.dense_size for i in bucket.known_dense) and not bucket.known

def test_queries_are_packed_and_not_dealt_to_buckets(spark, tiny, monkeypatch):
    """a label for each document bucket is all that is shuffled; the queries come packed, by
    broadcast.  Pieces are bounded, and hold null ids and queries without terms."""
    qs = search.weighted_queries(tiny, _q(spark, "a", "b c", "a c", "c", "z"))
    with settings(spark, blockmax.KEEP_BUCKETS):
        found = blockmax.rank_buckets(tiny, qs, 3, search.scoring_constants(tiny))
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "terms" not in plan and "idfs" not in plan
    dealt = plan[plan.index("Exchange hashpartitioning(bucket"):]
    assert plan.index("BroadcastNestedLoopJoin") < plan.index("Exchange hashpartitioning(bucket")
    assert "piece" not in dealt[:dealt.index("BroadcastExchange")]
    monkeypatch.setattr(blockmax, "QUERY_BYTES", 200)
    rows = [(None, ["a", "b"], [1.5, 2.5], 3), ("q", [], [], 0), ("r", ["b"] * 40, [2.5] * 40, 1), ("s", ["c"], [0.5], 9)]
    schema = "query_id string, terms array<string>, idfs array<double>, least long"
    pieces, chunks = blockmax.query_pieces(spark.createDataFrame(rows, schema).coalesce(1))
    found = pieces.orderBy("id").collect()
    assert [r["bytes"] <= 200 for r in found] == [True, False, True] and len(chunks) == 3
    back = list(blockmax.unpacked(pa.chunked_array([[bytes(r["piece"]) for r in found]], pa.binary())))
    assert len(back) == 1 and [tuple(r.values()) for r in back[0].to_pylist()] == rows
    monkeypatch.setattr(blockmax, "QUERIES", 2)
    assert [t.num_rows for t in blockmax.unpacked(pa.chunked_array([[bytes(r["piece"]) for r in found]], pa.binary()))] == [2, 2]


def test_scores_beyond_the_limit_move_no_list(spark, pipeline):
    """more query terms than may be broadcast go in chunks of queries; the lists are neither shuffled nor
    sorted by term, and the pairs are the same."""
    idx, q = pipeline.index, pipeline.queries
    want, n = search.bm25_scores(idx, q), search.query_terms(q).count()
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = search.bm25_scores(idx, q, broadcast_limit=n // 3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert plan.count("BroadcastHashJoin") >= 3
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() > 0


def test_index_build_leaves_no_dealt_texts(spark, monkeypatch):
    """the shuffle of the texts is let go once the lists are stored, and scratch tables are small."""
    from quarry.operators import index
    from quarry.session import materialize, release_shuffles
    calls = []
    monkeypatch.setattr(index, "release_shuffles", lambda s: calls.append(s) or release_shuffles(s))
    docs = spark.createDataFrame([(1, "train", "f", "a b"), (2, "test", "g", "b")],
                                 "id long, split string, func_name string, lexical_document string")
    idx = build_index(docs).materialized()
    assert len(calls) == 1
    for t in (idx.lists, idx.documents, materialize(docs)):
        assert t.inputFiles() and all(".zstd.parquet" in x for x in t.inputFiles())


def test_pruned_query_keeps_one_index(spark, tmp_path):
    """the index that only gives its layout is let go before the other one is built; the rows are those
    of the single one."""
    from quarry.plans import catalog
    from quarry.session import scratch_written
    rows = [(i, f"shared word{i % 7}\ncode shared", "en", "s", 10) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    before = scratch_written()
    got = catalog.q_bm25_topk_pruned(spark, str(tmp_path))
    new = [x for x in scratch_written() if x not in before]
    assert sum("quarry-postings" in x for x in new) == 1
    want = catalog.q_bm25_topk(spark, str(tmp_path))
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
