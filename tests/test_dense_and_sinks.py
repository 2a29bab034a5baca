"""Encoder hook, encode-on-miss, last-wins vectors, sinks round trip and the
streaming search."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate as E
from quarry.operators import rerank, search
from quarry.sources import sinks
from quarry.streaming import search_stream


def _tmp():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def make_stub_encoder():
    # deterministic stand-in for a model (character-class counts); defined in
    # a function so the Python workers receive it by value
    def encode(texts):
        import numpy as np
        out = [[sum(c.isalpha() for c in t), sum(c.isdigit() for c in t),
                sum(c.isspace() for c in t) + 1.0] for t in texts]
        return np.asarray(out, dtype="float32")
    return encode


def test_model_encoder_hook_normalises(spark):
    df = spark.createDataFrame([(1, "ab 12"), (2, "")], "query_id long, query_text string")
    out = {r["query_id"]: r["embedding"] for r in
           rerank.encode_with_model(df, "query_id", "query_text", make_stub_encoder(), 3).collect()}
    assert len(out[1]) == 3 and abs(np.linalg.norm(out[1]) - 1) < 1e-6
    assert abs(np.linalg.norm(out[2]) - 1) < 1e-6


def test_encode_on_miss(spark):
    q = spark.createDataFrame([(1, "a"), (2, "b b")], "query_id long, query_text string")
    stored = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "query_id long, embedding array<float>")
    stub = make_stub_encoder()
    enc = lambda d: rerank.encode_with_model(d, "query_id", "query_text", stub, 3)  # noqa
    got = {r["query_id"]: r["embedding"] for r in rerank.vectors_or_encode(q, stored, enc).collect()}
    assert got[1] == [1.0, 0.0, 0.0] and len(got[2]) == 3


def test_latest_by_key(spark):
    v = spark.createDataFrame([("a", 1, [1.0]), ("a", 3, [3.0]), ("b", 2, [2.0])],
                              "doc_id string, row int, embedding array<double>")
    got = {r["doc_id"]: r["embedding"] for r in rerank.latest_by_key(v).collect()}
    assert got == {"a": [3.0], "b": [2.0]}


def test_missing_vector_scores_minus_two(spark, pipeline):
    cands = pipeline.bm25_ranking
    qv = rerank.hashed_query_vectors(pipeline.queries)
    no_vectors = spark.createDataFrame([], "doc_id long, embedding array<double>")
    rr = rerank.rerank(cands, qv, no_vectors, 50)
    assert {r["score"] for r in rr.select("score").distinct().collect()} == {-2.0}
    # with every cosine tied, the order falls back to BM25 order
    a = cands.join(qv.select("query_id"), "query_id").select("query_id", "rank", "doc_id")
    b = rr.select("query_id", "rank", "doc_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerank_refuses_vectors_that_do_not_match(spark, pipeline):
    cands = spark.createDataFrame([(1, 10, 5), (1, 11, 4)], "query_id long, doc_id long, score_fp long")
    vec = lambda key, rows: spark.createDataFrame(
        rows, f"{key} long, embedding array<double>, encoder string")
    q, d = vec("query_id", [(1, [1.0, 0.0], "a")]), vec("doc_id", [(10, [0.0, 1.0], "a"), (11, [1.0, 0.0], "a")])
    assert [r["doc_id"] for r in rerank.rerank(cands, q, d, 2).orderBy("rank").collect()] == [11, 10]
    for queries, documents, message in (
            (vec("query_id", [(1, [1.0, 0.0, 0.0], "a")]), d, "different lengths: 3 and 2"),
            (q, vec("doc_id", [(10, [1.0], "a")]), "different lengths: 2 and 1"),
            (vec("query_id", [(1, [1.0, 0.0], "b")]), d, "query vectors of b, document vectors of a"),
            (vec("query_id", [(2, [1.0, 0.0], "a")]), d, "no vector of query 1"),
            (vec("query_id", [(1, None, "a")]), d, "no vector of query 1")):
        with pytest.raises(Exception, match=message):
            rerank.rerank(cands, queries, documents, 2).collect()
    # a document without a vector keeps its place in the list
    assert rerank.rerank(cands, q, d.filter("doc_id = 11"), 2).orderBy("rank").collect()[1]["score"] == -2.0


def test_pipeline_refuses_vectors_of_another_encoder(spark, pipeline):
    from quarry.plans.pipeline import DensePipeline
    v = spark.createDataFrame([(1, [1.0])], "doc_id long, embedding array<float>")
    for kwargs in ({"vectors": v}, {"vectors": v, "vectors_encoder": "model"}, {"encoder": lambda d: d}):
        with pytest.raises(ValueError, match="encoder|vectors of model"):
            DensePipeline(spark, pipeline.sf_dir, **kwargs)


def test_only_candidates_are_encoded(pipeline):
    ids = pipeline.candidates.select("doc_id").distinct()
    got = pipeline.candidate_vectors
    assert got.count() == ids.count() and got.join(ids, "doc_id", "left_anti").count() == 0
    some = pipeline.documents.select("id").filter("id % 5 = 0").select(F.col("id").alias("doc_id"))
    part, full = (rerank.hashed_document_vectors(pipeline.index, x) for x in (some, None))
    want = full.join(some, "doc_id", "left_semi")
    assert part.exceptAll(want).count() == 0 and part.count() == want.count() > 0


def test_index_round_trip_keeps_bucketing(spark, pipeline):
    out = _tmp()
    sinks.write_index(pipeline.index, out)
    idx = sinks.read_index(spark, out)
    a = search.bm25_topk(pipeline.index, pipeline.queries, 50).drop("score_fp")
    b = search.bm25_topk(idx, pipeline.queries, 50).drop("score_fp")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = search.bm25_scores(idx, pipeline.queries)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(query_id" not in plan


def test_processed_and_results_round_trip(spark, pipeline):
    out = _tmp()
    sinks.write_processed(pipeline.documents, pipeline.metadata, out)
    test_only = sinks.read_processed(spark, out, ["test"])
    assert test_only.select("split").distinct().collect()[0][0] == "test"
    assert test_only.count() == pipeline.documents.filter("split = 'test'").count()
    flat = E.sample_rankings(pipeline.queries, pipeline.bm25_ranking)
    res = sinks.evaluation_result({"query_split": "test", "retrieval_depth": 50},
                                  pipeline.index.statistics, pipeline.bm25_metrics,
                                  E.sample_rankings_nested(flat))
    sinks.write_result(res, f"{out}/result")
    back = sinks.read_result(spark, f"{out}/result")
    assert back.first()["metrics"]["query_count"] == pipeline.bm25_metrics.first()["query_count"]
    assert sinks.read_result(spark, f"{out}/absent") is None


def test_streaming_search_matches_batch(spark, pipeline):
    src, out = _tmp(), _tmp()
    qs = pipeline.queries.select(F.col("query_id").cast("string").alias("query_id"), "query_text")
    qs.coalesce(2).write.mode("overwrite").json(os.path.join(src, "q"))
    stream = search_stream.query_stream(spark, os.path.join(src, "q"))
    handle = search_stream.start_search_stream(pipeline.index, stream, os.path.join(out, "res"),
                                               os.path.join(out, "chk"), top_k=10)
    handle.awaitTermination(120)
    got = spark.read.parquet(os.path.join(out, "res")).select("query_id", "rank", "doc_id", "score")
    want = search.bm25_topk(pipeline.index, qs, 10).select(
        "query_id", F.col("rank").cast("long"), "doc_id", "score")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_masked_mean_pool(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [100.0, 100.0]], [1, 1, 0]),
                                ([[2.0, 2.0]], [0])],
                               "v array<array<double>>, m array<int>")
    got = [r[0] for r in df.select(rerank.mean_pool("v", "m")).collect()]
    assert got[0] == [2.0, 3.0]
    assert got[1] == [0.0, 0.0]  # nothing unmasked


def test_max_queries_keeps_first_in_id_order(pipeline):
    q = E.build_queries(pipeline.documents, "test", max_queries=3)
    all_ids = sorted(r[0] for r in pipeline.queries.select("query_id").collect())
    assert sorted(r[0] for r in q.select("query_id").collect()) == all_ids[:3]


def test_index_summary_written(spark, pipeline):
    out = _tmp()
    sinks.write_index(pipeline.index, out)
    s = spark.read.json(f"{out}/summary").first()
    assert s["document_count"] == pipeline.index.statistics.first()["document_count"]


def test_streaming_search_with_rerank(spark, pipeline):
    src, out = _tmp(), _tmp()
    qs = pipeline.queries.select(F.col("query_id").cast("string").alias("query_id"), "query_text")
    qs.coalesce(1).write.mode("overwrite").json(os.path.join(src, "q"))
    stream = search_stream.query_stream(spark, os.path.join(src, "q"))
    dv = rerank.hashed_document_vectors(pipeline.index) \
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    handle = search_stream.start_search_stream(
        pipeline.index, stream, os.path.join(out, "res"), os.path.join(out, "chk"), top_k=5,
        query_vectors=rerank.hashed_query_vectors, doc_vectors=dv)
    handle.awaitTermination(180)
    got = spark.read.parquet(os.path.join(out, "res"))
    per = {r["pipeline"]: r["n"] for r in got.groupBy("pipeline").agg(F.count("*").alias("n")).collect()}
    assert per["bm25"] == search.bm25_topk(pipeline.index, qs, 5).count()
    want = rerank.rerank(search.bm25_topk(pipeline.index, qs, 50), rerank.hashed_query_vectors(qs),
                         dv, 5).select("query_id", "rank", "doc_id", "score")
    have = got.filter("pipeline = 'rerank'").select("query_id", "rank", "doc_id", "score")
    assert have.exceptAll(want).count() == 0 and want.exceptAll(have).count() == 0


def test_evaluation_runs_as_nested_rows(spark, pipeline):
    out = _tmp()
    for name, res in (("bm25", pipeline.bm25_result()), ("rerank", pipeline.rerank_result())):
        sinks.write_result(res, f"{out}/{name}")
        back = sinks.read_result(spark, f"{out}/{name}").first()
        assert back["metrics"]["query_count"] >= 1
        assert back["evaluation_setup"]["retrieval_depth"] == "50"
        first = back["sample_rankings"][0]
        assert first["top_results"] and first["top_results"][0]["rank"] == 1
    assert "bm25_score" in back["sample_rankings"][0]["top_results"][0].asDict()


def test_compare_keeps_bm25_when_rerank_fails(spark, pipeline):
    from quarry.operators import report
    qs = pipeline.queries.select("query_id", "query_text")
    broken = qs.select("query_id", F.raise_error(F.lit("encoder unavailable"))
                       .cast("array<double>").alias("embedding"))
    out = report.compare_pipelines(pipeline.index, qs, broken,
                                   rerank.hashed_document_vectors(pipeline.index), top_k=5)
    per = {r["pipeline"]: r["n"] for r in out.groupBy("pipeline").agg(F.count("*").alias("n")).collect()}
    assert "rerank" not in per and per["bm25"] == search.bm25_topk(pipeline.index, qs, 5).count()
    assert out.filter(F.col("rerank_error").contains("encoder unavailable")).count() == out.count()


def test_many_ids_are_met_in_their_buckets(spark, pipeline):
    """More ids than may be broadcast are dealt to the buckets; no posting is moved or sorted."""
    from quarry.operators.blockmax import KEEP_BUCKETS
    from quarry.session import settings
    some = pipeline.documents.filter("id % 5 = 0").select(F.col("id").alias("doc_id")) \
        .unionByName(spark.createDataFrame([(None,), (-1,), (5,)], "doc_id long"))
    want = rerank.hashed_document_vectors(pipeline.index).join(some, "doc_id", "left_semi")
    with settings(spark, {**KEEP_BUCKETS, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = rerank.hashed_document_vectors(pipeline.index, some, broadcast_limit=0)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort " not in plan
        assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(bucket" in plan
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    other = rerank.hashed_document_vectors(pipeline.index, some.select(F.col("doc_id").cast("int")), broadcast_limit=0)
    for found in (other, rerank.hashed_document_vectors(pipeline.index, some, broadcast_limit=0)):
        assert found.exceptAll(want).count() == 0 and found.count() == want.count()
