"""Data-quality checks report violations; sinks read statistics back."""

import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import ingest, quality
from quarry.sources import sinks


def test_id_mismatch_and_assert_clean(pipeline):
    docs, meta = pipeline.documents, pipeline.metadata
    quality.assert_clean(quality.id_mismatch(docs, meta), "ids")      # clean: no raise
    broken = meta.filter(F.col("id") % 7 != 0)                          # drop some metadata rows
    v = quality.id_mismatch(docs, broken)
    missing = docs.filter(F.col("id") % 7 == 0).count()
    assert v.count() == missing and {r["side"] for r in v.collect()} == {"documents_only"}
    with pytest.raises(quality.QualityError):
        quality.assert_clean(v, "ids")
    counts = {r["split"]: r for r in quality.count_check(docs, broken).collect()}
    assert any(not r["counts_match"] for r in counts.values())


def test_empty_fields_and_split_presence(pipeline):
    e = quality.empty_fields(pipeline.documents).agg(
        F.sum("empty_func_name"), F.sum("empty_code"), F.sum("empty_lexical_document")).first()
    assert tuple(e) == (0, 0, 0)
    stats = ingest.corpus_stats(pipeline.prepared).filter(F.col("split") != "valid")
    present = {r["split"]: r["present"] for r in quality.split_stats_present(stats).collect()}
    assert present == {"train": True, "valid": False, "test": True}


def test_split_totals_round_trip(spark, pipeline):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    stats = ingest.corpus_stats(pipeline.prepared)
    hist = ingest.length_histogram(pipeline.documents)
    sinks.write_stats(ingest.corpus_stats_nested(stats, hist), f"{out}/corpus_stats")
    totals = {r["split"]: r["kept_records"] for r in
              sinks.read_split_totals(spark, f"{out}/corpus_stats").collect()}
    assert totals == {r["split"]: r["kept_records"] for r in stats.collect()}
    assert sinks.read_split_totals(spark, f"{out}/absent").count() == 0


def test_examples_fallback_and_first_line_rule(spark):
    from quarry.operators import report
    from quarry.operators.index import build_index
    long = "word " * 40  # longer than 150 characters: never a candidate
    docs = spark.createDataFrame([
        (1, "test", "f_one", long, "parse json config"),
        (2, "test", "f_two", long, "open ssh session"),
        (3, "train", "f_three", "x", "unrelated text"),
    ], "id long, split string, func_name string, docstring string, lexical_document string")
    idx = build_index(docs.select("id", "split", "func_name", "lexical_document")).materialized()
    ex = report.example_queries(idx, docs).orderBy("example_rank").collect()
    assert [r["example_rank"] for r in ex] == [1, 2, 3, 4, 5, 6]
    assert all(r["doc_id"] is None for r in ex)
    # copies: the same docstring on two lines counts once, at its first qualifying line
    docs2 = spark.createDataFrame([
        (10, "test", "a", "parse json", "parse json"),
        (11, "test", "b", "parse json", "parse json"),
        (12, "test", "c", "open ssh", "open ssh session"),
    ], "id long, split string, func_name string, docstring string, lexical_document string")
    idx2 = build_index(docs2.select("id", "split", "func_name", "lexical_document")).materialized()
    ex2 = [(r["example_rank"], r["query_text"], r["doc_id"])
           for r in report.example_queries(idx2, docs2).orderBy("example_rank").collect()]
    assert ex2 == [(1, "parse json", 10), (2, "open ssh", 12)]


def test_sanity_check_run(pipeline):
    stats = ingest.corpus_stats(pipeline.prepared)
    samples = quality.sanity_check(pipeline.documents, pipeline.metadata, stats)
    assert samples.count() == 9
    with pytest.raises(quality.QualityError, match="id mismatch|count mismatch"):
        quality.sanity_check(pipeline.documents, pipeline.metadata.filter(F.col("id") % 5 != 0), stats)
    with pytest.raises(quality.QualityError, match="missing split"):
        quality.sanity_check(pipeline.documents, pipeline.metadata, stats.filter("split != 'valid'"))
