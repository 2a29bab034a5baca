"""Counters taken while the corpus is stored, against the grouped statistics."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import ingest
from quarry.plans.catalog import _flawed_records
from quarry.plans.pipeline import Pipeline
from quarry.sources import tables

SF001 = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def test_counters_equal_grouped_statistics(spark):
    raw = _flawed_records(spark, SF001)  # all three drop reasons
    corpus = ingest.build_corpus(raw, tables.SPLITS)
    want = ingest.corpus_stats(ingest.prepare(raw), tables.SPLITS)
    assert rows(corpus.stats) == rows(want) and corpus.stats.schema.simpleString() == want.schema.simpleString()
    assert scans(corpus.stats) == 0 and scans(corpus.documents) == 1  # no second read for the statistics
    total = corpus.stats.agg(F.sum("dropped_missing_name"), F.sum("dropped_missing_code"),
                             F.sum("dropped_empty_lexical")).first()
    assert min(total) > 0
    assert rows(ingest.build_corpus(raw).stats) == rows(ingest.corpus_stats(ingest.prepare(raw)))


def test_counters_of_given_splits_only(spark):
    raw = tables.raw_records(spark, SF001).withColumn(
        "split", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "a.b").otherwise("c"))
    some = ["a.b", "none of these", "c"]
    stats = ingest.build_corpus(raw, some).stats
    assert rows(stats) == rows(ingest.corpus_stats(ingest.prepare(raw), some))
    assert {r["split"]: r["raw_records"] > 0 for r in stats.collect()} == {
        "a.b": True, "none of these": False, "c": True}


def test_counters_of_an_empty_table(spark):
    raw = tables.raw_records(spark, SF001).filter("id < 0")
    for empty in (raw, spark.createDataFrame([], raw.schema)):
        stats = ingest.build_corpus(empty, ["train"]).stats.collect()
        assert [(r["split"], r["raw_records"], r["document_char_avg"]) for r in stats] == [("train", 0, 0.0)]


def test_counters_of_the_pipeline(spark):
    p = Pipeline(spark, SF001)
    lazy = Pipeline(spark, SF001, materialize=False)
    assert rows(p.corpus_stats) == rows(lazy.corpus_stats) and scans(p.corpus_stats) == 0
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    paths = {s: os.path.join(d, f"{s}.jsonl") for s in ("train", "valid")}
    for s, names in (("train", ["f", "", "g"]), ("valid", [])):
        with open(paths[s], "w", encoding="utf-8") as fh:
            fh.write("".join(json.dumps({"func_name": n, "func_code_string": "x = 1"}) + "\n" for n in names))
    stats = {r["split"]: r for r in Pipeline.from_jsonl(spark, paths).corpus_stats.collect()}
    assert (stats["train"]["raw_records"], stats["train"]["dropped_missing_name"]) == (3, 1)
    assert stats["valid"]["raw_records"] == 0
