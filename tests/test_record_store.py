"""Tables stored by id: rows as without the store, and what the plans move."""

import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import report
from quarry.operators.record_store import RecordStore
from quarry.plans.pipeline import Pipeline
from quarry.session import settings

SF001 = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def p(spark):
    return Pipeline(spark, SF001)


@pytest.fixture(scope="module")
def store(p):
    return RecordStore.build(p.documents, p.metadata, 16)


def test_lookup_without_exchange(spark, p, store):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = store.lookup()
        assert "SortMergeJoin" in plan(found) and "Exchange" not in plan(found)
        assert "Exchange" in plan(report.document_lookup(p.documents, p.metadata))
        assert rows(found) == rows(report.document_lookup(p.documents, p.metadata))


def test_cards_move_no_text(spark, p, store):
    ranked = spark.createDataFrame([("q", i, 1.5, r) for r, i in enumerate((3, 7, 7, 199, 10**9), 1)],
                                   "query_id string, doc_id long, score double, rank int")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        cards = store.cards(ranked)
        moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", formatted(cards))
        assert moved and not any("code#" in x or "docstring#" in x for x in moved)
        plain = report.result_cards(ranked, documents=p.documents, metadata=p.metadata)
        assert any("code#" in x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", formatted(plain)))
        assert rows(cards) == rows(plain)


def test_point_lookups_open_their_buckets(spark, store):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        some = store.get([3, 150, 10**9])
        opened = [int(x) for x in re.findall(r"SelectedBucketsCount: (\d+) out of 16", formatted(some))]
        assert len(opened) == 2 and max(opened) <= 3
        assert rows(some) == rows(store.lookup().filter(F.col("id").isin(3, 150))) and some.count() == 2


def test_nulls_repeated_ids_and_empty_tables(p):
    docs = p.documents.withColumn("id", F.when(F.col("id") % 5 != 0, F.col("id") % 50))
    meta = p.metadata.filter("id % 3 = 0")
    for d, m in ((docs, meta), (docs.filter("false"), meta), (docs, meta.filter("false"))):
        assert rows(RecordStore.build(d, m, 4).lookup()) == rows(report.document_lookup(d, m))
