"""Data-quality checks over the processed corpus.  Each check returns a
DataFrame (a per-split report or the violating rows; empty = pass) and
:func:`assert_clean` turns a violations table into an exception."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T

# The splits the corpus must have and the sample size / seed.
EXPECTED_SPLITS = ("train", "valid", "test")
SAMPLES_PER_SPLIT = 3
SAMPLE_SEED = 13


class QualityError(ValueError):
    pass


def assert_clean(violations: DataFrame, what: str) -> None:
    """Raise when ``violations`` has any row (takes at most one row)."""
    first = violations.take(1)
    if first:
        raise QualityError(f"{what}: {first[0].asDict()}")


def count_check(documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per split: document and metadata row counts and whether they match."""
    d = documents.groupBy("split").agg(F.count(F.lit(1)).alias("documents"))
    m = metadata.groupBy("split").agg(F.count(F.lit(1)).alias("metadata"))
    j = d.join(m, "split", "full_outer")
    return j.select("split", F.coalesce("documents", F.lit(0)).alias("documents"),
                    F.coalesce("metadata", F.lit(0)).alias("metadata")) \
        .withColumn("counts_match", F.col("documents") == F.col("metadata"))


def id_mismatch(documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows whose id is in only one of the two tables: ``(split, id, side)``."""
    d = documents.select("split", "id", F.lit(True).alias("_d"))
    m = metadata.select("split", "id", F.lit(True).alias("_m"))
    j = d.join(m, ["split", "id"], "full_outer")
    return j.filter(F.col("_d").isNull() | F.col("_m").isNull()).select(
        "split", "id", F.when(F.col("_d").isNull(), "metadata_only")
        .otherwise("documents_only").alias("side"))


def id_report(documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per split: matched ids, ids only in documents, ids only in metadata,
    and distinct id counts on each side."""
    def rows_by_id(df, name):
        return df.groupBy("split", "id").agg(F.count(F.lit(1)).alias(name))

    # one row per id and side: distinct counts are plain counts, by the join's own partitioning
    j = rows_by_id(documents, "_d").join(rows_by_id(metadata, "_m"), ["split", "id"], "full_outer")
    both = F.col("_d").isNotNull() & F.col("_m").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return j.groupBy("split").agg(
        total(F.when(both, F.col("_d") * F.col("_m"))).alias("matched_ids"),
        total(F.when(F.col("_m").isNull(), F.col("_d"))).alias("documents_only"),
        total(F.when(F.col("_d").isNull(), F.col("_m"))).alias("metadata_only"),
        F.count("_d").alias("distinct_document_ids"),
        F.count("_m").alias("distinct_metadata_ids"),
    )


def empty_fields(documents: DataFrame) -> DataFrame:
    """Per split: documents and how many have a blank name, code or lexical text."""
    def blank(c):
        return T.strip(F.coalesce(F.col(c), F.lit(""))) == ""
    return documents.groupBy("split").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(blank("func_name")).alias("empty_func_name"),
        F.count_if(blank("code")).alias("empty_code"),
        F.count_if(blank("lexical_document")).alias("empty_lexical_document"),
    )


def sample(documents: DataFrame, n: int = SAMPLES_PER_SPLIT, seed: int = SAMPLE_SEED) -> DataFrame:
    """A seeded sample of ``n`` documents per split (order key
    ``md5(seed:id)``), with previews.  The per-split top-n keeps only n rows
    per partition before its exchange."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    w = Window.partitionBy("split").orderBy(key, "id")
    s = documents.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= n)
    return s.select(
        "split", F.col("sample_rank").cast("long").alias("sample_rank"), "id", "func_name",
        "has_docstring", "lexical_token_count",
        T.preview("docstring").alias("docstring_preview"),
        T.preview("code").alias("code_preview"),
        T.preview("lexical_document").alias("lexical_preview"))


def split_stats_present(stats: DataFrame, expected=EXPECTED_SPLITS) -> DataFrame:
    """For every expected split: whether statistics exist, with kept records,
    missing-docstring rate and average tokens."""
    spark = stats.sparkSession
    exp = spark.createDataFrame([(s,) for s in expected], "split string")
    j = exp.join(stats.select("split", "kept_records", "missing_docstring_rate",
                              "lexical_token_avg"), "split", "left")
    return j.select("split", F.col("kept_records").isNotNull().alias("present"),
                    "kept_records", "missing_docstring_rate", "lexical_token_avg")


def vector_alignment(queries: DataFrame, query_vectors: DataFrame,
                     doc_vectors: DataFrame) -> DataFrame:
    """Query/vector alignment by key: queries, queries with a vector, vectors
    without a query, and the vector dimensions seen (must be one value)."""
    q = queries.select("query_id", F.lit(True).alias("_q"))
    v = query_vectors.select("query_id", F.lit(True).alias("_v"))
    j = q.join(v, "query_id", "full_outer")
    a = j.agg(F.count_if(F.col("_q").isNotNull()).alias("queries"),
              F.count_if(F.col("_q").isNotNull() & F.col("_v").isNotNull()).alias("queries_with_vector"),
              F.count_if(F.col("_q").isNull()).alias("vectors_without_query"))
    d = doc_vectors.agg(F.count(F.lit(1)).alias("n"),
                        F.min(F.size("embedding")).cast("long").alias("lo"),
                        F.max(F.size("embedding")).cast("long").alias("hi")).first()
    return a.select("*", F.lit(d["n"]).cast("long").alias("document_vectors"),
                    F.lit(d["lo"]).cast("long").alias("min_dimension"),
                    F.lit(d["hi"]).cast("long").alias("max_dimension"))


def sanity_check(documents: DataFrame, metadata: DataFrame, stats: DataFrame,
                 splits=EXPECTED_SPLITS, n: int = SAMPLES_PER_SPLIT,
                 seed: int = SAMPLE_SEED) -> DataFrame:
    """The corpus validation run: statistics present for every split, equal
    document / metadata counts and id sets, no blank name, code or lexical
    text.  Raises :class:`QualityError` on the first failed check (each check
    fetches at most one violating row); returns the seeded sample with
    previews for inspection."""
    present = split_stats_present(stats, splits)
    assert_clean(present.filter(~F.col("present")), "missing split statistics")
    docs = documents.filter(F.col("split").isin(list(splits)))
    meta = metadata.filter(F.col("split").isin(list(splits)))
    assert_clean(count_check(docs, meta).filter(~F.col("counts_match")), "count mismatch")
    assert_clean(id_mismatch(docs, meta), "id mismatch")
    blank = empty_fields(docs).filter(
        (F.col("empty_func_name") + F.col("empty_code") + F.col("empty_lexical_document")) > 0)
    assert_clean(blank, "empty fields")
    return sample(docs, n, seed)
