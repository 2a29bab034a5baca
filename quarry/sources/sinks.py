"""Writers and readers for the pipeline's tables.

* processed corpus: documents and metadata partitioned by ``split`` (JSON
  lines or parquet), the nested statistics document as JSON;
* index: documents, vocabulary, statistics as parquet and the posting lists as a
  table bucketed by document bucket (re-registered over its files on read, so the
  query phase keeps its no-exchange layout);
* vectors and query vectors as parquet; evaluation results as one nested
  JSON row; tolerant result reads (missing or corrupt -> ``None``).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.index import BM25Index

# Error conditions of a path that does not exist or holds no record
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_processed(documents: DataFrame, metadata: DataFrame, out_dir: str,
                    fmt: str = "json") -> None:
    documents.write.mode("overwrite").partitionBy("split").format(fmt) \
        .save(f"{out_dir}/documents")
    metadata.write.mode("overwrite").partitionBy("split").format(fmt) \
        .save(f"{out_dir}/metadata")


def read_processed(spark: SparkSession, out_dir: str, splits=None, fmt: str = "json",
                   table: str = "documents") -> DataFrame:
    """Processed table restricted to ``splits`` (partition pruning)."""
    df = spark.read.format(fmt).load(f"{out_dir}/{table}")
    return df.filter(F.col("split").isin(list(splits))) if splits else df


def write_stats(nested_stats: DataFrame, path: str) -> None:
    nested_stats.coalesce(1).write.mode("overwrite").json(path)


def read_split_totals(spark: SparkSession, path: str) -> DataFrame:
    """``(split, kept_records)`` from a statistics document; empty when the
    document does not exist."""
    try:
        s = spark.read.json(path)
    except AnalysisException as e:  # a missing file means "no totals"; any other failure is one
        if e.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], "split string, kept_records long")
    return s.select(F.explode(F.from_json(F.to_json("splits"),
                                          "map<string, struct<kept_records: long>>"))) \
        .select(F.col("key").alias("split"), F.col("value.kept_records").alias("kept_records"))


def read_split_stats(spark: SparkSession, path: str) -> DataFrame:
    """``(split, kept_records, missing_docstring_rate, lexical_token_avg)``
    from a written statistics document."""
    s = spark.read.json(path)
    schema = ("map<string, struct<kept_records: long, missing_docstring_rate: double, "
              "lexical_token_avg: double>>")
    return s.select(F.explode(F.from_json(F.to_json("splits"), schema))).select(
        F.col("key").alias("split"), "value.kept_records", "value.missing_docstring_rate",
        "value.lexical_token_avg")


def write_index(index: BM25Index, out_dir: str) -> None:
    """Full rebuild of the index folder (overwrite), in the index's layout."""
    spark = index.spark
    index.documents.write.mode("overwrite").parquet(f"{out_dir}/documents")
    index.vocabulary.write.mode("overwrite").parquet(f"{out_dir}/vocabulary")
    index.statistics.write.mode("overwrite").parquet(f"{out_dir}/statistics")
    write_summary(index.statistics, f"{out_dir}/summary")
    name = f"quarry_postings_{uuid.uuid4().hex[:12]}"
    index.lists.write.mode("overwrite").bucketBy(index.files, "bucket").sortBy("part", "term") \
        .option("path", f"{out_dir}/postings").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    spark.createDataFrame([(index.files, index.parts)], "files int, parts int").write.mode("overwrite") \
        .json(f"{out_dir}/postings_layout")


def write_summary(statistics: DataFrame, path: str) -> None:
    """The index summary: the one-row statistics as a JSON document."""
    statistics.coalesce(1).write.mode("overwrite").json(path)


def read_index(spark: SparkSession, out_dir: str) -> BM25Index:
    """Open a written index; the posting lists are registered as a bucketed
    table over the existing files."""
    layout = spark.read.json(f"{out_dir}/postings_layout").first()
    name = f"quarry_postings_{uuid.uuid4().hex[:12]}"
    schema = spark.read.parquet(f"{out_dir}/postings").schema  # id type follows the corpus
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (bucket) "
              f"SORTED BY (part, term) INTO {layout['files']} BUCKETS LOCATION '{out_dir}/postings'")
    lists = spark.table(name)
    lists.schema  # resolves the plan while the entry exists  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return BM25Index(spark.read.parquet(f"{out_dir}/documents"), lists,
                     spark.read.parquet(f"{out_dir}/vocabulary"),
                     spark.read.parquet(f"{out_dir}/statistics"), layout["files"], layout["parts"])


def write_vectors(vectors: DataFrame, path: str, key: str = "doc_id",
                  partition_by: str | None = None) -> None:
    """Vectors stored as ``array<float>`` keyed by id."""
    out = vectors.withColumn("embedding", F.col("embedding").cast("array<float>"))
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def evaluation_result(setup: dict, statistics: DataFrame, metrics: DataFrame,
                      samples_nested: DataFrame) -> DataFrame:
    """One row: ``evaluation_setup``, ``index_statistics``, ``metrics`` and
    ``sample_rankings`` (array of per-query structs ordered by query id).
    All inputs are one-row tables or the few sample queries; they are
    aggregated to single rows and joined on a constant key."""
    spark = metrics.sparkSession
    setup_df = spark.createDataFrame([tuple(str(v) for v in setup.values())],
                                     ", ".join(f"`{k}` string" for k in setup))
    one = F.lit(1).alias("_k")
    parts = [
        setup_df.select(one, F.struct(*setup_df.columns).alias("evaluation_setup")),
        statistics.select(one, F.struct(*statistics.columns).alias("index_statistics")),
        metrics.select(one, F.struct(*metrics.columns).alias("metrics")),
        samples_nested.groupBy(one).agg(
            F.array_sort(F.collect_list(F.struct(*samples_nested.columns))).alias("sample_rankings")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_k", "left")
    return out.drop("_k")


def write_result(result: DataFrame, path: str) -> None:
    result.coalesce(1).write.mode("overwrite").json(path)


def read_result(spark: SparkSession, path: str) -> DataFrame | None:
    """Tolerant read of an evaluation result: ``None`` when absent or corrupt."""
    try:
        df = spark.read.json(path)
    except AnalysisException as e:
        if e.getCondition() not in ABSENT:
            raise
        return None
    if "_corrupt_record" in df.columns or "metrics" not in df.columns:
        return None
    return df
