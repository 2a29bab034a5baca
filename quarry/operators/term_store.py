"""Term-clustered copy of the posting lists for look-ups of a few terms.

The index lays lists out by document bucket, so a look-up there opens every
bucket.  This copy is range-partitioned by term (a hot term's lists may span
several files) and sorted inside a file, with a Bloom filter on the term column;
a manifest names each file's first and last term.  A look-up reads the manifest
rows that can hold its terms and opens those files alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.index import BM25Index
from quarry.session import scratch_path

LISTS_PER_FILE = 200_000  # lists are short but for hot terms: about 50-100 MB


class TermStore:
    """The copy in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.manifest = spark.read.parquet(f"{path}/manifest")

    def files(self, terms: list[str]) -> list[str]:
        """Files that can hold one of ``terms``: as many as terms, but for
        terms whose lists span files."""
        inside = [(F.col("first") <= t) & (F.col("last") >= t) for t in terms]
        if not inside:
            return []
        return sorted(r["file"] for r in self.manifest.filter(reduce(lambda a, b: a | b, inside)).collect())

    def postings(self, terms: list[str]) -> DataFrame:
        """``(term, doc_id, term_frequency)`` of ``terms``."""
        schema = self.spark.read.parquet(f"{self.path}/lists").schema
        files = self.files(terms)
        lists = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        return lists.filter(F.col("term").isin(list(terms))).select("term", F.inline("docs")) \
            .select("term", "doc_id", "term_frequency")


def write_term_store(index: BM25Index, path: str | None = None, files: int | None = None) -> TermStore:
    """Writes the copy of ``index``'s lists to ``path`` (by default a fresh
    folder in the shared one) in ``files`` files, by default as many as their
    number asks for."""
    spark = index.spark
    path = path or scratch_path(spark, "term_store")
    lists = index.lists.select("term", "bucket", "part", "docs")
    files = files or max(1, -(-lists.count() // LISTS_PER_FILE))
    ordered = lists.repartitionByRange(files, "term", "bucket", "part").sortWithinPartitions("term", "bucket", "part")
    ordered.write.mode("overwrite").option("parquet.bloom.filter.enabled#term", "true") \
        .option("parquet.bloom.filter.expected.ndv#term", str(LISTS_PER_FILE)).parquet(f"{path}/lists")
    spark.read.parquet(f"{path}/lists").select("term", F.input_file_name().alias("file")).groupBy("file").agg(
        F.min("term").alias("first"), F.max("term").alias("last")).write.mode("overwrite").parquet(f"{path}/manifest")
    return TermStore(spark, path)
