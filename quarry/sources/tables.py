"""Readers for the driver's parquet tables and their mapping onto the
code-search record shape.

Mapping (one raw record per ``documents`` row):

* ``id``            = ``doc_id`` (numeric, so ties break numerically)
* ``split``         = ``test`` / ``valid`` / ``train`` by ``doc_id`` mod 20
                      (0 / 1 / rest: the 5 % / 5 % / 90 % split ratio)
* ``func_name``     = ``source || '_' || lang``
* docstring         = first line of ``text``
* code              = text after the first newline; without one the fallback
                      field, the whole text, is the code, so no text is lost
* ``ordinal``       = ``doc_id`` (the order of the corpus)
* metadata          = ``language = lang``, ``repository_name = source`` and a
                      path / URL built from ``doc_id``
* vectors           = ``embeddings`` row with ``vec_id = doc_id``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPLITS = ("train", "valid", "test")


def split_of(doc_id) -> F.Column:
    m = F.pmod(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(20))
    return F.when(m == 0, "test").when(m == 1, "valid").otherwise("train")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as raw code-search records (one per row)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"),
        split_of("doc_id").alias("split"),
        F.col("doc_id").alias("ordinal"),
        F.concat_ws("_", "source", "lang").alias("func_name"),
        T.after_first_line("text").alias("func_code_string"),
        F.col("text").alias("whole_func_string"),
        T.first_line("text").alias("func_documentation_string"),
        F.col("lang").alias("language"),
        F.col("source").alias("repository_name"),
        F.format_string("%s/%s/%d.py", F.col("source"), F.col("lang"),
                        F.col("doc_id")).alias("func_path_in_repository"),
        F.format_string("repo://%s/blob/main/%s/%d.py", F.col("source"), F.col("lang"),
                        F.col("doc_id")).alias("func_code_url"),
    )


def stored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored document vectors keyed by document id: ``(doc_id, embedding)``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("doc_id"), "embedding")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc query texts (no relevance judgements): ``(query_id, query_text)``."""
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of the conversations as ad-hoc queries."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("query_id"),
        F.col("text").alias("query_text"))
