"""Serving BM25 search (and optionally the dense rerank) over a stream of
queries with Structured Streaming.

The reference answers one typed query at a time against a loaded index.  The
Spark form is a stream of query records ``(query_id, query_text)`` (files
landing in a folder, a Kafka topic, ...) where every micro-batch is searched
as one batch against the stored index: ``foreachBatch`` hands the batch to
the same batch operators (broadcast query terms, doc-partitioned postings,
per-query top-k) and writes the results to the batch's own ``epoch=n`` folder,
overwriting it, so a batch that is run again after a failure replaces its rows.
No state is kept between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import search
from quarry.operators.index import BM25Index
from quarry.session import scratch_path

QUERY_SCHEMA = "query_id string, query_text string"


def query_stream(spark: SparkSession, path: str, fmt: str = "json",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of query records read from files in ``path``."""
    reader = spark.readStream.format(fmt).schema(QUERY_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def search_batch(index: BM25Index, batch: DataFrame, top_k: int,
                 query_vectors=None, doc_vectors=None, bm25_candidates: int = 50) -> DataFrame:
    """Results of one micro-batch: BM25 top-k rows tagged ``pipeline='bm25'``
    and, when an encoder and document vectors are given, the rerank of
    ``max(candidates, top_k)`` candidates tagged ``'rerank'``.  Blank queries
    give no rows."""
    q = batch.filter(T.strip(F.coalesce("query_text", F.lit(""))) != "")
    depth = max(bm25_candidates, top_k)
    cands = search.bm25_topk(index, q, depth)
    out = cands.filter(F.col("rank") <= top_k).select(
        "query_id", F.lit("bm25").alias("pipeline"), F.col("rank").cast("long").alias("rank"),
        "doc_id", "score", F.col("score").alias("bm25_score"))
    if query_vectors is not None and doc_vectors is not None:
        from quarry.operators.rerank import rerank
        rr = rerank(cands, query_vectors(q), doc_vectors, top_k)
        out = out.unionByName(rr.select("query_id", F.lit("rerank").alias("pipeline"), "rank",
                                        "doc_id", "score", "bm25_score"))
    return out


def start_search_stream(index: BM25Index, queries: DataFrame, output_path: str,
                        checkpoint_location: str | None = None, top_k: int = 10,
                        trigger: dict | None = None,
                        query_vectors=None, doc_vectors=None, fmt: str = "parquet"):
    """Start the streaming search; returns the ``StreamingQuery``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: process
    what is available and stop).  ``query_vectors`` is an encoder function
    ``DataFrame(query_id, query_text) -> DataFrame(query_id, embedding)``."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        res = search_batch(index, batch, top_k, query_vectors, doc_vectors)
        res.write.mode("overwrite").format(fmt).save(f"{output_path.rstrip('/')}/epoch={epoch_id}")

    location = checkpoint_location or scratch_path(queries.sparkSession, "search-stream")
    writer = (queries.writeStream.foreachBatch(run)
              .option("checkpointLocation", location))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
