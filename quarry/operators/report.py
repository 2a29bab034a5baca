"""Report operators: document lookup, enriched result tables, the two-pipeline
comparison, the metrics table and the self-retrieving example queries.

Lookups are late-materialised: the ranked rows (bounded by queries x k) are
counted and broadcast, the large document table is streamed through an inner
join, and only the matched rows are joined back to the ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.search import BROADCAST_ROW_LIMIT, bm25_topk, bounded_broadcast
from quarry.operators.index import BM25Index
from quarry.operators.ingest import file_order

# Metadata fields that override the document's, and the
# example-query rules (length limit, count, fallback texts).
OVERRIDE_FIELDS = ("repository_name", "func_path_in_repository", "func_code_url", "language")
EXAMPLE_MAX_CHARS = 150
EXAMPLE_COUNT = 8
EXAMPLE_BATCH, EXAMPLE_MOST = 64, 65_536  # candidates of the first search, and of the last one but all others
FALLBACK_EXAMPLES = (
    "read a json file and return a dict",
    "establish an ssh connection",
    "compute the sha256 hash of a string",
    "split a list into chunks of size n",
    "download a url and save to disk",
    "parse an iso 8601 timestamp",
)
METRIC_ROWS = (("query_count", "Queries evaluated"), ("mrr_at_10", "MRR@10"),
               ("recall_at_10", "Recall@10"), ("recall_at_50", "Recall@50"),
               ("ndcg_at_10", "nDCG@10"))


def document_lookup(documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """Documents left-joined with their metadata by id; the four metadata
    fields apply only when non-empty."""
    m = metadata.select("id", *[F.col(k).alias(f"_m_{k}") for k in OVERRIDE_FIELDS])
    j = documents.join(m, "id", "left")
    return j.select(*documents.columns,
                    *[T.blank_to_null(F.col(f"_m_{k}")).alias(k) for k in OVERRIDE_FIELDS])


def lookup(ranked: DataFrame, records: DataFrame, key: str = "doc_id",
           record_key: str = "id", broadcast_limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Left join of a small ranked table to a large record table, streaming
    the large side once."""
    ids = ranked.select(F.col(key).alias(record_key)).distinct()
    matched = records.join(bounded_broadcast(ids, broadcast_limit), record_key, "left_semi")
    return ranked.join(matched.withColumnRenamed(record_key, key), key, "left")


def lookup_ranked(ranked: DataFrame, documents: DataFrame, metadata: DataFrame,
                  broadcast_limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Document lookup for ranked rows only: documents and metadata are each
    streamed once through a semi-join against the (counted, broadcast) ranked
    ids, and only the matched rows are joined together and to the ranking."""
    ids = ranked.select(F.col("doc_id").alias("id")).distinct()
    ids = bounded_broadcast(ids, broadcast_limit)
    docs = documents.join(ids, "id", "left_semi")
    meta = metadata.join(ids, "id", "left_semi")
    found = document_lookup(docs, meta).withColumnRenamed("id", "doc_id")
    return ranked.join(found, "doc_id", "left")


def result_cards(ranked: DataFrame, lookup_table: DataFrame | None = None,
                 documents: DataFrame | None = None,
                 metadata: DataFrame | None = None) -> DataFrame:
    """Enriched result rows: rank, id, display name, repository, url,
    scores, docstring, the whole code and its preview of 1800 characters.  Pass ``documents``
    and ``metadata`` (preferred: only ranked ids are looked up) or a prepared
    ``lookup_table``."""
    if documents is not None:
        j = lookup_ranked(ranked, documents, metadata)
    else:
        j = lookup(ranked, lookup_table)
    extra = [c for c in ("bm25_score",) if c in ranked.columns]
    return j.select(
        "query_id", "rank", "doc_id",
        F.coalesce(T.blank_to_null(F.col("func_name")), F.lit(T.UNKNOWN_FUNCTION))
        .alias("display_name"),
        F.coalesce(F.col("repository_name"), F.lit("")).alias("repository_name"),
        F.coalesce(F.col("func_code_url"), F.lit("")).alias("func_code_url"),
        "score", *extra,
        T.strip(F.coalesce(F.col("docstring"), F.lit(""))).alias("docstring"),
        T.strip(F.coalesce(F.col("code"), F.lit(""))).alias("code"),
        T.truncate_code(T.strip(F.coalesce(F.col("code"), F.lit("")))).alias("code_preview"),
    )


def metrics_long(metrics: DataFrame, pipeline: str) -> DataFrame:
    """Unpivot a one-row metrics table to ``(metric, label, value)``."""
    stack = ", ".join(f"'{k}', '{label}', CAST({k} AS DOUBLE)" for k, label in METRIC_ROWS)
    return metrics.selectExpr(f"stack({len(METRIC_ROWS)}, {stack}) AS (metric, label, value)") \
        .withColumnRenamed("value", pipeline)


def metrics_table(bm25_metrics: DataFrame | None, rerank_metrics: DataFrame | None) -> DataFrame:
    """One row per metric, one column per pipeline; null when a pipeline has
    no run (full outer join by metric)."""
    spark = (bm25_metrics or rerank_metrics).sparkSession
    names = spark.createDataFrame([(k, label, i) for i, (k, label) in enumerate(METRIC_ROWS)],
                                  "metric string, label string, position int")
    out = names
    for name, m in (("bm25", bm25_metrics), ("rerank", rerank_metrics)):
        if m is None:
            out = out.withColumn(name, F.lit(None).cast("double"))
        else:
            out = out.join(metrics_long(m, name).drop("label"), "metric", "full_outer")
    return out.select("metric", "label", "position", "bm25", "rerank")


def compare_pipelines(index: BM25Index, query_texts: DataFrame, query_vectors: DataFrame,
                      doc_vectors: DataFrame, top_k: int = 10, bm25_candidates: int = 50,
                      isolate_rerank: bool = True) -> DataFrame:
    """Both pipelines for each query: BM25 top-k and the rerank of
    ``max(candidates, top_k)`` BM25 candidates cut to top-k, tagged by
    ``pipeline``, with the candidate and shown counts per query.  Blank
    queries produce nothing.

    The BM25 candidates are stored once (used three times).  With
    ``isolate_rerank`` the rerank runs as its own job, and if it fails (for
    example a broken encoder) the BM25 rows are still returned, without rerank
    rows and with the failure in ``rerank_error`` (null after a success)."""
    from quarry.operators.rerank import rerank
    from quarry.session import materialize
    q = query_texts.filter(T.strip(F.coalesce("query_text", F.lit(""))) != "")
    depth = max(bm25_candidates, top_k)
    cands = materialize(bm25_topk(index, q, depth), "compare_candidates")
    hits = cands.groupBy("query_id").agg(F.count(F.lit(1)).alias("bm25_hits"))
    bm25_rows = cands.filter(F.col("rank") <= top_k).select(
        "query_id", F.lit("bm25").alias("pipeline"), F.col("rank").cast("long").alias("rank"),
        "doc_id", "score", F.col("score").alias("bm25_score"))
    rr = rerank(cands, query_vectors, doc_vectors, top_k).select(
        "query_id", F.lit("rerank").alias("pipeline"), "rank", "doc_id", "score", "bm25_score")
    error = None
    if isolate_rerank:
        try:
            rr = materialize(rr, "compare_rerank")
        except Exception as e:  # noqa: BLE001 - any failure of the encoder is reported beside the BM25 rows
            rr, error = bm25_rows.limit(0), f"{type(e).__name__}: {e}"[:2000]
    both = bm25_rows.unionByName(rr)
    counts = both.groupBy("query_id", "pipeline").agg(F.count(F.lit(1)).alias("shown"))
    return both.join(hits, "query_id").join(counts, ["query_id", "pipeline"]) \
        .withColumn("rerank_error", F.lit(error).cast("string"))


def example_queries(index: BM25Index, documents: DataFrame, split: str = "test",
                    count: int = EXAMPLE_COUNT, max_chars: int = EXAMPLE_MAX_CHARS,
                    first_batch: int = EXAMPLE_BATCH) -> DataFrame:
    """Docstrings that retrieve their own document at rank 1: candidates are
    the split's documents with a one-line docstring of 1..150 characters, in
    file order; a text counts at its first place that qualifies; the first
    ``count`` texts are kept.  When none qualifies, the fixed fallback texts
    are returned.

    The search widens: the first ``first_batch`` candidates are searched, then
    the next ones, four times as many each time up to ``EXAMPLE_MOST`` (a bounded
    top-n by place), then all others at once, until ``count`` texts qualify.  So
    the work is bounded by where the answer lies, and the jobs are few."""
    spark = documents.sparkSession
    from quarry.session import materialize
    cands = materialize(documents.filter(F.col("split") == split)
                        .withColumn("query_text", T.strip("docstring"))
                        .filter((F.col("query_text") != "") & (F.length("query_text") <= max_chars)
                                & (F.instr("query_text", "\n") == 0))
                        .select(F.col("id").alias("query_id"), "query_text",
                                F.struct(file_order(documents), F.col("id").alias("id")).alias("place")),
                        "example_candidates")
    chosen, size, after = [], first_batch, None
    while len(chosen) < count:
        left = cands if after is None else cands.filter(F.col("place") > after)
        batch = left.orderBy("place").limit(size) if size <= EXAMPLE_MOST else left
        batch = materialize(batch, "example_batch")
        hit = materialize(_own_first(index, batch, count), "example_hits")  # enough, whatever of them is known
        known = {r["query_text"] for r in chosen}
        chosen += [r for r in hit.orderBy("place").collect() if r["query_text"] not in known]
        last = batch.agg(F.max("place").alias("p"), F.count(F.lit(1)).alias("n")).first()
        if last["n"] < size or size > EXAMPLE_MOST:
            break
        after = F.struct(F.lit(last["p"]["ordinal"]).alias("ordinal"), F.lit(last["p"]["id"]).alias("id"))
        size *= 4
    ids = documents.schema["id"].dataType
    rows = [(i, r["query_text"], r["place"]["id"]) for i, r in enumerate(chosen[:count], 1)]
    if rows:
        return spark.createDataFrame(rows, f"example_rank long, query_text string, doc_id {ids.simpleString()}")
    return spark.createDataFrame(
        [(i + 1, t, None) for i, t in enumerate(FALLBACK_EXAMPLES)],
        f"example_rank long, query_text string, doc_id {ids.simpleString()}")


def _own_first(index: BM25Index, cands: DataFrame, count: int) -> DataFrame:
    """``(query_text, place)`` of the first ``count`` texts of ``cands`` that
    retrieve their own document first."""
    top1 = bm25_topk(index, cands.select("query_id", "query_text"), 1)
    hit = cands.join(top1.select("query_id", "doc_id"), "query_id").filter(F.col("doc_id") == F.col("query_id"))
    return hit.groupBy("query_text").agg(F.min("place").alias("place")).orderBy("place").limit(count)
