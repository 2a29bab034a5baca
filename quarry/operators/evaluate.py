"""Evaluation of rankings against one relevant document per query:
MRR@10, Recall@10, Recall@50 and nDCG@10, plus the per-query values and the
sample report.  All closed-form on the rank column; the only joins are the
small ranking-to-judgement join and the per-query left join that keeps
queries without hits in the denominator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numeric import round6
from quarry.operators.ingest import file_order

# Evaluation cut-offs of the reference.
EVAL_DEPTH = 50
SAMPLE_QUERIES = 5
SAMPLE_RESULTS = 5


def build_queries(documents: DataFrame, split: str = "test",
                  max_queries: int | None = None) -> DataFrame:
    """Query records from a split's documents with a non-blank docstring:
    ``(query_id, query_text, relevant_doc_id, func_name, ordinal)``.
    ``max_queries`` keeps the first n in file order (after the blank filter)."""
    q = (documents.filter(F.col("split") == split)
         .select(F.col("id").alias("query_id"), T.strip("docstring").alias("query_text"),
                 F.col("id").alias("relevant_doc_id"), "func_name", file_order(documents))
         .filter(F.col("query_text") != ""))
    if max_queries is not None:
        q = q.orderBy("ordinal", "query_id").limit(max_queries)
    return q


def evaluation_depth(top_k: int) -> int:
    return max(top_k, EVAL_DEPTH)


def per_query(queries: DataFrame, ranking: DataFrame) -> DataFrame:
    """Per query: the rank of its relevant document (null when not ranked)
    and its reciprocal rank, recall and nDCG contributions."""
    hits = ranking.select(F.col("query_id").alias("_q"), F.col("doc_id").alias("_d"),
                          F.col("rank").alias("relevant_rank"))
    j = queries.join(hits, (F.col("query_id") == F.col("_q")) &
                     (F.col("relevant_doc_id") == F.col("_d")), "left")
    r = F.col("relevant_rank")
    return j.select(
        "query_id", "relevant_rank",
        F.when(r <= 10, F.lit(1.0) / r).otherwise(F.lit(0.0)).alias("rr_at_10"),
        F.when(r <= 10, F.lit(1.0)).otherwise(F.lit(0.0)).alias("recall_at_10"),
        F.when(r <= 50, F.lit(1.0)).otherwise(F.lit(0.0)).alias("recall_at_50"),
        F.when(r <= 10, F.lit(1.0) / F.log2(r + F.lit(1))).otherwise(F.lit(0.0))
        .alias("ndcg_at_10"),
    )


def metrics(per_query_df: DataFrame) -> DataFrame:
    """One row: query_count and the four means rounded to 6 decimals."""
    a = per_query_df.agg(F.count(F.lit(1)).alias("query_count"),
                         F.sum("rr_at_10").alias("s_rr"), F.sum("recall_at_10").alias("s_r10"),
                         F.sum("recall_at_50").alias("s_r50"), F.sum("ndcg_at_10").alias("s_ndcg"))
    n = F.greatest(F.col("query_count"), F.lit(1))
    return a.select(
        "query_count",
        round6(F.col("s_rr") / n).alias("mrr_at_10"),
        round6(F.col("s_r10") / n).alias("recall_at_10"),
        round6(F.col("s_r50") / n).alias("recall_at_50"),
        round6(F.col("s_ndcg") / n).alias("ndcg_at_10"),
    )


def sample_rankings(queries: DataFrame, ranking: DataFrame,
                    n_queries: int = SAMPLE_QUERIES, n_results: int = SAMPLE_RESULTS,
                    extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """The first ``n_queries`` queries in file order with their top
    ``n_results`` rows (flat: one row per (query, rank))."""
    first = queries.orderBy("ordinal", "query_id").limit(n_queries) \
        .select("query_id", "func_name", "query_text")
    top = ranking.filter(F.col("rank") <= n_results) \
        .select("query_id", "rank", "doc_id", "score", *extra_cols)
    return first.join(top, "query_id", "left")


def sample_rankings_nested(flat: DataFrame, extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """Nested form: one row per sample query with ``top_results`` as an
    ordered ``array<struct>``."""
    res = F.struct("rank", "doc_id", "score", *extra_cols)
    return flat.groupBy("query_id", "func_name", "query_text").agg(
        F.array_sort(F.filter(F.collect_list(res), lambda x: x["rank"].isNotNull()))
        .alias("top_results"))
