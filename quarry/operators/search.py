"""BM25 search over a batch of queries.

The ranking (:func:`bm25_topk`) is one scan of the stored posting lists for any
number of queries (``blockmax``): the weighted queries are sent to the document
buckets, which return at most k documents a query each, and only those move to
the final cut (``WindowGroupLimit``).

:func:`bm25_scores` is the form over all pairs: the query terms, one row a term
with its queries, are joined to the posting lists by term, and a document bucket
sums the impacts of one query after another and hands the rows on at once, so the
pairs are neither shuffled, hashed nor spilled.  The query terms are broadcast
behind a count; beyond the limit the queries are dealt into chunks within it, each
with a scan of the lists of its own, so the lists are not shuffled either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numeric import from_fixed, to_fixed
from quarry.operators import blockmax
from quarry.operators.index import LAYOUT, BM25Index
from quarry.session import materialize, settings

# Rows of (query, term, idf) that may be broadcast to every executor
# (about 40 bytes each: ~40 MB at the limit).
BROADCAST_ROW_LIMIT = 1_000_000


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term)``: distinct tokens of each query (query term
    frequency is ignored; an empty query has no rows)."""
    return queries.select("query_id", F.explode(
        F.array_distinct(T.tokenize(F.coalesce(F.col("query_text"), F.lit(""))))).alias("term"))


def weighted_terms(index: BM25Index, qterms: DataFrame, small: bool = False) -> DataFrame:
    """``(term, query_id, idf)``; out-of-vocabulary terms drop.  With
    ``small`` (query terms counted within the broadcast limit) the query
    terms are broadcast into the vocabulary scan."""
    q = F.broadcast(qterms) if small else qterms
    return index.vocabulary.select("term", "idf").join(q, "term").select("term", "query_id", "idf")


def scoring_constants(index: BM25Index) -> dict:
    """avgdl, k1 and b from the one-row statistics, folded into the impact
    expression as literals (not carried on every row)."""
    s = index.statistics.select("average_document_length", "k1", "b").first()
    return {"avgdl": s["average_document_length"], "k1": s["k1"], "b": s["b"]}


def within_limit(df: DataFrame, limit: int, bound: int | None = None) -> bool:
    """True when ``df`` has at most ``limit`` rows: ``bound`` is a proven upper
    bound supplied by the caller, else the rows are counted."""
    return (bound if bound is not None else df.count()) <= limit


def bounded_broadcast(df: DataFrame, limit: int = None, bound: int | None = None) -> DataFrame:
    """Broadcast ``df`` only behind a size check; otherwise leave the join to
    a shuffle (adaptive execution splits skewed partitions)."""
    limit = BROADCAST_ROW_LIMIT if limit is None else limit
    return F.broadcast(df) if within_limit(df, limit, bound) else df


def impact(avgdl: float, k1: float, b: float, tf="term_frequency", dl="doc_length") -> F.Column:
    """BM25 term weight, in the reference's operation order."""
    tf, dl = F.col(tf), F.col(dl)
    k1, b, avgdl = F.lit(float(k1)), F.lit(float(b)), F.lit(float(avgdl))
    return F.col("idf") * (tf * (k1 + F.lit(1.0))) / (tf + k1 * (F.lit(1.0) - b + b * dl / avgdl))


def bm25_scores(index: BM25Index, queries: DataFrame,
                broadcast_limit: int = BROADCAST_ROW_LIMIT, n_terms: int | None = None) -> DataFrame:
    """``(query_id, doc_id, score_fp)``: summed impacts of every document
    sharing at least one term with the query, as an exact fixed-point sum."""
    qterms = query_terms(queries)
    # the vocabulary join only drops rows, so the query-term count bounds it
    n = n_terms if n_terms is not None else qterms.count()
    small, lists, constants = n <= broadcast_limit, blockmax.bucket_lists(index, "term"), scoring_constants(index)
    chunks = 1 if small or broadcast_limit < 1 else -(-n // broadcast_limit)  # without a limit to keep: a shuffle join
    chunk = F.pmod(F.xxhash64("query_id"), F.lit(chunks)).alias("chunk")
    by_term = materialize(weighted_terms(index, qterms, small).groupBy("term", "idf", chunk).agg(
        F.collect_list(F.struct("query_id")).alias("asked")), "query_lists")
    own = lambda c: by_term.filter(F.col("chunk") == c).drop("chunk")
    joined = [lists.join(F.broadcast(own(c)) if small or chunks > 1 else own(c), "term") for c in range(chunks)]
    return reduce(DataFrame.unionByName, [blockmax.score_buckets(asked, constants) for asked in joined])


def postings_for_terms(index: BM25Index, terms: list[str]) -> DataFrame:
    """Point lookup of the postings of a few terms (ad hoc): the ``IN``
    filter is pushed to the parquet scan, where the per-bucket term order
    lets row groups be skipped.  It opens every bucket; many look-ups use the
    term-clustered copy (``term_store``), batches of queries the ranking."""
    return index.lists.filter(F.col("term").isin(list(terms))) \
        .select("term", F.inline("docs")).select("term", "doc_id", "term_frequency")


def rank_by(df: DataFrame, partition: str, *order, k: int | None = None,
            rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(partition).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked.filter(F.col(rank_col) <= k) if k is not None else ranked


def _topk(scores: DataFrame, k: int) -> DataFrame:
    top = rank_by(scores, "query_id", F.desc("score_fp"), F.asc("doc_id"), k=k)
    return top.select("query_id", "rank", "doc_id",
                      from_fixed("score_fp").alias("score"), "score_fp")


def weighted_queries(index: BM25Index, queries: DataFrame) -> DataFrame:
    """``(query_id, terms, idfs)``: one row per query with a known term."""
    wt = weighted_terms(index, query_terms(queries)).groupBy("query_id").agg(
        F.collect_list(F.struct("term", "idf")).alias("t"))
    return wt.select("query_id", F.col("t.term").alias("terms"), F.col("t.idf").alias("idfs"))


def bm25_topk(index: BM25Index, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, doc_id, score, score_fp)`` for ranks 1..k; ties on
    the score break by ``doc_id`` ascending.  Any number of queries is one scan
    of the posting lists, pruned by block maxima (``blockmax``); the result is
    stored."""
    weighted = materialize(weighted_queries(index, queries), "weighted_queries")
    constants, first = scoring_constants(index), blockmax.first_buckets(index)
    with settings(index.spark, blockmax.KEEP_BUCKETS):
        if not first:
            return materialize(_topk(blockmax.rank_buckets(index, weighted, k, constants), k), "ranking")
        begun = materialize(_topk(blockmax.rank_buckets(index, weighted, k, constants, only=first), k), "first_ranking")
        kth = begun.filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score_fp").alias("least"))
        weighted = materialize(weighted.join(kth, F.col("query_id").eqNullSafe(F.col("_q")), "left")
                               .select("query_id", "terms", "idfs", F.coalesce("least", F.lit(0)).alias("least")), "bounded_queries")
        others = blockmax.rank_buckets(index, weighted, k, constants, but=first)
        return materialize(_topk(begun.select("query_id", "doc_id", "score_fp").unionByName(others), k), "ranking")


def bm25_topk_exhaustive(index: BM25Index, queries: DataFrame, k: int) -> DataFrame:
    """The same rows from the scores of all pairs, by relational operators
    only: the plan that :func:`bm25_topk` is compared with."""
    return _topk(bm25_scores(index, queries), k)


def search(index: BM25Index, query_texts: DataFrame, top_k: int = 10) -> DataFrame:
    """Ad-hoc search: any ``(query_id, query_text)`` table; one row per query
    is one search.  Blank queries return nothing."""
    return bm25_topk(index, query_texts, top_k)
