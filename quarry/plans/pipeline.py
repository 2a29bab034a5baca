"""The end-to-end plan over the driver tables (or raw JSON-lines files),
exposed as lazy stages so the registered queries, the benchmark and the
command line share one definition."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluate as E
from quarry.operators import ingest, search
from quarry.operators.index import BM25Index, build_index
from quarry.operators.record_store import RecordStore
from quarry.sources import tables


class Pipeline:
    """Stages of the code-search pipeline over one scale-factor folder (or
    any raw-record DataFrame).

    Nothing is computed until a stage's DataFrame is acted on.  With
    ``materialize=True`` the tokenized corpus, the index tables, the queries
    and the rankings are stored once - parquet (postings: a table bucketed by
    doc_id) in the folder named by ``spark.checkpoint.dir``, or persisted
    when the session has none - so several reports reuse them and a lost
    executor costs at most the stage being computed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None, materialize: bool = True,
                 top_k: int = 10, query_split: str = "test", raw: DataFrame | None = None,
                 max_queries: int | None = None, splits: tuple[str, ...] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.top_k = top_k
        self.query_split = query_split
        self._raw = raw
        self.max_queries = max_queries
        self.splits = splits

    @classmethod
    def from_jsonl(cls, spark: SparkSession, paths_by_split: dict[str, str],
                   mode: str = "FAILFAST", **kwargs) -> "Pipeline":
        """The pipeline over raw JSON-lines files, one file (or folder) per
        split; record ids are ``{split}-{line}``."""
        from quarry.sources import jsonl
        kwargs.setdefault("splits", tuple(paths_by_split))
        return cls(spark, None, raw=jsonl.read_records(spark, paths_by_split, mode), **kwargs)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        from quarry.session import materialize
        return materialize(df, name)

    # -- corpus -----------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        raw = self._raw if self._raw is not None else tables.raw_records(self.spark, self.sf_dir)
        if self.splits:
            raw = raw.filter(F.col("split").isin(list(self.splits)))
        if not self.materialize:
            return raw
        # tokenization is the costly per-row step: make sure the rows are
        # spread over the tasks (a single-row-group file is read by one task)
        from quarry.session import spread
        return spread(raw, "id")

    @cached_property
    def _stored(self):
        """Prepared records and the counters taken while they were stored; the
        splits of the driver tables are known."""
        return ingest.store_prepared(self.raw, self.splits or (tables.SPLITS if self._raw is None else None))

    @cached_property
    def prepared(self) -> DataFrame:
        return self._stored[0] if self.materialize else ingest.prepare(self.raw)

    @cached_property
    def corpus_stats(self) -> DataFrame:
        """Statistics per split, from the pass that stored the records where the
        splits are known.  Without ``splits`` only those with records."""
        if not self.materialize or self._stored[1] is None:
            return ingest.corpus_stats(self.prepared, self.splits)
        stats = ingest.observed_stats(self.spark, self._stored[1], self.splits or tables.SPLITS)
        return stats if self.splits else stats.filter("raw_records > 0")

    @cached_property
    def documents(self) -> DataFrame:
        return ingest.documents(self.prepared)

    @cached_property
    def metadata(self) -> DataFrame:
        return ingest.metadata(self.prepared)

    @cached_property
    def buckets(self) -> int:
        """Buckets by document id, from the tokens of the stored stage."""
        from quarry.session import bucket_count
        return bucket_count(self.spark, self.prepared.agg(F.sum("lexical_token_count")).first()[0] or 0)

    @cached_property
    def records(self) -> RecordStore:
        """Documents and metadata stored by id."""
        return RecordStore.build(self.documents, self.metadata, self.buckets)

    # -- index ------------------------------------------------------------
    @cached_property
    def index(self) -> BM25Index:
        if not self.materialize:
            return build_index(self.documents)
        return build_index(self.documents, num_partitions=self.buckets).materialized()

    # -- evaluation -------------------------------------------------------
    @cached_property
    def queries(self) -> DataFrame:
        return self._cut(E.build_queries(self.documents, self.query_split, self.max_queries), "queries")

    @property
    def depth(self) -> int:
        return E.evaluation_depth(self.top_k)

    @cached_property
    def bm25_ranking(self) -> DataFrame:
        return search.bm25_topk(self.index, self.queries, self.depth)  # stored by itself

    @cached_property
    def bm25_per_query(self) -> DataFrame:
        return E.per_query(self.queries, self.bm25_ranking)

    @cached_property
    def bm25_metrics(self) -> DataFrame:
        return E.metrics(self.bm25_per_query)

    def bm25_result(self) -> DataFrame:
        """The evaluation run as one nested row: setup, index statistics,
        metrics and the sample rankings (write it with
        ``sinks.write_result``)."""
        from quarry.sources.sinks import evaluation_result
        setup = {"query_split": self.query_split, "retrieval_depth": self.depth,
                 "relevance_assumption": "each docstring query's own document is the relevant one"}
        flat = E.sample_rankings(self.queries, self.bm25_ranking)
        return evaluation_result(setup, self.index.statistics, self.bm25_metrics,
                                 E.sample_rankings_nested(flat))


def long_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.col("rank").cast("long"))


class DensePipeline(Pipeline):
    """Adds the dense stages: query vectors by the encoder from the query text;
    document vectors from a table (``vectors``: doc_id, embedding) and, for
    documents that it misses, from the same encoder; the rerank of
    ``max(bm25_candidates, depth)`` BM25 candidates; its evaluation over all
    queries.  Only candidates are encoded.

    ``encoder``: ``DataFrame(key, text) -> DataFrame(key, embedding)`` for
    both sides, named ``encoder_name``.  Without one the built-in hashed encoder
    is used, for documents from their posting lists.  ``vectors`` made by another
    encoder (``vectors_encoder``) than the query vectors are refused."""

    bm25_candidates = 50

    def __init__(self, *args, vectors: DataFrame | None = None, vectors_encoder: str | None = None, encoder=None,
                 encoder_name: str | None = None, **kwargs):
        super().__init__(*args, **kwargs)
        from quarry.operators.rerank import HASHED
        if encoder is not None and not encoder_name:
            raise ValueError("name the encoder, so that vectors of another one can be told apart")
        self.encoder, self.encoder_name = encoder, encoder_name or HASHED
        if vectors is not None and vectors_encoder != self.encoder_name:
            raise ValueError(f"document vectors of {vectors_encoder or 'an unnamed encoder'}, "
                             f"query vectors of {self.encoder_name}")
        self.stored_vectors = vectors

    def _encode(self, documents: DataFrame) -> DataFrame:
        """Vectors of ``documents`` (doc_id) by the encoder."""
        from quarry.operators import rerank
        if self.encoder is None:
            return rerank.hashed_document_vectors(self.index, documents)
        texts = self.documents.select(F.col("id").alias("doc_id"), F.col("document_text").alias("text"))
        return self.encoder(texts.join(search.bounded_broadcast(documents.select("doc_id")), "doc_id", "left_semi"))

    def _vectors_of(self, ids: DataFrame, name: str) -> DataFrame:
        from quarry.operators import rerank
        from quarry.operators.blockmax import KEEP_BUCKETS
        from quarry.session import settings
        with settings(self.spark, KEEP_BUCKETS):  # the postings stay where they are stored
            if self.stored_vectors is None:
                return self._cut(self._encode(ids), name)
            return self._cut(rerank.vectors_or_encode(ids.withColumn("text", F.lit(None).cast("string")),
                                                      self.stored_vectors, self._encode, "doc_id", "text"), name)

    @cached_property
    def vectors(self) -> DataFrame:
        """A vector of every indexed document: stored, or encoded on a miss."""
        if self.stored_vectors is None and self.encoder is None:
            from quarry.operators import rerank
            return self._cut(rerank.hashed_document_vectors(self.index), "vectors")
        return self._vectors_of(self.documents.select(F.col("id").alias("doc_id")), "vectors")

    @cached_property
    def candidate_vectors(self) -> DataFrame:
        """The same of the documents that are candidates of a query."""
        return self._vectors_of(self._cut(self.candidates.select("doc_id").distinct(), "candidate_ids"),
                                "candidate_vectors")

    @cached_property
    def query_vectors(self) -> DataFrame:
        from quarry.operators import rerank
        q = self.queries.select("query_id", "query_text")
        return self._cut(self.encoder(q) if self.encoder else rerank.hashed_query_vectors(q), "query_vectors")

    @cached_property
    def candidates(self) -> DataFrame:
        depth = max(self.bm25_candidates, self.depth)
        if depth == self.depth:
            return self.bm25_ranking
        return search.bm25_topk(self.index, self.queries, depth)

    @cached_property
    def rerank_ranking(self) -> DataFrame:
        from quarry.operators.rerank import rerank
        name = F.lit(self.encoder_name)
        return self._cut(rerank(self.candidates, self.query_vectors.withColumn("encoder", name),
                                self.candidate_vectors.withColumn("encoder", name), self.depth), "rerank_ranking")

    @cached_property
    def rerank_metrics(self) -> DataFrame:
        return E.metrics(E.per_query(self.queries, self.rerank_ranking))

    def rerank_result(self) -> DataFrame:
        """The rerank evaluation run as one nested row (samples carry the
        BM25 score beside the cosine)."""
        from quarry.sources.sinks import evaluation_result
        setup = {"query_split": self.query_split, "retrieval_depth": self.depth,
                 "bm25_candidate_count": max(self.bm25_candidates, self.depth),
                 "reranker": self.encoder_name,
                 "relevance_assumption": "each docstring query's own document is the relevant one"}
        flat = E.sample_rankings(self.queries, self.rerank_ranking,
                                 extra_cols=("bm25_score",))
        return evaluation_result(setup, self.index.statistics, self.rerank_metrics,
                                 E.sample_rankings_nested(flat, ("bm25_score",)))
