"""Inverted index as DataFrames: documents, posting lists, vocabulary,
statistics.

Layout for scale: the processed documents are dealt once (one shuffle of the
compact space-joined token text) into document buckets by a hash of their id.
Everything per bucket - token split, term frequencies, posting lists - is then
one sort of (term, document) numbers in Arrow arrays, without another exchange.  A posting list is one row per (document bucket,
term) with its documents in order and the largest idf-free impact among them
(the block maximum that the ranking prunes with), so a term's text and hash are
handled once a bucket, not once a posting.

The lists are stored as a table in two levels: ``bucket`` is what Spark buckets
the table by, ``part`` divides a bucket further when there are more document
buckets than Spark allows buckets.  The only other shuffle is the document- and
collection-frequency sum by term, over one number per list.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numeric import round_ratio
from quarry.session import materialize, on_workers, release_shuffles, save_bucketed, two_levels

# BM25 parameters of the reference.
K1 = 1.5
B = 0.75
LAYOUT = ("bucket", "part")
BATCH_POSTINGS = 500_000  # postings of a batch that a bucket hands on


class BM25Index:
    """Tables of the index.

    * ``documents``  (doc_id, split, func_name, lexical_token_count)
    * ``lists``      (bucket, part, term, df, cf, max_factor, docs), ``docs`` an array of
      (doc_id, term_frequency, doc_length) by doc_id; bucketed by ``bucket``
    * ``postings``   (doc_id, term, term_frequency, doc_length, bucket, part): the lists unrolled
    * ``vocabulary`` (term, document_frequency, collection_frequency, idf)
    * ``statistics`` one row (document_count, total_token_count,
      average_document_length, vocabulary_size, k1, b)

    What is not given is derived from the unrolled postings or the lists on
    first use (corpus totals are read as a scalar from a one-row aggregate).
    ``files`` and ``parts`` are the two levels of the layout.
    """

    def __init__(self, documents: DataFrame, lists: DataFrame | None = None,
                 vocabulary: DataFrame | None = None, statistics: DataFrame | None = None,
                 files: int = 1, parts: int = 1, k1: float = K1, b: float = B,
                 texts: DataFrame | None = None):
        self.documents = documents
        self.files, self.parts = files, parts
        self.k1 = k1
        self.b = b
        self._texts = texts
        for name, table in (("lists", lists), ("vocabulary", vocabulary), ("statistics", statistics)):
            if table is not None:
                self.__dict__[name] = table

    @property
    def spark(self) -> SparkSession:
        return self.documents.sparkSession

    @cached_property
    def postings(self) -> DataFrame:
        return self.lists.select("term", *LAYOUT, F.inline("docs")).select(
            "doc_id", "term", "term_frequency", "doc_length", *LAYOUT)

    @cached_property
    def totals(self) -> DataFrame:
        return _corpus_totals(self.documents)

    @cached_property
    def lists(self) -> DataFrame:
        return lists_from(self._texts, self.totals, self.k1, self.b)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return vocabulary_from(self.lists, self.totals)

    @cached_property
    def statistics(self) -> DataFrame:
        return statistics_from(self.documents, self.vocabulary, self.totals, self.k1, self.b)

    def labels(self) -> DataFrame:
        return bucket_labels(self.spark, self.files)

    def located(self, ids: DataFrame) -> DataFrame:
        """``bucket, doc_id`` of ``ids`` (doc_id, of the type of the index), dealt as the lists are stored."""
        at = ids.select("doc_id", slot_of("doc_id", self.files)).join(F.broadcast(self.labels()), "slot")
        return at.select("bucket", "doc_id").repartition(self.files, "bucket")

    def materialized(self) -> "BM25Index":
        """Store the index once: the lists as a bucketed table (the layout that
        the query phase needs), the small tables as parquet."""
        docs = materialize(self.documents, "documents")
        totals = materialize(_corpus_totals(docs), "totals")
        # in the order of terms inside a bucket, so that look-ups skip row groups
        lists = save_bucketed(lists_from(self._texts, totals, self.k1, self.b), "postings", "bucket",
                              self.files, sort_by=("part", "term")) if self._texts is not None else self.lists
        release_shuffles(self.spark)  # the texts that were dealt out
        vocab = materialize(vocabulary_from(lists, totals), "vocabulary")
        stats = materialize(statistics_from(docs, vocab, totals, self.k1, self.b), "statistics")
        return BM25Index(docs, lists, vocab, stats, self.files, self.parts, self.k1, self.b)


def idf(document_count, document_frequency) -> F.Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5)); always positive."""
    n, df = F.col(document_count) if isinstance(document_count, str) else document_count, \
        F.col(document_frequency) if isinstance(document_frequency, str) else document_frequency
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def _corpus_totals(docs: DataFrame) -> DataFrame:
    totals = docs.agg(F.count(F.lit(1)).alias("document_count"),
                      F.coalesce(F.sum("lexical_token_count"), F.lit(0)).cast("long")
                      .alias("total_token_count"))
    return totals.select(
        "document_count", "total_token_count",
        # rounded to 4 decimals before it is stored; the scorer uses this value
        round_ratio("total_token_count", "greatest(document_count, 1)", 4)
        .alias("average_document_length"))


def bucket_labels(spark: SparkSession, files: int) -> DataFrame:
    """``slot, bucket``: for each of ``files`` hash slots the smallest number
    that Spark's own hash sends there, so that rows with that ``bucket`` fill
    exactly one bucket (or shuffle partition) of ``files``, and every one."""
    wide = 8 * files + 64
    while True:
        ids = spark.range(wide).select(F.pmod(F.hash("id"), F.lit(files)).alias("slot"), F.col("id").alias("bucket"))
        labels = ids.groupBy("slot").agg(F.min("bucket").alias("bucket")).collect()
        if len(labels) == files:  # one row a file, at most the limit on buckets
            return spark.createDataFrame(labels, "slot int, bucket long")
        wide *= 2


def slot_of(doc_id: str, files: int) -> F.Column:
    """The hash slot (``bucket_labels``) of a document."""
    return F.pmod(F.hash(doc_id), F.lit(files)).alias("slot")


def vocabulary_from(lists: DataFrame, totals: DataFrame) -> DataFrame:
    """Document and collection frequency per term (sums over one row per
    bucket, so a term in every document costs no more than another) and its idf.
    The corpus size is read from the one-row totals and folded in as a
    constant."""
    counts = lists.groupBy("term").agg(F.sum("df").cast("long").alias("document_frequency"),
                                       F.sum("cf").cast("long").alias("collection_frequency"))
    n = totals.select("document_count").first()["document_count"]
    return counts.select("term", "document_frequency", "collection_frequency",
                         idf(F.lit(n), F.col("document_frequency")).alias("idf"))


def statistics_from(docs: DataFrame, vocabulary: DataFrame, totals: DataFrame | None = None,
                    k1: float = K1, b: float = B) -> DataFrame:
    """The one-row statistics table (vocabulary size counted as a scalar)."""
    totals = totals if totals is not None else _corpus_totals(docs)
    vsize = vocabulary.count()
    return totals.select(
        "document_count", "total_token_count", "average_document_length",
        F.lit(vsize).cast("long").alias("vocabulary_size"),
        F.lit(k1).alias("k1"), F.lit(b).alias("b"))


def term_factor(tf: np.ndarray, dl: np.ndarray, avgdl: float, k1: float, b: float) -> np.ndarray:
    """The idf-free part of the BM25 weight, ``tf (k1 + 1) / (tf + k1 (1 - b + b dl / avgdl))``."""
    return (tf * (k1 + 1.0)) / (tf + k1 * (1.0 - b + b * dl / avgdl))


def bucket_postings(ids: pa.ChunkedArray, texts: pa.ChunkedArray, avgdl: float, k1: float,
                    b: float) -> Iterator[pa.RecordBatch]:
    """The posting lists of one document bucket (term, df, cf, max_factor, docs).
    Rows of the same id and length are one document."""
    tokens = pc.split_pattern(texts, " ").combine_chunks()
    length = tokens.value_lengths().to_numpy().astype(np.int64)
    ids = ids.combine_chunks()
    order = pc.sort_indices(pa.table({"id": ids, "length": length}), null_placement="at_start",
                            sort_keys=[("id", "ascending"), ("length", "ascending")]).to_numpy()
    same = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()[order]
    first = np.append(True, (same[1:] != same[:-1]) | (length[order][1:] != length[order][:-1]))
    document = np.empty(len(order), np.int64)
    document[order] = np.cumsum(first) - 1
    ids, length = ids.take(pa.array(order[first])), length[order[first]]
    words = tokens.flatten().dictionary_encode()
    key = words.indices.to_numpy() * np.int64(len(length)) + np.repeat(document, tokens.value_lengths().to_numpy())
    del tokens
    key.sort()
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    tf = np.diff(np.append(start, len(key)))
    term, document = np.divmod(key[start], len(length))
    del key
    at = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    end = np.append(at, len(term))
    cf = np.add.reduceat(tf, at)
    factor = np.maximum.reduceat(term_factor(tf, length[document], avgdl, k1, b), at)
    begin = 0
    while begin < len(at):  # as many lists as hold BATCH_POSTINGS, one at least
        stop = max(begin + 1, int(np.searchsorted(end, end[begin] + BATCH_POSTINGS, "right")) - 1)
        own = slice(end[begin], end[stop])
        docs = pa.StructArray.from_arrays(
            [ids.take(pa.array(document[own])), pa.array(tf[own]), pa.array(length[document[own]])],
            ["doc_id", "term_frequency", "doc_length"])
        yield pa.RecordBatch.from_arrays(
            [words.dictionary.take(pa.array(term[at[begin:stop]])), pa.array(np.diff(end[begin:stop + 1])),
             pa.array(cf[begin:stop]), pa.array(factor[begin:stop]),
             pa.ListArray.from_arrays(pa.array((end[begin:stop + 1] - end[begin]).astype(np.int32)), docs)],
            ["term", "df", "cf", "max_factor", "docs"])
        begin = stop


def lists_from(texts: DataFrame, totals: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """One row per document bucket and term from the texts by bucket (no
    exchange).  A list is bounded by the documents of its bucket."""
    on_workers(texts.sparkSession)
    avgdl = totals.first()["average_document_length"]
    ids = dict(texts.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        place = [t.column(c)[0] for c in LAYOUT]
        for lists in bucket_postings(t.column("doc_id"), t.column("lexical_document"), avgdl, k1, b):
            yield pa.RecordBatch.from_arrays(
                [*(pa.repeat(v, lists.num_rows) for v in place), *lists.columns], [*LAYOUT, *lists.schema.names])

    return texts.groupBy(*LAYOUT).applyInArrow(
        run, "bucket long, part int, term string, df long, cf long, max_factor double, "
             f"docs array<struct<doc_id: {ids}, term_frequency: long, doc_length: long>>")


def build_index(processed: DataFrame, num_partitions: int | None = None,
                k1: float = K1, b: float = B, files: int | None = None) -> BM25Index:
    """Index processed documents (``id, split, func_name, lexical_document``).

    Documents whose lexical text is empty are not indexed.  ``num_partitions``:
    document buckets, by default ``spark.sql.shuffle.partitions``; on a cluster
    size them so that one bucket's postings fit a task's memory (about 100-250
    MB each, see ``session.bucket_count``).  ``files``: buckets of the stored
    table, by default as many as Spark allows.
    """
    spark = processed.sparkSession
    files, parts = two_levels(spark, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), files)
    indexed = processed.filter(F.col("lexical_document") != "")
    count = (F.col("lexical_token_count") if "lexical_token_count" in processed.columns
             else F.size(F.split("lexical_document", " "))).cast("long")
    # the per-document table needs no particular layout: no shuffle
    doc_table = indexed.select(F.col("id").alias("doc_id"), "split", "func_name",
                               count.alias("lexical_token_count"))
    # postings: one shuffle of the compact token text by bucket, after which
    # the posting lists keep that partitioning
    dealt = indexed.select(F.col("id").alias("doc_id"), "lexical_document",
                           slot_of("id", files),
                           F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
    texts = (dealt.join(F.broadcast(bucket_labels(spark, files)), "slot")
             .select(*LAYOUT, "doc_id", "lexical_document")
             .repartition(files, "bucket"))
    return BM25Index(doc_table, files=files, parts=parts, k1=k1, b=b, texts=texts)


def statistics_long(statistics: DataFrame) -> DataFrame:
    """Key / JSON-value view of the statistics row (the reference's EAV form)."""
    s = statistics
    return s.select(F.explode(F.create_map(
        F.lit("document_count"), F.to_json(F.array("document_count")),
        F.lit("average_document_length"), F.to_json(F.array("average_document_length")),
        F.lit("vocabulary_size"), F.to_json(F.array("vocabulary_size")),
        F.lit("total_token_count"), F.to_json(F.array("total_token_count")),
        F.lit("bm25_parameters"), F.to_json(F.struct("k1", "b")),
    )).alias("key", "value")).select(
        "key", F.regexp_replace("value", r"^\[(.*)\]$", "$1").alias("value"))
