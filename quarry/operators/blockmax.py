"""Top-k BM25 inside document buckets, pruned by block maxima.

One plan, one scan of the posting lists, for any number of queries: the queries
(with their weighted terms) are packed once into compressed pieces, which are
broadcast to the document buckets and meet the posting lists there.  Neither is
shuffled: the lists are read in the buckets that they are stored in, and what is
dealt to the buckets is a label each, so no shuffle grows with queries times
buckets.  A task holds the lists of one document bucket and unpacks one piece
after another.  What is broadcast at once, through the driver, is a chunk of
queries (``QUERY_BYTES`` before packing); with more chunks the lists are scanned
once for each and a chunk's rows are stored before the next one is sent.

A query's lists in a bucket are taken by falling upper bound (idf times the
block maximum) and summed by one ``bincount``.  Where a lower bound of the final
k-th best score is known, this ends once the remaining upper bounds add up to
less: no unseen document can enter then.  Of the other lists the short ones are
summed too; the long ones (``DENSE_BYTES``) are held with a place for every document
and only looked up for the documents that still can enter, which shrink on the way.
Documents that could tie are kept, so the result equals the exhaustive ranking
exactly.  A bucket returns at most k documents a query.

With more buckets than cores the first ones (``first_buckets``) are ranked before
the others: a query's k-th best score there is a lower bound of its final one, with
which the others begin (``least``).  So they prune at once, leave queries whose
lists cannot reach it, and return few documents: neither their work nor the rows
moved grow with queries times buckets times k.

Data-dependent skipping is what relational operators cannot express, hence the
Arrow function; sums are the same fixed-point integers as the relational plan's
(``search.bm25_scores``), in the same order of double operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import SCORE_SCALE
from quarry.operators.index import LAYOUT, BM25Index
from quarry.session import materialize, on_workers

# Buckets and parts are read where they are stored: the scan keeps its buckets, and both sides
# may be partitioned by the bucket alone.
KEEP_BUCKETS = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
                "spark.sql.requireAllClusterKeysForCoPartition": "false"}
QUERY_BYTES = 256 * 1024 * 1024  # queries of a chunk, before they are packed
PIECE_BYTES = 16 * 1024 * 1024  # queries of a piece, before they are packed
DENSE_BYTES = 64 * 1024 * 1024  # of a bucket's lists that are held with a place for every document
LOOK_UP = 1500  # lists that are shorter cost less to sum than to look up
STEP = 5  # lists that are looked up before the documents are cut again
QUERIES = 10_000  # queries whose terms are looked up at a time
PAIR_ROWS = 500_000  # rows of a batch that a bucket hands on
_NONE = np.empty(0, np.int64), np.empty(0, np.int64)


def fixed(x: np.ndarray) -> np.ndarray:
    """As ``numeric.to_fixed``."""
    return np.floor(x * float(SCORE_SCALE) + 0.5).astype(np.int64)


class Bucket:
    """The posting lists of one document bucket (term, max_factor, ids, tfs, dls)."""

    def __init__(self, lists: pa.Table, avgdl: float, k1: float, b: float):
        self.avgdl, self.k1, self.b = avgdl, k1, b
        t = lists.combine_chunks()
        one = lambda c: t.column(c).combine_chunks()
        self.terms = one("term")
        self.max_factor = t.column("max_factor").to_numpy()
        self.size = size = one("ids").value_lengths().to_numpy().astype(np.int64)
        self.end = np.cumsum(size)
        self.start = self.end - size
        ids = one("ids").flatten().dictionary_encode(null_encoding="encode")
        names = ids.dictionary
        order = pa.compute.sort_indices(names)  # as ids sort in Spark: numbers, or strings by their bytes
        place = np.empty(len(names), np.int64)
        place[order.to_numpy()] = np.arange(len(names))
        self.ids = names.take(order)
        self.docs = place[ids.indices.to_numpy()]
        self.tf, self.dl = one("tfs").flatten().to_numpy(), one("dls").flatten().to_numpy()
        # an id that comes again with another length has two places in a list, one after the other
        again = np.append(False, self.docs[1:] == self.docs[:-1])
        again[self.start[size > 0]] = False
        self.twice = bool(again.any())
        if self.twice:
            first = np.flatnonzero(~again)
            self.max_factor = self.max_factor * float(np.diff(np.append(first, len(again))).max())
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known_weights: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known_dense: dict[int, np.ndarray] = {}
        self.dense_size = self.least_dense()
        self.sums = np.zeros(len(names), np.int64)

    def least_dense(self) -> int:
        """The size from which lists are held densely: the longest ones, within ``DENSE_BYTES``."""
        most = DENSE_BYTES // (8 * max(len(self.ids), 1))
        if most >= len(self.size):
            return 0
        return int(np.partition(self.size, len(self.size) - most - 1)[len(self.size) - most - 1]) + 1

    def impacts(self, i: int, idf: float) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a list, ascending, and their fixed-point impacts."""
        if i not in self.known:
            at = slice(int(self.start[i]), int(self.end[i]))
            tf, dl = self.tf[at], self.dl[at]
            w = idf * (tf * (self.k1 + 1.0)) / (tf + self.k1 * (1.0 - self.b + self.b * dl / self.avgdl))
            docs, impact = self.docs[at], fixed(w)
            if self.twice:
                first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
                docs, impact = docs[first], np.add.reduceat(impact, first)
            self.known[i] = docs, impact
        return self.known[i]

    def weights(self, i: int, idf: float) -> tuple[np.ndarray, np.ndarray]:
        """As ``impacts``, in doubles for ``bincount``: sums of such integers are
        exact in doubles up to 2 ** 53, nine million of score."""
        if i not in self.known_weights:
            docs, impact = self.impacts(i, idf)
            del self.known[i]
            self.known_weights[i] = docs, impact.astype(np.float64)
        return self.known_weights[i]

    def dense(self, i: int, idf: float) -> np.ndarray:
        """As ``weights``, for every document of the bucket."""
        if i not in self.known_dense:
            docs, impact = self.impacts(i, idf)
            del self.known[i]
            row = self.known_dense[i] = np.zeros(len(self.ids))
            row[docs] = impact
        return self.known_dense[i]

    def bounds(self, at: np.ndarray, idfs: np.ndarray) -> np.ndarray:
        """Upper bounds of the lists' impacts."""
        return fixed(idfs * self.max_factor[at]) + 2  # other operation order

    def best(self, at: np.ndarray, idfs: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents of the bucket for a query
        with the lists ``at`` and their idf, of those that score ``least``."""
        bound = self.bounds(at, idfs)
        if not len(at) or bound.sum() < least:
            return _NONE
        by_bound = np.argsort(-bound, kind="stable")
        bound = bound[by_bound]
        rest = bound[::-1].cumsum()[::-1] - bound  # of the lists after each
        enough = int((rest >= least).sum()) + 1  # lists until the rest is below
        return self._best(at[by_bound], idfs[by_bound], bound, enough, k, least)

    def _best(self, at, idfs, bound, enough: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` of lists by falling upper bound, of which the first ``enough``
        name all documents that can score ``least``."""
        long = (self.size[at[enough:]] >= max(self.dense_size, LOOK_UP)).tolist()
        lists = list(zip(at.tolist(), idfs.tolist(), bound.tolist()))
        later = [x for x, y in zip(lists[enough:], long) if y]
        summed = lists[:enough] + [x for x, y in zip(lists[enough:], long) if not y] if later else lists
        known = self.known_weights
        own = [known[i] if i in known else self.weights(i, w) for i, w, _ in summed]
        rest = sum(x[2] for x in later)
        sums = np.bincount(np.concatenate([x[0] for x in own]), np.concatenate([x[1] for x in own]), len(self.ids))
        places = np.flatnonzero(sums >= max(least - rest, 1))
        scores = sums[places]
        for j in range(0, len(later), STEP):
            if not len(places):
                return _NONE
            for i, w, most in later[j:j + STEP]:
                scores += self.dense(i, w).take(places)
                rest -= most
            can = (scores >= least - rest).nonzero()[0]
            places, scores = places.take(can), scores.take(can)
        if len(places) > k:
            can = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[can], scores[can]
        first = np.lexsort((places, -scores))[:k]
        return places[first], scores[first].astype(np.int64)

    def pairs(self, asked: pa.ListArray, idfs: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``query_id, doc_id, score_fp`` of every document for every query that
        shares a term with it, a few queries at a time; ``asked``: the queries of
        each list."""
        names = asked.flatten().field("query_id").dictionary_encode(null_encoding="encode")
        of_list = asked.value_parent_indices().to_numpy()
        query = names.indices.to_numpy()
        order = np.argsort(query, kind="stable")
        ends = np.cumsum(np.bincount(query, minlength=len(names.dictionary))).tolist()
        of_list = of_list[order].tolist()
        hit = np.zeros(len(self.sums), bool)
        held, rows, begin = [], 0, 0
        for q, end in enumerate(ends):
            for i in of_list[begin:end]:
                docs, impact = self.impacts(i, float(idfs[i]))
                self.sums[docs] += impact
                hit[docs] = True
            begin = end
            places = np.flatnonzero(hit)
            held.append((q, places, self.sums[places]))
            self.sums[places], hit[places] = 0, False
            rows += len(places)
            if rows >= PAIR_ROWS or q == len(ends) - 1:
                of = np.repeat([x[0] for x in held], [len(x[1]) for x in held])
                yield pa.RecordBatch.from_arrays(
                    [names.dictionary.take(pa.array(of)), self.ids.take(pa.array(np.concatenate([x[1] for x in held]))),
                     pa.array(np.concatenate([x[2] for x in held]))], ["query_id", "doc_id", "score_fp"])
                held, rows = [], 0

    def search(self, queries: pa.Table, k: int) -> pa.Table:
        """``query_id, doc_id, score_fp`` of the k best for each of ``queries``
        (query_id, terms, idfs, least), a few at a time."""
        few = range(0, max(queries.num_rows, 1), QUERIES)
        return pa.concat_tables([self.search_few(queries.slice(i, QUERIES), k) for i in few])

    def search_few(self, queries: pa.Table, k: int) -> pa.Table:
        t = queries.combine_chunks()
        terms, idfs = t.column("terms").combine_chunks(), t.column("idfs").combine_chunks().flatten().to_numpy()
        least = t.column("least").to_numpy()
        of_query = terms.value_parent_indices().to_numpy()
        at = pa.compute.index_in(terms.flatten(), value_set=self.terms).fill_null(-1).to_numpy()
        has = at >= 0
        at, idfs, of_query = at[has], idfs[has], of_query[has]
        ends = np.cumsum(np.bincount(of_query, minlength=t.num_rows))
        bound = self.bounds(at, idfs)
        order = np.lexsort((-bound, of_query))
        at, idfs, of_query, bound = at[order], idfs[order], of_query[order], bound[order]
        reach = np.append(0, np.cumsum(bound))  # no list set of a query brings a document beyond
        begins = np.append(0, ends[:-1])
        enough = 1 + np.bincount(of_query[reach[ends][of_query] - reach[1:] >= least[of_query]], minlength=t.num_rows)
        asked = np.flatnonzero((ends > begins) & (reach[ends] - reach[begins] >= least))
        found = [self._best(at[b:e], idfs[b:e], bound[b:e], n, k, x) for b, e, n, x in
                 zip(begins[asked].tolist(), ends[asked].tolist(), enough[asked].tolist(), least[asked].tolist())]
        of = np.repeat(asked, [len(p) for p, _ in found])
        join = lambda i: np.concatenate([x[i] for x in found] or [np.empty(0, np.int64)])
        return pa.table([t.column("query_id").take(pa.array(of)), self.ids.take(pa.array(join(0))), pa.array(join(1))],
                        ["query_id", "doc_id", "score_fp"])


def bucket_lists(index: BM25Index, *more) -> DataFrame:
    """The stored lists in the columns of ``Bucket``, beside ``more``."""
    return index.lists.select(*LAYOUT, "max_factor", F.col("docs.doc_id").alias("ids"),
                              F.col("docs.term_frequency").alias("tfs"), F.col("docs.doc_length").alias("dls"), *more)


def score_buckets(asked: DataFrame, constants: dict) -> DataFrame:
    """``query_id, doc_id, score_fp`` of all pairs from the lists (``bucket_lists``)
    with their queries and idf.  A task holds the lists of one document bucket and
    the queries' terms; the pairs leave it as they are made."""
    on_workers(asked.sparkSession)
    ids = asked.schema["ids"].dataType.elementType.simpleString()
    query = asked.schema["asked"].dataType.elementType["query_id"].dataType.simpleString()
    avgdl, k1, b = constants["avgdl"], constants["k1"], constants["b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches)
        bucket = Bucket(t, avgdl, k1, b)
        yield from bucket.pairs(t.column("asked").combine_chunks(), t.column("idf").to_numpy())

    return asked.groupBy(*LAYOUT).applyInArrow(run, f"query_id {query}, doc_id {ids}, score_fp long")


def first_buckets(index: BM25Index) -> list[int]:
    """The buckets to rank before the others: a wave of tasks, a quarter of the
    buckets at most; none where all buckets are one wave."""
    cores = index.spark.sparkContext.defaultParallelism
    if index.files <= cores:
        return []
    first = min(cores, -(-index.files // 4))
    return [r["bucket"] for r in index.labels().filter(F.col("slot") < first).collect()]  # a number a core


def packed(queries: pa.Table) -> bytes:
    """A piece of queries (query_id, terms, idfs, least): each term and idf once."""
    t = queries.combine_chunks()

    def coded(name: str) -> pa.ListArray:
        lists = t.column(name).combine_chunks()
        ends = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), lists.flatten().dictionary_encode())

    t = pa.table([t.column("query_id"), coded("terms"), coded("idfs"), t.column("least")], ["query_id", "terms", "idfs", "least"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def unpacked(pieces: pa.ChunkedArray) -> Iterator[pa.Table]:
    """The queries of the pieces, one piece after another, small ones together."""
    def plain(lists: pa.ChunkedArray) -> pa.Array:
        lists = lists.combine_chunks()
        return pa.ListArray.from_arrays(lists.offsets, lists.values.dictionary_decode())

    held, rows = [], 0
    for piece in pieces:
        t = pa.ipc.open_stream(piece.as_buffer()).read_all().combine_chunks()
        t = pa.table([t.column("query_id"), plain(t.column("terms")), plain(t.column("idfs")), t.column("least")], t.column_names)
        if held and rows + t.num_rows > QUERIES:
            yield pa.concat_tables(held)
            held, rows = [], 0
        held.append(t)
        rows += t.num_rows
    if held:
        yield pa.concat_tables(held)


def query_pieces(queries: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``id, bytes, piece``: the queries (query_id, terms, idfs, least) packed and
    stored, and the chunks, first and last id of each.  What reaches the driver is two
    numbers a piece."""
    on_workers(queries.sparkSession)
    most = min(PIECE_BYTES, QUERY_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            t = pa.Table.from_batches([batch])
            sizes = t.column("bytes").to_numpy()
            begin = 0
            while begin < len(sizes):  # as many queries as fit, one at least
                fit = int(np.searchsorted(np.cumsum(sizes[begin:begin + QUERIES]), most, "right"))
                own = t.slice(begin, max(fit, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([int(sizes[begin:begin + own.num_rows].sum())], pa.int64()),
                     pa.array([packed(own.drop_columns(["bytes"]))], pa.binary())], ["id", "bytes", "piece"])
                begin += own.num_rows
                n += 1

    size = F.aggregate("terms", F.lit(64).cast("long"), lambda n, t: n + F.octet_length(t) + 16)
    pieces = materialize(queries.select("*", size.alias("bytes")).mapInArrow(run, "id long, bytes long, piece binary"), "query_pieces")
    chunks, held = [], 0
    for i, n in sorted(tuple(r) for r in pieces.select("id", "bytes").collect()):
        if not chunks or held + n > QUERY_BYTES:
            chunks.append((i, i))
            held = 0
        chunks[-1] = chunks[-1][0], i
        held += n
    return pieces, chunks


def rank_buckets(index: BM25Index, queries: DataFrame, k: int, constants: dict,
                 only: list[int] | None = None, but: list[int] | None = None) -> DataFrame:
    """``query_id, doc_id, score_fp``: the k best documents of every bucket for
    each of ``queries`` (query_id, terms, idfs and, where the k-th best score is
    known to be so much, least; packed at once), to be cut at k once more.  ``only``,
    ``but``: these buckets alone, or all others.  Run it under the settings
    ``KEEP_BUCKETS``."""
    on_workers(index.spark)
    ids = dict(index.documents.dtypes)["doc_id"]
    asked = dict(queries.dtypes)["query_id"]
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    lists, labels = bucket_lists(index, "term"), index.labels()
    least = F.col("least") if "least" in queries.columns else F.lit(0)
    if only is not None or but:
        wanted = F.col("bucket").isin(only) if only is not None else ~F.col("bucket").isin(but)
        lists, labels = lists.filter(wanted), labels.filter(wanted)
    pieces, chunks = query_pieces(queries.select("query_id", "terms", "idfs", least.cast("long").alias("least")))
    # a row a document bucket is all that is dealt; the pieces join it where it has arrived
    places = labels.select("bucket", every(index.parts, "part")).repartition(index.files, "bucket")
    avgdl, k1, b = constants["avgdl"], constants["k1"], constants["b"]

    def run(lists: pa.Table, sent: pa.Table) -> pa.Table:
        if not lists.num_rows or not sent.num_rows:
            return empty
        bucket = Bucket(lists, avgdl, k1, b)
        return pa.concat_tables([bucket.search(t, k) for t in unpacked(sent.column("piece"))])

    from pyspark.sql.pandas.types import to_arrow_schema
    out = f"query_id {asked}, doc_id {ids}, score_fp long"
    empty = to_arrow_schema(index.spark.createDataFrame([], out).schema).empty_table()
    group = lambda d: d.groupBy(*LAYOUT)

    def ranked(pieces: DataFrame) -> DataFrame:
        sent = places.crossJoin(F.broadcast(pieces.select("piece")))
        return group(lists).cogroup(group(sent)).applyInArrow(run, out)

    if len(chunks) < 2:
        return ranked(pieces)
    found = [materialize(ranked(pieces.filter(F.col("id").between(*c))), "chunk_ranking") for c in chunks]
    return reduce(DataFrame.unionByName, found)
