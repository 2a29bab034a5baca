"""Ranked lexical search by the Best Position Algorithm.

Every term of a query has an impact list, its documents by falling impact.  The
lists are read in step.  A document seen for the first time is looked up in all
other lists of the query (direct access), which completes its score and marks
its places there as seen.  The best position of a list is the last place before
which all places are seen; the impacts at the best positions add up to a bound
on every document not seen yet, at most as large as that of the last places
read.  Reading stops when the bound is strictly below the k-th best score, so
that documents with an equal score are never lost.

Only terms of queries are kept.  One pass over the texts stores, for each
document, its length and the frequencies of the query terms; the corpus totals
and document frequencies are sums over that.  A task then cuts the stored
documents into blocks of at most ``BLOCK_POSTINGS`` postings, builds the impact
lists of a block in memory and runs all queries on them; the k-th best score of
a query so far carries over to the next blocks of the task, which therefore stop
sooner.  A task returns at most k documents a query, and the k best of all
tasks are the result.  No list, common term or document meets a task as a whole
(a document's own terms apart).

Queries run in batches of at most ``BATCH_TERMS`` terms and ``BATCH_BYTES``
bytes (a single longer query is a batch of its own), which is what tasks get
besides documents; each batch is one pass over the texts.

Defined cases: a null or empty text has no terms; a query without terms, or none
that a document holds, has no rows; rows of one query id are one query with the
terms of all; documents are rows, so repeated rows rank each for themselves,
equal scores by doc_id (null first); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import on_workers
from quarry.session import materialize, scratch_path

# Scale of the term weights, and the length normalisation of the score
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, LEAST_M, SLOPE = 1000, 10**9, 1000, 20, 50, 50
TOP = 50
BATCH_TERMS, BATCH_BYTES = 500_000, 32 * 1024 * 1024
BLOCK_POSTINGS = 2_000_000
STEP = 32  # places read in each list before the bound is looked at; doubles
NULL_ID = -(2**63)

# bytes outside terms become spaces, A-Z become a-z; bytes of non-ASCII characters stay
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def query_terms(items: DataFrame, id_col: str) -> DataFrame:
    """``item, term`` (UTF-8 bytes), each once."""
    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1).cast(pa.binary()).to_pylist()
            found = [sorted(set(terms_of(x))) for x in texts]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), pa.array([t for x in found for t in x], pa.binary())], ["item", "term"])

    return items.select(F.col(id_col).alias("item"), "text").mapInArrow(
        run, f"item {dict(items.dtypes)[id_col]}, term binary").distinct()


def batches_of(terms: DataFrame):
    """The query terms as lists of ``(item, term)``, each within the limits."""
    n, size = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()
    count = max(1, -(-n // BATCH_TERMS), -(-size // BATCH_BYTES))
    if count == 1:
        yield [tuple(r) for r in terms.collect()]
        return
    for i in range(2 * count):  # twice as many, since hash shares vary
        rows = terms.filter(F.pmod(F.xxhash64("item"), F.lit(2 * count)) == i).collect()
        if rows:
            yield [tuple(r) for r in rows]


def count_terms(docs: DataFrame, words: dict[bytes, int], id_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: a text's terms with repeats, and the
    frequencies of those in ``words``."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        known = shared.value
        for b in batches:
            n, ids, tfs, size = [], [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                t = terms_of(text)
                n.append(len(t))
                c = Counter([known[w] for w in t if w in known])
                ids += c.keys()
                tfs += c.values()
                size.append(len(c))
            at = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """The postings of some documents, by document and as impact lists."""

    def __init__(self, ids, n, sizes, terms, tfs, weights, n_docs, total):
        m = 100 - SLOPE + (SLOPE * n * n_docs) // max(total, 1)
        owner = np.repeat(np.arange(len(ids)), sizes)
        impact = weights[terms] * ((IMPACT_SCALE * tfs) // (TF_SCALE * tfs + LENGTH_SCALE * m[owner]))
        some = impact > 0
        owner, self.term, self.impact = owner[some], terms[some], impact[some]
        self.ids = ids
        self.size = np.bincount(owner, minlength=len(ids))
        self.first = np.cumsum(self.size) - self.size
        order = np.lexsort((-self.impact, self.term))
        self.list_doc, self.list_impact = owner[order], self.impact[order]
        self.place = np.empty(len(order), np.int64)  # of each posting, in the lists
        self.place[order] = np.arange(len(order))
        ends = np.cumsum(np.bincount(self.term, minlength=len(weights)))
        self.start, self.end = ends - np.bincount(self.term, minlength=len(weights)), ends
        self.unseen = np.ones(len(order), bool)
        self.fresh = np.ones(len(ids), bool)

    def look_up(self, docs: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: scores of ``docs`` over the asked terms, and the
        places of all their postings in those lists."""
        size = self.size[docs]
        skip = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.first[docs] - skip, size)
        of = np.repeat(np.arange(len(docs)), size)
        mine = asked[self.term[at]]
        at, of = at[mine], of[mine]
        begins = np.searchsorted(of, np.arange(len(docs)))  # each has a posting: it was found in a list
        return np.add.reduceat(self.impact[at], begins), self.place[at]

    def search(self, terms: np.ndarray, asked: np.ndarray, top: "Best") -> int:
        """Adds the block's best documents to ``top``; returns the places read."""
        start, end = self.start[terms], self.end[terms]
        some = end > start
        start, end = start[some], end[some]
        best = start.copy()  # the first place of each list that is not seen
        touched, read, depth, step = [], 0, 0, STEP
        while (start + depth < end).any():
            lo, hi = np.minimum(start + depth, end), np.minimum(start + depth + step, end)
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
            read += len(at)
            docs = np.unique(self.list_doc[at])
            docs = docs[self.fresh[docs]]
            if len(docs):
                self.fresh[docs] = False
                touched.append(docs)
                scores, places = self.look_up(docs, asked)
                self.unseen[places] = False
                top.add(scores, self.ids[docs])
            depth += step
            step *= 2
            bound = 0
            for i in range(len(best)):
                b, e = best[i], end[i]
                if b < e:
                    to = int(np.argmax(self.unseen[b:e]))
                    b = best[i] = b + to if self.unseen[b + to] else e
                if b < e:  # a list read to its end adds nothing to unseen documents
                    bound += int(self.list_impact[max(b - 1, start[i])])
            if bound < top.least:
                break
        for a, b in zip(start, end):
            self.unseen[a:b] = True
        if touched:
            self.fresh[np.concatenate(touched)] = True
        return read


class Best:
    """The k best documents of a query, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = 0  # the k-th best score; 0 while there are fewer

    def add(self, scores, ids):
        can = scores >= max(self.least, 1)
        s, i = np.append(self.scores, scores[can]), np.append(self.ids, ids[can])
        o = np.lexsort((i, -s))[:self.k]
        self.scores, self.ids = s[o], i[o]
        if len(o) == self.k:
            self.least = int(self.scores[-1])


def search_task(weights: np.ndarray, queries: list[np.ndarray], n_docs: int, total: int, k: int):
    """A function over Arrow batches of stored postings: ``item, doc_id, score``
    with at most k rows a query."""
    def run(batches):
        best = [Best(k) for _ in queries]
        asked = np.zeros(len(weights), bool)
        held, postings = [], 0

        def close():
            t = pa.Table.from_batches(held).combine_chunks()
            flat = lambda c: t.column(c).combine_chunks()
            sizes = np.asarray(pa.compute.list_value_length(flat("terms")))
            block = Block(t.column("doc_id").fill_null(NULL_ID).to_numpy(), t.column("n").to_numpy(), sizes,
                          flat("terms").flatten().to_numpy(), flat("tfs").flatten().to_numpy(), weights, n_docs, total)
            for q, terms in enumerate(queries):
                asked[terms] = True
                block.search(terms, asked, best[q])
                asked[terms] = False

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            postings += len(b.column(2).flatten())
            if postings >= BLOCK_POSTINGS:
                close()
                held, postings = [], 0
        if held:
            close()
        item = np.repeat(np.arange(len(queries)), [len(b.ids) for b in best])
        ids = np.concatenate([b.ids for b in best]) if best else np.empty(0, np.int64)
        scores = np.concatenate([b.scores for b in best]) if best else ids
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(ids, mask=ids == NULL_ID), pa.array(scores)],
            ["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id",
           item_col: str = "item_id") -> DataFrame:
    """The ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id,
    text): ``item_id, rank, doc_id, score``, scores above 0."""
    spark = docs.sparkSession
    on_workers(spark)
    kind = dict(items.dtypes)[item_col]
    out = scratch_path(spark, "best_positions")
    schema = f"{item_col} {kind}, rank int, doc_id long, score long"
    for rows in batches_of(materialize(query_terms(items, item_col), "item_terms")):
        words = {t: i for i, t in enumerate(sorted({bytes(t) for _, t in rows}))}
        names = {}
        for item, t in rows:
            names.setdefault(item, []).append(words[bytes(t)])
        stored = materialize(count_terms(docs, words, id_col), "query_postings")
        n_docs, total = stored.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(words), np.int64)
        for t, df in stored.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():
            weights[t] = weight(n_docs, df)  # one number a query term
        queries = [np.array(sorted(v), np.int64) for v in names.values()]
        found = stored.filter(F.size("terms") > 0).mapInArrow(
            search_task(weights, queries, n_docs, total, k), "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ids = spark.createDataFrame(list(enumerate(names)), f"i long, {item_col} {kind}")  # bounded by the batch
        top.join(F.broadcast(ids), F.col("item") == F.col("i")).select(item_col, "rank", "doc_id", "score") \
            .write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)
