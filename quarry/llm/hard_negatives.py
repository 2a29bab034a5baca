"""Hard-negative mining by a secondary-sort shuffle.

Scores are packed into 25-byte keys of (anchor, descending score, kind, id) whose
byte order is the order wanted; ``repartitionAndSortWithinPartitions`` deals them
by anchor and sorts them, and one streaming iterator a partition walks the keys:
at a positive it opens a window of scores, at a negative it emits a row for each
open window that it falls into, and a window closes when it is full or the
scores have fallen below it.  What the iterator holds is at most ``POSITIVES``
windows, never an anchor's rows.

Vectors lie in blocks, anchors in groups; a task scores one group against one
block.  Before the shuffle each task keeps what can still be in the result: of
one label the first ``POSITIVES`` rows of the block, and, once the positives are
known, of the other labels the first ``NEGATIVES`` rows of the block inside the
window of each positive.  Any row that is dropped has enough rows before it in its own
block, so the result is exact, and a vector that a third of the rows share adds
a few keys a block.  The number of blocks grows with the rows only beyond
``BLOCK_ROWS``.

Defined cases: rows with a null id or label, a null vector, or a null or
non-finite component take no part; vectors are compared with anchors of the same
length only (the empty vector has score 0); rows that repeat an id count once,
with the smallest label, then vector; an empty table gives an empty result; extra
columns are ignored; scores beyond 64 bits raise an error.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import on_workers
from quarry.session import materialize

# Fixed values of the task: label change, anchors, and the windows of scores in hundredths of the positive's
RELABEL_EVERY, LABELS, ANCHOR_EVERY = 7, 10, 50
LOWEST, HIGHEST = 50, 95
POSITIVES, NEGATIVES = 5, 3
SCALE = 256
LEAST_BLOCKS, BLOCK_ROWS = 16, 250_000
GROUP_ANCHORS = 2_000
CHUNK_ROWS = 4_096  # rows of a block that are scored at a time

_KEY = struct.Struct(">QQBQ")
_TOP = 1 << 63


def pack_key(anchor: int, score: int, kind: int, row: int) -> bytes:
    """Bytes in the order of anchor, falling score, kind (0 a positive, 1 a
    negative), id."""
    return _KEY.pack(anchor + _TOP, _TOP - 1 - score, kind, row + _TOP)


def unpack_key(key: bytes) -> tuple[int, int, int, int]:
    a, s, kind, row = _KEY.unpack(key)
    return a - _TOP, _TOP - 1 - s, kind, row - _TOP


def window_of(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative: LOWEST/100 to HIGHEST/100 of the
    positive's (empty when that is negative)."""
    return -(-LOWEST * positive // 100), HIGHEST * positive // 100


def mine(keys, positives: int = POSITIVES, negatives: int = NEGATIVES):
    """Rows ``anchor, positive, rank, negative, positive_score, negative_score``
    from packed keys in ascending order."""
    at, open_, seen = None, [], 0
    for key in keys:
        anchor, score, kind, row = unpack_key(key)
        if anchor != at:
            at, open_, seen = anchor, [], 0
        if kind == 0:
            if seen < positives:
                seen += 1
                low, high = window_of(score)
                if low <= high:
                    open_.append([row, score, low, high, 0])
            continue
        closed = False
        for w in open_:
            if score > w[3]:
                continue
            if score >= w[2]:
                w[4] += 1
                yield anchor, w[0], w[4], row, w[1], score
            closed |= w[4] == negatives or score < w[2]
        if closed:
            open_ = [w for w in open_ if w[4] < negatives and score >= w[2]]


def scores_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of whole numbers (as doubles)."""
    if not x.size or not y.size:
        return np.zeros((len(x), len(y)), np.int64)
    most = float(np.abs(x).max()) * float(np.abs(y).max()) * x.shape[1]
    if most < 2**53:  # every partial sum is a whole number that a double holds
        return np.rint(x @ y.T).astype(np.int64)
    if most < 2**62:
        return x.astype(np.int64) @ y.astype(np.int64).T
    raise OverflowError("scores beyond 64 bits")


def first_rows(s: np.ndarray, allowed: np.ndarray, count: int):
    """For each row of ``s`` the columns of its ``count`` greatest allowed values,
    greatest first, equal ones by place; -1 where there are fewer."""
    width = s.shape[1]
    span = int(s.max(initial=0)) - int(s.min(initial=0)) + 2
    if span < 2**62 // max(width, 1):
        key = np.where(allowed, (s - s.min(initial=0) + 1) * width + np.arange(width - 1, -1, -1), 0)
        take = min(count, width)
        top = -np.sort(-np.partition(key, width - take, axis=1)[:, width - take:], axis=1) if take else key[:, :0]
        return np.where(top > 0, width - 1 - top % max(width, 1), -1)
    out = np.full((len(s), min(count, width)), -1, np.int64)
    for i in range(len(s)):
        at = np.flatnonzero(allowed[i])
        at = at[np.lexsort((at, -s[i, at]))][:count]
        out[i, :len(at)] = at
    return out


class Side:
    """Vectors of a task in ascending order of their ids, by length."""

    def __init__(self, t: pa.Table):
        t = t.sort_by("id")
        self.ids, self.labels = t.column("id").to_numpy(), t.column("label").to_numpy()
        v = t.column("v").to_pylist()
        size = np.array([len(x) for x in v], np.int64)
        self.at = {int(n): np.flatnonzero(size == n) for n in np.unique(size)}
        self.x = {n: np.array([v[i] for i in at], float).reshape(len(at), n) for n, at in self.at.items()}


def by_chunk(anchors: Side, rows: Side):
    """``anchor places, row places, scores`` of pieces of a task."""
    for n, a in anchors.at.items():
        if n in rows.at:
            for i in range(0, len(rows.at[n]), CHUNK_ROWS):
                yield a, rows.at[n][i:i + CHUNK_ROWS], scores_of(anchors.x[n], rows.x[n][i:i + CHUNK_ROWS])


class Kept:
    """The first ``count`` rows of each anchor, merged piece by piece."""

    def __init__(self, anchors: int, count: int):
        self.count = count
        self.scores = np.zeros((anchors, 0), np.int64)
        self.ids = np.zeros((anchors, 0), np.int64)
        self.some = np.zeros((anchors, 0), bool)

    def add(self, places, scores, ids, cols):
        """Columns ``cols`` (-1: none) of ``scores`` for the anchors at ``places``."""
        new = [np.zeros((len(self.scores), cols.shape[1]), k) for k in (np.int64, np.int64, bool)]
        line = np.arange(len(places))[:, None]
        new[0][places], new[1][places], new[2][places] = scores[line, cols], ids[cols], cols >= 0
        s, i, some = (np.concatenate(x, axis=1) for x in zip((self.scores, self.ids, self.some), new))
        order = np.lexsort((i, -s, ~some), axis=1)[:, :self.count]
        self.scores, self.ids, self.some = (np.take_along_axis(x, order, 1) for x in (s, i, some))

    def table(self, anchors: Side) -> pa.Table:
        a, _ = np.nonzero(self.some)
        return pa.table({"anchor": anchors.ids[a], "score": self.scores[self.some], "row": self.ids[self.some]})


FOUND = "anchor long, score long, row long"


def best_positives(rows: Side, anchors: Side, count: int) -> pa.Table:
    kept = Kept(len(anchors.ids), count)
    for a, r, s in by_chunk(anchors, rows):
        allowed = (anchors.labels[a][:, None] == rows.labels[r]) & (anchors.ids[a][:, None] != rows.ids[r])
        kept.add(a, s, rows.ids[r], first_rows(s, allowed, count))
    return kept.table(anchors)


def best_negatives(rows: Side, anchors: Side, windows: dict[int, list[int]], positives: int, count: int) -> pa.Table:
    """Rows inside the windows of the positives with the scores ``windows[anchor]``."""
    low = np.ones((len(anchors.ids), positives), np.int64)
    high = np.zeros((len(anchors.ids), positives), np.int64)
    for i, a in enumerate(anchors.ids.tolist()):
        for j, p in enumerate(windows.get(a, ())):
            low[i, j], high[i, j] = window_of(p)
    kept = [Kept(len(anchors.ids), count) for _ in range(positives)]
    for a, r, s in by_chunk(anchors, rows):
        other = (anchors.labels[a][:, None] != rows.labels[r]) & (anchors.ids[a][:, None] != rows.ids[r])
        for j in range(positives):
            allowed = other & (s >= low[a, j, None]) & (s <= high[a, j, None])
            kept[j].add(a, s, rows.ids[r], first_rows(s, allowed, count))
    t = pa.concat_tables([k.table(anchors) for k in kept])
    return t.group_by(["anchor", "score", "row"], use_threads=False).aggregate([])  # windows overlap


def sound_rows(emb: DataFrame) -> DataFrame:
    """``id, label, v``: rows that take part, labels changed, components whole."""
    e = emb.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                   F.col("embedding").cast("array<double>").alias("v"))
    ok = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
          & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    e = e.filter(F.coalesce(ok, F.lit(False))).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    label = F.when(F.col("id") % RELABEL_EVERY == 0, (F.col("r.label") + 1) % LABELS).otherwise(F.col("r.label"))
    # floor() gives 64-bit integers; doubles from 2**53 on are whole already
    whole = lambda x: F.when(F.abs(x * SCALE) < 2.0**53, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE)
    return e.select("id", label.alias("label"), F.transform("r.v", whole).alias("v"))


def hard_negatives(emb: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the anchors of ``emb`` (vec_id, embedding, label)."""
    spark = emb.sparkSession
    on_workers(spark)
    rows = materialize(sound_rows(emb), "vectors")
    n = rows.count()
    n_anchors = rows.filter(F.col("id") % ANCHOR_EVERY == 0).count()
    blocks, groups = max(LEAST_BLOCKS, -(-n // BLOCK_ROWS)), max(1, -(-n_anchors // GROUP_ANCHORS))
    share = lambda k, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(k))
    every = lambda k, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))).alias(name)
    # each block once for each group of anchors, each group once for each block
    left = rows.select("id", "label", "v", share(blocks, 1).alias("block"), every(groups, "group"))
    own = [F.col(c).alias(c) for c in ("id", "label", "v")]  # columns apart from those of ``left``
    right = rows.filter(F.col("id") % ANCHOR_EVERY == 0).select(
        *own, share(groups, 2).alias("group"), every(blocks, "block"))

    def positives_of(r, a):
        return best_positives(Side(r), Side(a), positives) if a.num_rows else _none()

    pair = lambda d: d.groupBy("group", "block")
    found = pair(left).cogroup(pair(right)).applyInArrow(positives_of, FOUND)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "row")
    best = materialize(found.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= positives).drop("k"),
                       "positives")
    # anchors go out again with the scores of their positives
    scored = right.join(best.groupBy("anchor").agg(F.collect_list("score").alias("scores")),
                        F.col("id") == F.col("anchor")).select(
        *own, "group", "block", "scores")

    def negatives_of(r, a):
        if not a.num_rows:
            return _none()
        windows = dict(zip(a.column("id").to_pylist(), a.column("scores").to_pylist()))
        return best_negatives(Side(r), Side(a), windows, positives, negatives)

    other = pair(left).cogroup(pair(scored)).applyInArrow(negatives_of, FOUND)
    both = best.select("anchor", "score", F.lit(0).alias("kind"), "row").union(
        other.select("anchor", "score", F.lit(1).alias("kind"), "row"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def home(key: bytes) -> int:
        return (unpack_key(key)[0] * 0x9E3779B97F4A7C15 >> 32 & 0xFFFFFFFF) % parts

    dealt = both.rdd.map(lambda r: (pack_key(*r), None)).repartitionAndSortWithinPartitions(parts, home)
    mined = dealt.mapPartitions(lambda part: mine((k for k, _ in part), positives, negatives))
    return spark.createDataFrame(
        mined, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _none() -> pa.Table:
    return pa.table({"anchor": pa.array([], pa.int64()), "score": pa.array([], pa.int64()),
                     "row": pa.array([], pa.int64())})
