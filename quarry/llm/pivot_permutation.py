"""Embedding near-dedup by a pivot-permutation index.

Reference points (pivots) are drawn from the vectors and kept far apart.  A
vector is described by its nearest pivots in order.  Vectors that share at
least ``shared`` of their ``prefix`` nearest pivots are candidates: each vector
stands in the inverted lists of pairs of its pivots, taken from the first
``prefix - shared + 2`` in a fixed order, which is enough for any two vectors
with ``shared`` common pivots to meet; the shared pivots are then counted and
the cosine is computed in double precision.

A pair is counted in the first list that it shares only, so lists emit sums and
spanning links, never pairs.  Equal vectors collapse to one with a count.  A
list longer than ``CHUNK`` is dealt into chunks, and each pair of chunks is a
task of its own: no list has a cap, and no task holds more than two chunks.

The sample that pivots come from is bounded (``SAMPLE`` vectors); every vector
is indexed.  Recall against brute force: see README.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label or id, link with nothing (n_links 0,
their own component, kept); vectors of different length never link; rows are
vectors each for themselves, so repeated rows link with each other; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import on_workers
from quarry.llm.components import connected_components
from quarry.session import materialize

COSINE = 0.98
PREFIX, SHARED = 6, 3
SAMPLE = 4096
CHUNK = 1500
APART = 0.7  # pivots have a smaller cosine with each other


def pivot_count(vectors: int) -> int:
    """128 pivots up to a million vectors, twice as many for eight times more,
    so that lists stay short; 1024 at most."""
    n = 128
    while n < 1024 and vectors > 1_000_000 * (n // 128) ** 3:
        n *= 2
    return n


def choose_pivots(clean: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Unit pivots by vector length, from a sample of at most ``SAMPLE`` vectors
    (smallest hashes), each kept if it is far from those before."""
    rows = clean.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    out: dict[int, list[np.ndarray]] = {}
    for r in rows:
        v = np.array(r["v"])
        v /= np.linalg.norm(v)
        kept = out.setdefault(len(v), [])
        if len(kept) < count and all(abs(float(k @ v)) < APART for k in kept):
            kept.append(v)
    return {k: np.array(v) for k, v in out.items()}


def describe(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of unit rows, nearest first."""
    s = x @ pivots.T
    take = min(prefix, s.shape[1])
    near = np.argpartition(-s, take - 1, axis=1)[:, :take]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable"), 1)


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_links(emb: DataFrame, least: float = COSINE, prefix: int = PREFIX, shared: int = SHARED) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``emb`` (vec_id,
    embedding, label)."""
    spark = emb.sparkSession
    on_workers(spark)
    e = emb.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("v", lambda x: x != 0))
    clean = e.filter(F.coalesce(sound, F.lit(False)))
    # equal vectors of a label are one vector with a count
    group = materialize(clean.groupBy("label", "v").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("rows")), "distinct_vectors")
    n = group.count()
    pivots = choose_pivots(group, pivot_count(n))
    first = prefix - shared + 2
    kind = dict(e.dtypes)["vec_id"], dict(e.dtypes)["label"]

    def index(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            vectors = t.column("v").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            near, lists = [None] * len(vectors), [None] * len(vectors)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                p = pivots.get(int(size), np.empty((0, size)))
                d = describe(unit([vectors[i] for i in at]), p, prefix) if len(p) else np.empty((len(at), 0), int)
                for i, row in zip(at, d.tolist()):
                    near[i] = row
                    s = sorted(row)[:first]
                    # too few pivots to choose from: all vectors of the size meet
                    lists[i] = [x * len(p) + y for x, y in combinations(s, 2)] if len(row) == prefix else [-1]
            yield from t.append_column("near", pa.array(near, pa.list_(pa.int32()))).append_column(
                "list", pa.array(lists, pa.list_(pa.int64()))).to_batches()

    indexed = materialize(group.select("id", "label", "v", "rows").mapInArrow(
        index, f"id {kind[0]}, label {kind[1]}, v array<double>, rows long, near array<int>, list array<bigint>"),
        "pivot_index")
    entries = indexed.select("label", F.size("v").alias("size"), F.explode("list").alias("list"), "id")
    long = materialize(entries.groupBy("label", "size", "list").agg(F.count("*").alias("c")).filter("c > 1").select(
        F.col("label").alias("l_"), F.col("size").alias("s_"), F.col("list").alias("i_"),
        F.ceil(F.col("c") / CHUNK).cast("int").alias("chunks")), "pivot_lists")
    members = indexed.select("id", "label", "v", "rows", "near", F.size("v").alias("size"), F.explode("list").alias("list"))
    members = members.join(long, (F.col("label") == F.col("l_")) & (F.col("size") == F.col("s_"))
                           & (F.col("list") == F.col("i_")))
    mine = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    other = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda c: F.struct(F.least(c, mine).alias("p"), F.greatest(c, mine).alias("q")))
    members = members.withColumn("chunk", mine).withColumn("pair", F.explode(other)).select(
        "label", "size", "list", F.col("pair.p").alias("p"), F.col("pair.q").alias("q"), "chunk", "id", "v", "rows", "near")

    def compare(key, t):
        """Links inside a chunk (p = q) or between two."""
        _, _, the_list, p, q = (k.as_py() for k in key)
        ids = t.column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        rows = t.column("rows").to_numpy()[order]
        x = unit([t.column("v")[i].as_py() for i in order.tolist()])
        near = t.column("near").to_pylist()
        near = [near[i] for i in order.tolist()]
        of = t.column("chunk").to_numpy()[order]
        a, b = np.flatnonzero(of == p), np.flatnonzero(of == q)
        close = x[a] @ x[b].T >= least
        i, j = np.nonzero(close)
        i, j = a[i], b[j]
        if p == q:
            i, j = i[i < j], j[i < j]
        if the_list >= 0 and len(i):
            c = len(pivots[x.shape[1]])
            has = np.zeros((len(ids), c), bool)
            has[np.repeat(np.arange(len(ids)), [len(r) for r in near]), np.concatenate(near)] = True
            both = np.empty(len(i), bool)
            for s in range(0, len(i), 100_000):
                common = has[i[s:s + 100_000]] & has[j[s:s + 100_000]]
                lead = np.argmax(common, axis=1)
                rest = common.copy()
                rest[np.arange(len(rest)), lead] = False
                both[s:s + 100_000] = (common.sum(1) >= shared) & (lead * c + np.argmax(rest, axis=1) == the_list)
            i, j = i[both], j[both]
        links = np.bincount(i, weights=rows[j], minlength=len(ids)) + np.bincount(j, weights=rows[i], minlength=len(ids))
        root = np.arange(len(ids))
        while True:  # smallest linked place, until nothing moves
            low = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(links)
        return pa.table({"id": pa.array(ids[some]), "n": pa.array(links[some].astype(np.int64)),
                         "root": pa.array(ids[root[some]])})

    found = materialize(members.groupBy("label", "size", "list", "p", "q").applyInArrow(
        compare, f"id {kind[0]}, n long, root {kind[0]}"), "vector_links")
    sums = found.groupBy("id").agg(F.sum("n").alias("n"))
    comp = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    reps = group.select("label", "v", "id", "rows")
    reps = reps.join(sums, "id", "left").join(comp, reps.id == comp.node, "left").select(
        F.col("label").alias("l_"), F.col("v").alias("v_"), (F.col("rows") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    reps = materialize(reps, "vector_classes")
    out = e.withColumn("ok", F.coalesce(sound, F.lit(False))).join(
        reps, F.col("ok") & (F.col("label") == F.col("l_")) & (F.col("v") == F.col("v_")), "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
