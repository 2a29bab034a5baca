"""Near-dedup by Order MinHash.

A document's k-mers are its shingles of five consecutive words, each labelled
with its occurrence (the second "a b c d e" differs from the first).  A sketch
takes the few k-mers with the smallest hashes and keeps them in the order of
the text; documents with an equal sketch are candidates.  Equal sketches need
the same k-mers in the same order, so they are sensitive to edit similarity.

Candidates are verified by banded alignment of their labelled k-mers: with m
k-mers matched in order, the similarity is m / (n1 + n2 - m), and documents
link at 0.8 or more.  The band is as wide as that similarity allows, so it
loses nothing.  The Jaccard similarity of their sets of distinct shingles must
be 0.8 or more too, so that one line repeated hundreds of times in two
documents does not link them.

Copies (equal word sequences) collapse to their smallest id first.  In each
bucket all members are verified against the most central one (that shares most
buckets with most others; linear).  Members that are then still in different
components of a bucket are compared by signature, chunk by chunk, those outside
the bucket's largest component with all: first only the likeliest pair of each
such member and component is verified, and, with the components that this
connects, all other pairs that can link.  So no candidate pair is left untested
unless it is connected already, and families of copies never become pairs.
Nothing is capped.

Before any text moves, candidates are compared by their signatures (two
bits each of 512 minimum hashes of distinct shingles, in 16 integers): it drops
pairs of which fewer than 399 agree, where 435 are expected at similarity 0.8 (a
pair of exactly 0.8 is dropped with probability 8.2e-6, far less often than the
sketches miss one, 1e-4; at 0.81 with 7e-7), so pairs that only share a passage
never become rows.  Jaccard distance is a metric, so two members of a bucket whose
verified distances to the central one differ by more than 0.2 cannot link, and
that drops pairs between a large family and its more distant relatives.

Recall of a pair with similarity s, of the sketches alone: 1 - (1 - s^5)^24 for
long documents, 0.9999 at 0.8; documents of up to 50 k-mers have 12 sketches of
two k-mers instead (0.99999), those of 32 to 50 both, so that a pair across the
border shares a kind.

Defined cases: texts without words link with nothing; texts of one to four
words are one k-mer; a null doc_id links with nothing and is kept, with a null
component; rows of one doc_id are one document (any of their links counts);
an empty table gives an empty result; extra columns are ignored by ``classes``
and kept by ``keep_one``.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix64, on_workers, window_hashes, word_hashes
from quarry.llm.components import connected_components
from quarry.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
# (k-mers of a sketch, sketches, fewest and most k-mers of a document)
LONG, SHORT = (5, 24, 32, None), (2, 12, 1, 50)
SEED = 7
LANES, LEAST_EQUAL = 512, 399
MATRIX = 2_000_000  # hashes at a time
NEAR = 64_000  # minimum hashes at a time, in one buffer that stays in the core's cache
FEW, MANY = 1000, 4000  # members of a bucket that a task compares with each other
BROADCAST_IDS = 2_000_000  # ids of candidates (32 MB) that may be broadcast, counted first


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of k words (of all words, if fewer), in order."""
    return window_hashes(words, min(k, len(words))) if len(words) else words


def kmers(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers of a text, in order."""
    return labelled(shingles(word_hashes(text), k))


def labelled(x: np.ndarray) -> np.ndarray:
    """Shingles made distinct by their occurrence: the first stays as it is."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    again = np.flatnonzero(s[1:] == s[:-1]) + 1
    if len(again):
        place = np.arange(len(s))
        first = np.maximum.accumulate(np.where(np.append(True, s[1:] != s[:-1]), place, 0))
        x = x.copy()
        x[order[again]] = mix64(s[again] + (place - first)[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x


def _distinct(x: np.ndarray) -> np.ndarray:
    """As ``np.unique``, which is slower on the shingles of one text."""
    s = np.sort(x)
    return s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def _draws(kind) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + kind[0])
    n = kind[1]
    return (rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, n, dtype=np.uint64))


_parameters = {k: _draws(k) for k in (LONG, SHORT)}
_lanes = tuple((d >> np.uint64(31)).astype(np.uint32) | np.uint32(1) for d in _draws((100, LANES)))


def signature(x: np.ndarray) -> list[int]:
    """Two bits of each of 512 minimum hashes of shingles, as 16 integers."""
    a, b = _lanes
    x = (x >> np.uint64(32)).astype(np.uint32)
    rows = min(LANES, max(1, NEAR // len(x)))
    low, buffer = np.empty(LANES, np.uint32), np.empty((rows, len(x)), np.uint32)
    for i in range(0, LANES, rows):
        v = buffer[:min(rows, LANES - i)]
        np.bitwise_xor(x, b[i:i + rows, None], out=v)
        np.multiply(v, a[i:i + rows, None], out=v)
        v.min(1, out=low[i:i + rows])
    bits = (mix64(low.astype(np.uint64)) & np.uint64(3)).reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(bits, axis=1).astype(np.int64).tolist()


def _alike(s, t, n, m, least: float):
    """Whether two signatures and counts of distinct shingles can belong to a link."""
    equal = F.lit(0)
    for i in range(LANES // 32):
        x = F.get(s, i).bitwiseXOR(F.get(t, i))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        equal = equal + 32 - F.bit_count(x)
    return (F.least(n, m) >= F.lit(least) * F.greatest(n, m)) & (equal >= LEAST_EQUAL)


def _smallest(v: np.ndarray, take: int) -> np.ndarray:
    """Places of the ``take`` smallest values of each row, ascending."""
    if v.shape[1] <= take:
        return np.tile(np.arange(v.shape[1]), (len(v), 1))
    row, at = np.nonzero(v <= np.partition(v, take - 1, axis=1)[:, take - 1:take])
    if len(at) != take * len(v):  # equal values
        at = np.argpartition(v, take - 1, axis=1)[:, :take]
        at.sort(axis=1)
    return at.reshape(-1, take)


def sketches(x: np.ndarray) -> list[int]:
    """Keys of all sketches of a document's k-mers."""
    out = []
    for no, kind in enumerate((LONG, SHORT)):
        take, count, least, most = kind
        if len(x) < least or (most is not None and len(x) > most):
            continue
        a, b = _parameters[kind]
        rows = max(1, MATRIX // len(x))
        for i in range(0, count, rows):
            v = (x[None, :] ^ b[i:i + rows, None]) * a[i:i + rows, None]
            v ^= v >> np.uint64(32)
            picked = x[_smallest(v, take)]
            key = np.arange(i, i + len(v), dtype=np.uint64) + np.uint64(1000 * no)
            for c in range(picked.shape[1]):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + picked[:, c])
            out += key.astype(np.int64).tolist()
    return out


def similarity(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """m / (n1 + n2 - m) for the longest in-order matching inside the band;
    exact whenever it is ``least`` or more, else some smaller number."""
    total = len(x) + len(y)
    if not total:
        return 0.0
    need = least * total / (1 + least)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if len(i) < need - 1e-9:
        return len(i) / (total - len(i)) if total > len(i) else 1.0
    order = np.argsort(i)
    i, j = i[order], j[order]
    band = total - 2 * need + 1
    j = j[np.abs(i - j) <= band]
    if (j[1:] > j[:-1]).all():
        m = len(j)
    else:  # labels are distinct, so the alignment is a longest increasing subsequence
        tails: list[int] = []
        for v in j.tolist():
            at = bisect_left(tails, v)
            if at == len(tails):
                tails.append(v)
            else:
                tails[at] = v
        m = len(tails)
    return m / (total - m)


def compare(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> tuple[float, bool]:
    """Jaccard similarity of two texts, given by their shingles, and whether
    they are near-copies."""
    u, v = _distinct(x), _distinct(y)
    both = len(np.intersect1d(u, v, assume_unique=True))
    total = len(u) + len(v) - both
    j = both / total if total else 0.0
    return j, j >= least - 1e-12 and similarity(labelled(x), labelled(y), least) >= least - 1e-12


def _describe(batches):
    for b in batches:
        copy, n, keys, signs = [], [], [], []
        for text in b.column(1).to_pylist():
            w = word_hashes(text)
            x = shingles(w)
            distinct = _distinct(x)
            x = labelled(x)
            copy.append(xxhash.xxh3_128_digest(w.tobytes()))
            n.append(len(distinct))
            keys.append(sketches(x) if len(x) else [])
            signs.append(signature(distinct) if len(x) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(copy, pa.binary()), pa.array(n, pa.int64()), pa.array(signs, pa.list_(pa.int64())),
             pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "copy", "n", "signs", "keys"])


def _verify(least):
    def run(batches):
        for b in batches:
            found = [compare(shingles(word_hashes(s)), shingles(word_hashes(t)), least)
                     for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([1 - j for j, _ in found], pa.float64()),
                 pa.array([ok for _, ok in found], pa.bool_())], ["a", "b", "distance", "linked"])
    return run


def _verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) with their distance and whether they link, stored."""
    pairs = materialize(pairs.distinct(), "candidates")
    named = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    named = materialize(named, "candidate_ids")
    if named.count() <= BROADCAST_IDS:  # else the texts are shuffled by id to find the candidates'
        named = F.broadcast(named)
    texts = materialize(docs.join(named, docs.doc_id == named.id, "left_semi"), "texts")
    kind = dict(docs.dtypes)["doc_id"]
    p = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("s")), "a")
    p = p.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t")), "b")
    return materialize(p.select("a", "b", "s", "t").mapInArrow(
        _verify(least), f"a {kind}, b {kind}, distance double, linked boolean"), "verified")


def _signed(pairs: DataFrame, alone: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures and counts can belong to a link."""
    one = lambda side: alone.select(*[F.col(c).alias(f"{side}_{c}") for c in ("doc_id", "n", "signs")])
    p = pairs.join(one("s"), F.col("a") == F.col("s_doc_id")).join(one("t"), F.col("b") == F.col("t_doc_id"))
    return p.filter(_alike(F.col("s_signs"), F.col("t_signs"), F.col("s_n"), F.col("t_n"), least)).select("a", "b")


def _equal_lanes(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Equal lanes of each row of ``s`` and each of ``t`` (16 integers a row)."""
    equal = np.full((len(s), len(t)), LANES, np.int32)
    for i in range(LANES // 32):
        x = s[:, i, None] ^ t[None, :, i]
        x = (x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)
        equal -= np.bitwise_count(x)
    return equal


def _candidates(least: float, every: bool):
    """Pairs of a chunk of outside members and a chunk of all members of a
    bucket that can link and are not connected: all, or only the likeliest of
    each outside member and component.  Two members meet in all their common
    buckets, each of which is open (they are not connected); the one with the
    smallest key counts the pair."""
    def run(key, t):
        bucket = key[0].as_py()
        t = t.sort_by("doc_id")
        keys = t.column("keys").combine_chunks()
        width = int(pa.compute.max(keys.value_lengths()).as_py())
        table = np.full((t.num_rows, width), bucket, np.int64)  # rows with fewer keys repeat this bucket's
        size = keys.value_lengths().to_numpy()
        table[np.arange(width) < size[:, None]] = keys.flatten().to_numpy()
        few = np.flatnonzero(t.column("mine").to_numpy(zero_copy_only=False))
        many = np.flatnonzero(t.column("other").to_numpy(zero_copy_only=False))
        ids, n, label = (t.column(c).to_numpy() for c in ("doc_id", "n", "label"))
        outside = t.column("outside").to_numpy(zero_copy_only=False)
        away = t.column("distance").to_numpy(zero_copy_only=False)  # NaN where it is not known
        signs = np.array(t.column("signs").combine_chunks().flatten().to_numpy()).reshape(len(ids), -1).view(np.uint64)
        a, b = [np.empty(0, ids.dtype)], [np.empty(0, ids.dtype)]
        for i in range(0, len(few), 200):
            x = few[i:i + 200, None]
            can = (label[x] != label[many]) & (~outside[many] | (ids[x] < ids[many]))
            can &= np.minimum(n[x], n[many]) >= least * np.maximum(n[x], n[many])
            can &= ~(np.abs(away[x] - away[many]) > 1 - least + 1e-9)
            equal = np.where(can, _equal_lanes(signs[x[:, 0]], signs[many]), 0)
            r, c = np.nonzero(equal >= LEAST_EQUAL)
            first = np.ones(len(r), bool)
            for k in range(0, len(r), 1000):
                u, v = table[x[r[k:k + 1000], 0]], table[many[c[k:k + 1000]]]
                first[k:k + 1000] = ~((u < bucket) & (u[:, :, None] == v[:, None, :]).any(2)).any(1)
            r, c = r[first], c[first]
            if not every:
                order = np.lexsort((c, -equal[r, c], label[many[c]], r))
                r, c = r[order], c[order]
                first = np.append(True, (r[1:] != r[:-1]) | (label[many[c[1:]]] != label[many[c[:-1]]]))[:len(r)]
                r, c = r[first], c[first]
            p, q = ids[x[r, 0]], ids[many[c]]
            a.append(np.minimum(p, q))
            b.append(np.maximum(p, q))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})
    return run


def _open_pairs(rows: DataFrame, label: DataFrame, alone: DataFrame, near: DataFrame, least: float,
                every: bool) -> DataFrame | None:
    """Candidates (a, b) inside the buckets ``rows`` (key, hub, doc_id) that hold
    members of several components: members outside the largest component of the
    bucket against all, chunk by chunk, so that no task holds a bucket.  None
    where there is no such bucket."""
    named = materialize(rows.join(label, rows.doc_id == label.node, "left").select(
        "key", "hub", "doc_id", F.coalesce("component", "doc_id").alias("label")), "bucket_labels")
    sizes = named.groupBy("key", "label").agg(F.count("*").alias("c"))
    split = sizes.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("all"),
                                     F.max("c").alias("inside"))
    split = materialize(split.filter("all > inside").select(
        "key", "main", F.ceil((F.col("all") - F.col("inside")) / FEW).cast("int").alias("ps"),
        F.ceil(F.col("all") / MANY).cast("int").alias("qs")), "split_buckets")
    if split.isEmpty():
        return None
    m = named.join(split, "key").filter("doc_id <> hub").join(  # the hub has been compared with all
        near, (F.col("hub") == F.col("near_a")) & (F.col("doc_id") == F.col("near_b")), "left")
    m = m.join(alone.select(F.col("doc_id").alias("of"), "n", "signs", "keys"), F.col("doc_id") == F.col("of"))
    m = m.withColumn("outside", F.col("label") != F.col("main"))
    share = lambda k, salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.col(k)).cast("int")
    kept = ["key", "doc_id", "label", "outside", "n", "signs", "keys", F.coalesce("distance", F.lit(float("nan"))).alias("distance")]
    spread = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    mine = m.filter("outside").select(*kept, share("ps", 1).alias("p"), spread("qs").alias("q"),
                                      F.lit(True).alias("mine"), F.lit(False).alias("other"))
    other = m.select(*kept, spread("ps").alias("p"), share("qs", 2).alias("q"),
                     F.lit(False).alias("mine"), F.lit(True).alias("other"))
    kind = dict(alone.dtypes)["doc_id"]
    return mine.union(other).groupBy("key", "p", "q").applyInArrow(_candidates(least, every), f"a {kind}, b {kind}")


def links(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links (a, b) whose components are the classes of near-copies."""
    on_workers(docs.sparkSession)
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    kind = dict(docs.dtypes)["doc_id"]
    s = materialize(docs.mapInArrow(_describe, f"doc_id {kind}, copy binary, n long, signs array<bigint>, keys array<bigint>")
                    .filter("n > 0"), "sketches")
    firsts = materialize(s.groupBy("copy").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")),
                         "copies")
    more = firsts.filter("rows > 1")
    copies = materialize(s.select("copy", "doc_id").join(more, "copy").filter("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")), "copy_links")
    alone = s.join(firsts, (s.doc_id == firsts["first"]) & (s.copy == firsts.copy), "left_semi") \
        .groupBy("doc_id").agg(F.first(F.struct("n", "signs", "keys")).alias("r")).select("doc_id", "r.*")
    alone = materialize(alone, "distinct_sketches")
    rows = alone.select("doc_id", F.explode("keys").alias("key"))
    sizes = materialize(rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "bucket_sizes")
    rows = materialize(rows.join(sizes, "key"), "bucket_rows")
    # the member that shares most with others: an original, where the rest are its edited copies
    central = materialize(rows.groupBy("doc_id").agg(F.sum("c").alias("weight")).withColumnRenamed("doc_id", "of"),
                          "bucket_weights")
    buckets = materialize(rows.join(central, rows.doc_id == central.of).groupBy("key").agg(F.max_by("doc_id", F.struct(
        "weight", (-F.col("doc_id")).alias("i"))).alias("hub")), "buckets")
    rows = materialize(rows.select("key", "doc_id").join(buckets, "key"), "bucket_rows")
    hubs = rows.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    tested = _verified(_signed(hubs, alone, least), docs, least)
    found = tested.filter("linked").select("a", "b")
    near = tested.select(F.col("a").alias("near_a"), F.col("b").alias("near_b"), "distance").distinct()
    # members that are not yet connected inside a bucket: the likeliest pairs first, then all that are left
    label = materialize(connected_components(found), "labels")
    pairs = _open_pairs(rows, label, alone, near, least, False)
    if pairs is None:
        return copies.union(found)
    likely = _verified(pairs, docs, least)
    joined = likely.filter("linked").select("a", "b")
    if not joined.isEmpty():
        found = materialize(found.union(joined), "links")
        label = materialize(connected_components(found), "labels")
    pairs = _open_pairs(rows, label, alone, near, least, True)
    if pairs is None:
        return copies.union(found)
    rest = _verified(pairs.join(likely.select("a", "b"), ["a", "b"], "left_anti"), docs, least)
    return copies.union(found).union(rest.filter("linked").select("a", "b"))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, component_id, kept`` of each row: the class of near-copies by
    its smallest id, and whether the row is that one."""
    c = materialize(connected_components(links(docs, least)), "classes")
    d = docs.select("doc_id")
    return d.join(c, d.doc_id == c.node, "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` without the near-copies: one document of each class stays."""
    c = connected_components(links(docs.select("doc_id", "text"), least))
    gone = materialize(c.filter("node <> component").select(F.col("node").alias("_gone")), "near_copies")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
