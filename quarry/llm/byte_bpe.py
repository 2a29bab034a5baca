"""Byte-level BPE encoding and decoding with a rank queue on bitmaps.

The bytes of pre-tokens form a linked list, with a barrier after each
pre-token.  Every adjacent pair that has a rank puts its position into that
rank's bucket; a three-level bitmap marks the ranks whose buckets hold
something, so find-first-set gives the next rank in three steps whatever the
length.  A bucket is worked off from left to right; it is put back if a merge
makes a pair of a smaller rank.  A merge only touches its two neighbours;
entries that a merge made stale are skipped when they come up.  Cost: O(n log n)
for n bytes, which suits very long pre-tokens (no white space, one script), and
all new pre-tokens of some texts share one queue.

Tokens of pre-tokens met before are kept in a bounded table of the worker.

Defined cases: a null text is encoded like an empty one (no ids, empty bytes);
repeated rows are encoded each for itself; an empty table gives an empty
result; the digest query ignores extra columns, ``encode``/``decode`` keep them.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import hold, on_workers, text_bytes


class RankQueue:
    """Buckets of positions by rank; the smallest rank that has one is next."""

    __slots__ = ("buckets", "low", "mid", "top")

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def take(self) -> tuple[int, list[int]] | None:
        """The smallest rank and its bucket, ascending; both leave the queue."""
        top = self.top
        if not top:
            return None
        a = (top & -top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        rank = b << 6 | (word & -word).bit_length() - 1
        word &= word - 1
        self.low[b] = word
        if not word:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class ByteBPE(dict):
    """Ids of pre-tokens, as packed unsigned 32-bit integers, by their text."""

    MOST = 500_000  # entries kept
    LONGEST = 64  # characters of a pre-token that is worth keeping
    TEXTS = 100  # texts whose new pre-tokens are merged together

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(self.ranks.values()) + 1
        self.token = {i: b for b, i in self.ranks.items()}
        self.single = [self.ranks[bytes([i])] for i in range(256)]
        # rank of the pair of two tokens: that of the token of their bytes
        rank = self.ranks.get
        self.pair = {left << 17 | right: i for b, i in self.ranks.items() for k in range(1, len(b))
                     if (left := rank(b[:k])) is not None and (right := rank(b[k:])) is not None}
        self.pieces = regex.compile(pattern).findall

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token."""
        single, get = self.single, self.pair.get
        token, starts = [], []
        for p in pieces:
            starts.append(len(token))
            whole = self.ranks.get(p)
            token += [whole] if whole is not None else [single[b] for b in p]
            token.append(-1)  # the barrier: no pair with it has a rank
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = [get(a << 17 | b) for a, b in zip(token, token[1:])]  # rank of the pair that begins at i
        now.append(None)
        queue = RankQueue(self.size)
        buckets, new = queue.buckets, queue.open
        for i, r in enumerate(now):
            if r is not None:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    new(r, [i])
        while entry := queue.take():
            rank, bucket = entry
            for at, i in enumerate(bucket):
                if now[i] != rank:
                    continue  # stale
                gone = after[i]
                end = after[gone]
                token[i], after[i], before[end], now[gone] = rank, end, i, None
                now[i] = r = get(rank << 17 | token[end])
                if r is not None:
                    if r in buckets:
                        buckets[r].append(i)
                    else:
                        new(r, [i])
                lower = r is not None and r < rank
                j = before[i]
                if j >= 0:
                    now[j] = r = get(token[j] << 17 | rank)
                    if r is not None:
                        if r in buckets:
                            buckets[r].append(j)
                        else:
                            new(r, [j])
                        lower = lower or r < rank
                if lower and at + 1 < len(bucket):
                    new(rank, bucket[at + 1:])
                    break
        out = []
        for i in starts:
            ids = []
            while (t := token[i]) >= 0:
                ids.append(t)
                i = after[i]
            out.append(ids)
        return out

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed ids of pre-tokens not known yet; the short ones are kept."""
        ids = self.merge([p.encode("utf-8", "surrogatepass") for p in pieces])
        packed = np.array([i for x in ids for i in x], "<u4").tobytes()
        found, at = {}, 0
        for p, x in zip(pieces, ids):
            found[p] = packed[at:at + 4 * len(x)]
            at += 4 * len(x)
        self.update((p, x) for p, x in found.items() if len(p) <= self.LONGEST)
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text."""
        out = []
        for i in range(0, len(texts), self.TEXTS):
            if len(self) > self.MOST:
                self.clear()
            pieces = [self.pieces(x) if x else [] for x in texts[i:i + self.TEXTS]]
            ids = [list(map(self.get, x)) for x in pieces]
            new = [k for k, x in enumerate(ids) if None in x]
            found = self.learn(list({p for k in new for p, x in zip(pieces[k], ids[k]) if x is None}))
            for k in new:
                ids[k] = [found[p] if x is None else x for p, x in zip(pieces[k], ids[k])]
            out += map(b"".join, ids)
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_loaded: dict[tuple[str, str], ByteBPE] = {}


def load(path: str, pattern: str) -> ByteBPE:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBPE(path, pattern)
    hold(_loaded[path, pattern])
    return _loaded[path, pattern]


def _add(df: DataFrame, kind: str, fn, without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with columns that ``fn`` makes of each Arrow batch; the columns
    ``without`` stay in the worker."""
    on_workers(df.sparkSession)
    keep = [i for i, c in enumerate(df.columns) if c not in without]

    def run(batches):
        for b in batches:
            t = pa.table(b.columns, names=[f"c{i}" for i in range(b.num_columns)])
            made, t = fn(t), t.select(keep)
            for c in made.column_names:
                t = t.append_column(c, made.column(c))
            yield from t.to_batches()

    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    made = plain.mapInArrow(run, ", ".join(f"c{i} {df.dtypes[i][1]}" for i in keep) + ", " + kind)
    return made.toDF(*[names[i] for i in keep], *made.columns[len(keep):])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, the token ids of each whole text."""
    at = df.columns.index(text)

    def fn(t):
        enc = load(path, pattern)
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in enc.encode_all(t.column(at).to_pylist())]
        return pa.table({"ids": pa.array(ids, pa.list_(pa.int32()))})

    return _add(df.drop("ids"), "ids array<int>", fn)


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``df`` (with ``ids``) with ``decoded``, the bytes of its ids (null: none)."""
    at = df.columns.index("ids")

    def fn(t):
        enc = load(path, pattern)
        return pa.table({"decoded": pa.array([enc.decode(x or ()) for x in t.column(at).to_pylist()], pa.binary())})

    return _add(df.drop("decoded"), "decoded binary", fn)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, exact``: texts encoded,
    the ids decoded again; ``exact``: the bytes are those of the text."""
    def fn(t):
        enc = load(path, pattern)
        n, ids_sha, decoded_sha, exact = [], [], [], []
        for i in range(0, t.num_rows, enc.TEXTS):  # a batch's texts and ids are never all held
            texts = t.column(1).slice(i, enc.TEXTS).to_pylist()
            for x, packed in zip(texts, enc.encode_all(texts)):
                back = enc.decode(np.frombuffer(packed, "<u4").tolist())
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                decoded_sha.append(hashlib.sha256(back).hexdigest())
                exact.append(back == text_bytes(x))
        return pa.table({"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                         "decoded_sha256": pa.array(decoded_sha, pa.string()), "exact": pa.array(exact, pa.bool_())})

    return _add(docs.select(F.col("doc_id"), F.col("text")),
                "n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean", fn, without=("text",))
