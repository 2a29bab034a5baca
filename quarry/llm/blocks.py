"""Document blocks: a layout for operators that look up, for every document, a
corpus-wide fact about each of its words or windows.

Documents are stored once in blocks (hash of the id) as a bucketed table, so
every later pass over a block reads its files without a shuffle.  What a block
asks about its windows goes out as one compressed array per key range
("shard"), not one row per window; the shard answers with an array in the same
order.  A window that one block holds many times is asked for once, so no hot
window, word or copy makes a shard larger than the number of blocks times the
shard's width.  Blocks and shards are both sized from the corpus, in bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import save_bucketed

BLOCK_CHARS = 6_000_000  # text of a block: about 1M words, 100 MB of arrays in a task
LEAST_BLOCKS = 48

_pack = zstandard.ZstdCompressor(level=1)
_unpack = zstandard.ZstdDecompressor()


def squeeze(a: np.ndarray) -> bytes:
    """An array as compressed byte planes (equal high bytes stand together)."""
    if not len(a):
        return b""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize)
    return _pack.compress(np.ascontiguousarray(planes.T).tobytes())


def expand(b: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    if not b:
        return np.empty(0, dtype)
    planes = np.frombuffer(_unpack.decompress(b), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def squeeze_sorted(a: np.ndarray) -> bytes:
    """An ascending array of unsigned 64-bit integers by its gaps."""
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def expand_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(expand(b, np.uint64), dtype=np.uint64)


def squeeze_bits(a: np.ndarray) -> bytes:
    return _pack.compress(np.packbits(a).tobytes()) if len(a) else b""


def expand_bits(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, bool)
    return np.unpackbits(np.frombuffer(_unpack.decompress(b), np.uint8), count=n).astype(bool)


def corpus_chars(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]


def store_blocks(docs: DataFrame, chars: int, name: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (doc_id, text and more) with ``block``, stored in buckets of
    blocks; rows of one id share a block."""
    n = max(LEAST_BLOCKS, -(-chars // block_chars))
    buckets = min(max(LEAST_BLOCKS, n // 2), 50_000)
    d = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("long"))
    return save_bucketed(d.repartition(buckets, "block"), name, "block", buckets)


def in_order(t: pa.Table) -> pa.Table:
    """A block's documents in the order that all passes use: by id (null
    first), then text."""
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if t.num_rows else t


def ids_of(t: pa.Table) -> np.ndarray:
    """Ids for comparison; null counts as smaller than any other."""
    return t.column("doc_id").cast(pa.int64()).fill_null(-(2**63)).to_numpy()


def by_shard(keys: np.ndarray, cuts: np.ndarray):
    """Bounds of the runs of each shard in ascending ``keys``; shard s begins
    at ``cuts[s]``."""
    at = np.append(np.searchsorted(keys, cuts), len(keys))
    for s in np.flatnonzero(np.diff(at)):
        yield int(s), slice(int(at[s]), int(at[s + 1]))


def hash_cuts(shards: int) -> np.ndarray:
    """First 64-bit hashes of equal ranges."""
    return (np.arange(shards, dtype=object) * (2**64) // shards).astype(np.uint64)
