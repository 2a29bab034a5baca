"""Line dedup: lines that many documents share leave all documents.

A line's key is the line without white space at its ends, A-Z lower-cased.  The
index is sharded by key hash: each shard is one row with a minimal perfect hash
over all distinct key hashes of its range (``perfect_hash``) and two arrays in
its places, a 16-bit fingerprint and the number of documents.  Documents probe
these arrays; lines are never joined with lines.

Documents lie in blocks (``blocks``).  A block sends the distinct key hashes of
its documents, with their document counts, as one array to each shard; shards
store them in buckets, so the shard's index is built from them and probed by
them without another exchange, and only one bit a distinct key goes back.  A
line that a third of all documents hold is one entry of a block, so no shard
gets more than its range of hashes from each block.  Blocks and shards grow with
the square root of the corpus up to ``MOST_CHARS`` and ``MOST_KEYS``, which the
memory of a task bounds; empty arrays are not sent, so there are never more
messages than pairs of block and distinct line.

Keys are told apart by 64-bit hashes: with d distinct lines, about d * f / 2**64
rare lines share a hash with one of f frequent ones (5e-8 at 1e6 and 1e6).

Defined cases: a null or empty text is one empty line; lines without a character
but white space have an empty key and always stay; each row is a document of its
own (repeated rows count each), whatever its doc_id, null too; a key counts once
a row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.blocks import (BLOCK_CHARS, by_shard, corpus_chars, expand, expand_bits, expand_sorted, hash_cuts,
                               squeeze, squeeze_bits, squeeze_sorted, store_blocks)
from quarry.llm.common import SPACE_CHARS, HashCache, mix64, on_workers
from quarry.llm.perfect_hash import PerfectHash, build
from quarry.session import save_bucketed

LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
MOST_CHARS = 512_000_000  # text of a block: at most 2 GB in a task
MOST_KEYS = 32_000_000  # keys of a shard: at most 1 GB in a task
LEAST_SHARDS = 16
LINE_CHARS = 60  # for the number of shards only

SPACES = SPACE_CHARS.encode()
_lines = HashCache()

INDEX = "shard long, n long, widths binary, words binary, prints binary, counts binary"


def block_chars(chars: int) -> int:
    """Text of a block: as the square root of the corpus, within bounds."""
    return int(min(MOST_CHARS, max(BLOCK_CHARS, 50 * math.sqrt(chars))))


def shard_count(chars: int) -> int:
    lines = chars // LINE_CHARS
    return max(LEAST_SHARDS, -(-lines // int(min(MOST_KEYS, max(500_000, 50 * math.sqrt(lines))))))


def key_lines(text: bytes | None) -> list[bytes]:
    """The key of each line of a text; ``bytes.lower`` lowers A-Z alone."""
    return [x.strip(SPACES) for x in (text or b"").lower().split(b"\n")]


def counted(key: bytes, least_chars: int) -> bool:
    return len(key) >= least_chars and (least_chars <= 1 or len(key.decode("utf-8", "replace")) >= least_chars)


def texts_of(t: pa.Table) -> list:
    return t.column("text").cast(pa.binary()).to_pylist()


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(48)).astype(np.uint16)


def block_keys(texts: list, least_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct key hashes of a block, ascending, and their document counts."""
    found = [np.empty(0, np.uint64)]
    for text in texts:
        keys = [k for k in set(key_lines(text)) if counted(k, least_chars)]
        found.append(np.fromiter(map(_lines.__getitem__, keys), np.uint64, len(keys)))
    return np.unique(np.concatenate(found), return_counts=True)


def send_keys(stored: DataFrame, cuts: np.ndarray, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``shard, block, keys, counts``: one row a block and shard."""
    def ask(key, t):
        keys, counts = block_keys(texts_of(t), least_chars)
        out = [(s, key[0].as_py(), squeeze_sorted(keys[at] - cuts[s]), squeeze(counts[at].astype(np.int64)))
               for s, at in by_shard(keys, cuts)]
        return pa.table(dict(zip(("shard", "block", "keys", "counts"), zip(*out))) if out else
                        {c: [] for c in ("shard", "block", "keys", "counts")},
                        schema=pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()),
                                          ("counts", pa.binary())]))

    return stored.groupBy("block").applyInArrow(ask, "shard long, block long, keys binary, counts binary")


def build_index(sent: DataFrame) -> DataFrame:
    """One row a shard: the perfect hash and its fingerprint and count arrays."""
    def run(key, t):
        keys = [expand_sorted(b.as_py()) for b in t.column("keys")]
        every = np.unique(np.concatenate(keys))
        widths, words = build(every)
        place = PerfectHash(widths, words)
        prints, counts = np.zeros(len(every), np.uint16), np.zeros(len(every), np.int64)
        prints[place.places(every)] = fingerprints(every)
        for k, c in zip(keys, t.column("counts")):
            counts[place.places(k)] += expand(c.as_py(), np.int64)  # distinct keys of one block: distinct places
        return pa.table({"shard": [key[0].as_py()], "n": [len(every)], "widths": [widths.tobytes()],
                         "words": [words.tobytes()], "prints": [prints.tobytes()], "counts": [squeeze(counts)]})

    return sent.groupBy("shard").applyInArrow(run, INDEX)


class Shard:
    """The arrays of one row of the index."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(np.frombuffer(row["widths"], np.int64), np.frombuffer(row["words"], np.uint64))
        self.prints = np.frombuffer(row["prints"], np.uint16)
        self.counts = expand(row["counts"], np.int64)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Documents that hold each key (less the first hash of the shard, as
        sent); 0 where the fingerprint differs, so a foreign key passes with
        probability 2**-16."""
        if not len(self.counts):
            return np.zeros(len(keys), np.int64)
        at = self.hash.places(keys)
        known = (at >= 0) & (self.prints[at] == fingerprints(keys))
        return np.where(known, self.counts[at], 0)


def probe_index(sent: DataFrame, index: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``block, shard, frequent``: a bit for each key that the block sent."""
    def run(t, shard):
        s = Shard(shard.to_pylist()[0])
        bits = [squeeze_bits(s.probe(expand_sorted(b.as_py())) >= least_documents) for b in t.column("keys")]
        return pa.table({"block": t.column("block"), "shard": t.column("shard"),
                         "frequent": pa.array(bits, pa.binary())})

    return sent.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(
        run, "block long, shard long, frequent binary")


def rewrite(stored: DataFrame, answers: DataFrame, cuts: np.ndarray, id_type: str, with_text: bool,
            least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents of each block without the lines that its answers name."""
    def run(t, found):
        texts = texts_of(t)
        keys, _ = block_keys(texts, least_chars)
        frequent = np.zeros(len(keys), bool)
        blobs = dict(zip(found.column("shard").to_pylist(), found.column("frequent").to_pylist()))
        for s, at in by_shard(keys, cuts):
            frequent[at] = expand_bits(blobs[s], at.stop - at.start)
        gone = set(keys[frequent].tolist())
        n_lines, n_dropped, kept = [], [], []
        for text in texts:
            lines = (text or b"").split(b"\n")
            n = len(lines)
            if gone:
                lines = [x for x, k in zip(lines, key_lines(text))
                         if not (counted(k, least_chars) and _lines[k] in gone)]
            n_lines.append(n)
            n_dropped.append(n - len(lines))
            kept.append(b"\n".join(lines))
        out = {"doc_id": t.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()),
               "n_dropped": pa.array(n_dropped, pa.int64())}
        if with_text:
            out["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
        else:
            out["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
        return pa.table(out)

    last = "kept_text" if with_text else "kept_sha256"
    return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, f"doc_id {id_type}, n_lines long, n_dropped long, {last} string")


def line_index(docs: DataFrame, least_chars: int = LEAST_CHARS) -> tuple[DataFrame, DataFrame, DataFrame, np.ndarray]:
    """``(blocks, keys sent, index, first hash of each shard)`` of ``docs``
    (doc_id, text); blocks and keys are stored."""
    on_workers(docs.sparkSession)
    d = docs.select("doc_id", "text")
    chars = corpus_chars(d)
    stored = store_blocks(d, chars, "line_blocks", block_chars(chars))
    cuts = hash_cuts(shard_count(chars))
    buckets = min(len(cuts), 50_000)
    sent = save_bucketed(send_keys(stored, cuts, least_chars).repartition(buckets, "shard"), "line_keys", "shard", buckets)
    return stored, sent, build_index(sent), cuts


def drop_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS,
               with_text: bool = False) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): ``doc_id, n_lines``
    (before dropping), ``n_dropped, kept_sha256``, or ``kept_text`` in its
    place.  Keys of ``least_chars`` code points or more that
    ``least_documents`` documents hold lose all their lines."""
    stored, sent, index, cuts = line_index(docs, least_chars)
    answers = probe_index(sent, index, least_documents)
    return rewrite(stored, answers, cuts, dict(docs.dtypes)["doc_id"], with_text, least_chars)
