"""Substring dedup: removes each word covered by a window of consecutive words
whose sequence also starts earlier in the corpus (smaller doc_id, or same
document and earlier start).

Method: count-min prefilter.  Pass one makes a count-min sketch of the window
hashes of each block (sparse: ascending cells), and the sketches are merged
cell range by cell range.  A cell of the merged sketch overestimates, so a
window whose smallest cell count is one occurs once for sure.  Pass two sends
only windows estimated repeated, by a 128-bit hash, to be grouped exactly;
pass three removes the words.  No window that repeats is lost.

Defined cases: a null or empty text has no words and gives n_words 0 and the
digest of the empty text; texts shorter than a window keep all words; rows with
the same doc_id count as one after the other (by text), a null doc_id comes
before all others; an empty table gives an empty result; extra columns are
ignored by ``remove_repeats`` and kept by ``dedup_texts``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.blocks import (by_shard, corpus_chars, expand, expand_bits, expand_sorted, hash_cuts,
                               ids_of, in_order, squeeze, squeeze_bits, squeeze_sorted, store_blocks)
from quarry.llm.common import on_workers, split_words, window_hashes, word_hashes
from quarry.session import materialize

WINDOW = 20
DEPTH = 2
SHARD_WINDOWS = 4_000_000  # windows of a shard of the sketch, on average
MISSING = -(2**63)


class Windows:
    """All windows of a block, in the common order of its documents."""

    def __init__(self, t: pa.Table, width: int):
        self.texts = t.column("text").to_pylist()
        self.ids = ids_of(t)
        one, two, n = [], [], []
        for x in self.texts:
            h = word_hashes(x)
            one.append(window_hashes(h, width, 1))
            two.append(window_hashes(h, width, 2))
            n.append(len(one[-1]))
        self.n = np.array(n, np.int64)
        self.h1 = np.concatenate([np.empty(0, np.uint64), *one])
        self.h2 = np.concatenate([np.empty(0, np.uint64), *two])

    def cells(self, row: int, bits: int) -> np.ndarray:
        """The cell of each window in one row of the sketch."""
        h = self.h1 if row == 0 else self.h2 * np.uint64(2 * row + 1)
        return h >> np.uint64(64 - bits)

    def later_in_block(self) -> np.ndarray:
        """Marks windows that the block itself holds earlier."""
        later = np.zeros(len(self.h1), bool)
        order = np.lexsort((np.arange(len(self.h1)), self.h2, self.h1))
        a, b = self.h1[order], self.h2[order]
        later[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        return later


def _cell_counts(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells, ascending, and which of them the block fills twice."""
    s = np.sort(cells)
    new = np.append(True, s[1:] != s[:-1]) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return s[at], np.diff(np.append(at, len(s))) > 1


def remove_repeats(docs: DataFrame, width: int = WINDOW, depth: int = DEPTH,
                   with_text: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of each row, and with
    ``with_text`` the other columns of ``docs``, its text replaced by the kept
    words joined by one space if any was removed."""
    spark = docs.sparkSession
    on_workers(spark)
    extra = [c for c in docs.columns if c not in ("doc_id", "text")] if with_text else []
    d = docs.select(F.col("doc_id"), F.col("text"), *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(extra)])
    chars = corpus_chars(d)
    stored = store_blocks(d, chars, "substring_blocks")
    narrow = stored.select("block", "doc_id", "text")
    bits = max(16, (chars // 2).bit_length())
    shards = max(16, -(-(chars // 6) // SHARD_WINDOWS))
    shift = np.uint64(64 - bits)
    cuts = np.unique(hash_cuts(shards) >> shift)

    def sketch(key, t):
        w = Windows(in_order(t), width)
        out = {"part": [], "block": [], "cells": [], "twice": [], "n": []}
        for row in range(depth):
            cells, twice = _cell_counts(w.cells(row, bits))
            for s, at in by_shard(cells, cuts):
                out["part"].append(row * len(cuts) + s)
                out["block"].append(key[0].as_py())
                out["cells"].append(squeeze_sorted(cells[at] - cuts[s]))
                out["twice"].append(squeeze_bits(twice[at]))
                out["n"].append(len(cells[at]))
        return pa.table(out, schema=pa.schema([("part", pa.int64()), ("block", pa.int64()), ("cells", pa.binary()),
                                               ("twice", pa.binary()), ("n", pa.int64())]))

    def merge(t):
        """Adds up one range of the sketches; tells each block which of its
        cells count two or more."""
        cells = [expand_sorted(b.as_py()) for b in t.column("cells")]
        n = t.column("n").to_pylist()
        u, at = np.unique(np.concatenate(cells), return_inverse=True)
        count = np.bincount(at, minlength=len(u))
        count += np.bincount(at[np.concatenate([
            expand_bits(b.as_py(), k) for b, k in zip(t.column("twice"), n)])], minlength=len(u))
        full, at = count >= 2, np.split(at, np.cumsum(n)[:-1])
        return pa.table({"part": t.column("part"), "block": t.column("block"),
                         "full": pa.array([squeeze_bits(full[x]) for x in at], pa.binary())})

    sketches = narrow.groupBy("block").applyInArrow(
        sketch, "part long, block long, cells binary, twice binary, n long")
    merged = sketches.groupBy("part").applyInArrow(merge, "part long, block long, full binary")

    def repeated(key, t, found):
        """Windows estimated repeated, each once a block, for exact grouping."""
        w = Windows(in_order(t), width)
        bitmaps = dict(zip(found.column("part").to_pylist(), found.column("full").to_pylist()))
        maybe = np.ones(len(w.h1), bool)
        for row in range(depth):
            mine = w.cells(row, bits)
            cells, _ = _cell_counts(mine)
            full = np.zeros(len(cells), bool)
            for s, at in by_shard(cells, cuts):
                full[at] = expand_bits(bitmaps[row * len(cuts) + s], len(cells[at]))
            maybe &= full[np.searchsorted(cells, mine)]
        at = np.flatnonzero(maybe & ~w.later_in_block())
        first = np.cumsum(w.n) - w.n
        of = np.repeat(np.arange(len(w.n)), w.n)[at]
        order = np.argsort(w.h1[at], kind="stable")
        h1 = w.h1[at][order]
        out = {"part": [], "block": [], "h1": [], "h2": [], "doc": [], "start": [], "pos": []}
        for s, run in by_shard(h1, hash_cuts(shards)):
            x = np.sort(order[run])  # back in the order of the texts, which packs well
            out["part"].append(s)
            out["block"].append(key[0].as_py())
            out["h1"].append(w.h1[at[x]].tobytes())
            out["h2"].append(w.h2[at[x]].tobytes())
            out["doc"].append(squeeze(np.diff(w.ids[of[x]], prepend=0)))
            out["start"].append(squeeze(np.diff(at[x] - first[of[x]], prepend=0)))
            out["pos"].append(squeeze_sorted(at[x].astype(np.uint64)))
        return pa.table(out, schema=pa.schema([("part", pa.int64()), ("block", pa.int64())] + [
            (c, pa.binary()) for c in ("h1", "h2", "doc", "start", "pos")]))

    def group(t):
        """Groups windows exactly; tells each block those that start earlier elsewhere."""
        col = lambda c, f: [f(b.as_py()) for b in t.column(c)]
        h1 = col("h1", lambda b: np.frombuffer(b, np.uint64))
        n = [len(x) for x in h1]
        h1 = np.concatenate(h1)
        h2 = np.concatenate(col("h2", lambda b: np.frombuffer(b, np.uint64)))
        doc = np.concatenate(col("doc", lambda b: np.cumsum(expand(b, np.int64))))
        start = np.concatenate(col("start", lambda b: np.cumsum(expand(b, np.int64))))
        order = np.lexsort((start, doc, h2, h1))
        a, b = h1[order], h2[order]
        later = np.zeros(len(h1), bool)
        later[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        gone = [squeeze_sorted(p[x]) for p, x in zip(col("pos", expand_sorted), np.split(later, np.cumsum(n)[:-1]))]
        return pa.table({"block": t.column("block"), "gone": pa.array(gone, pa.binary())})

    asked = narrow.groupBy("block").cogroup(merged.groupBy("block")).applyInArrow(
        repeated, "part long, block long, h1 binary, h2 binary, doc binary, start binary, pos binary")
    gone = materialize(asked.groupBy("part").applyInArrow(group, "block long, gone binary"), "substring_gone")

    def cut(t, found):
        t = in_order(t)
        w = Windows(t, width)
        marked = w.later_in_block()
        for b in found.column("gone"):
            marked[expand_sorted(b.as_py()).astype(np.int64)] = True
        last = np.cumsum(w.n)
        sizes, removed, digests, texts = [], [], [], []
        for i, text in enumerate(w.texts):
            words = split_words(text)
            m = marked[last[i] - w.n[i]:last[i]]
            if m.any():
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.flatnonzero(m)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + width, -1)
                keep = np.cumsum(edge[:-1]) == 0
                kept = b" ".join([words[k] for k in np.flatnonzero(keep)])
                removed.append(len(words) - int(keep.sum()))
                texts.append(kept.decode("utf-8", "surrogatepass") if with_text else None)
            else:
                kept = b" ".join(words)
                removed.append(0)
                texts.append(text)
            sizes.append(len(words))
            digests.append(hashlib.sha256(kept).hexdigest())
        out = {"doc_id": t.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
               "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            out["text"] = pa.array(texts, pa.string())
            out |= {f"x{i}": t.column(f"x{i}") for i in range(len(extra))}
        return pa.table(out)

    kind = dict(stored.dtypes)
    schema = f"doc_id {kind['doc_id']}, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        schema += ", text string" + "".join(f", x{i} {kind[f'x{i}']}" for i in range(len(extra)))
    left = stored if with_text else narrow
    return left.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(cut, schema)


def dedup_texts(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts; a document of
    which no word is left goes.  ``n_chars``, if there, follows the text."""
    columns = docs.columns
    extra = [c for c in columns if c not in ("doc_id", "text")]
    r = remove_repeats(docs, width, with_text=True).filter(
        (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    names = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {
        c: F.col(f"x{i}") for i, c in enumerate(extra)}
    if "n_chars" in names:
        names["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(names["n_chars"])
    return r.select(*[names[c].alias(c) for c in columns])
