"""Language-model scoring by deleted interpolation.

A token's probability is a mixture of the bigram and unigram maximum-likelihood
estimates and the uniform one; the weights depend on the bucket (power of two)
of the context's frequency and are learned by expectation-maximisation on
held-out counts: each training token is scored with itself deleted from the
counts (c-1), so all training tokens serve as held-out data.

Documents are stored in blocks.  Each block asks for its distinct unigrams and
bigrams, range by range of their hashes, and gets back their counts in the
whole training part; nothing of the vocabulary is collected or broadcast.  The
driver gets two totals and the histogram for the weights, whose cells (bucket
and logarithmic ratios of the estimates) are bounded in number whatever the
corpus.

Defined cases: a null or empty text has one token, its end; a null doc_id
counts as the id of crc32 zero (training); repeated rows are scored, and learned
from, each for itself; without training tokens all estimates are uniform; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.blocks import (by_shard, corpus_chars, expand, expand_sorted, hash_cuts, in_order, squeeze,
                               squeeze_sorted, store_blocks)
from quarry.llm.common import HashCache, mix64, on_workers, text_bytes
from quarry.session import materialize

END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))  # words hold no space
START = np.uint64(xxhash.xxh3_64_intdigest(b" start"))
FOLDS, HELD_OUT = 5, 1
SHARD_GRAMS = 4_000_000
STEPS = 8  # histogram cells to a factor of two
BUCKETS = 48
ROUNDS = 30

_words = HashCache()


def fold(doc_id) -> int:
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


class Grams:
    """Tokens of a block: their distinct unigrams and bigrams, ascending, and
    the place of each token among them."""

    def __init__(self, t: pa.Table):
        self.doc_ids = t.column("doc_id").to_pylist()
        self.held = np.array([fold(i) == HELD_OUT for i in self.doc_ids], bool)
        tokens, n = [np.empty(0, np.uint64)], []
        for text in t.column("text").to_pylist():
            w = text_bytes(text).lower().split()
            n.append(len(w) + 1)
            tokens.append(np.fromiter(map(_words.__getitem__, w), np.uint64, len(w)))
            tokens.append(np.array([END], np.uint64))
        tok = np.concatenate(tokens)
        self.n = np.array(n, np.int64)
        self.first = np.cumsum(self.n) - self.n
        before = np.empty_like(tok)
        before[1:] = tok[:-1]
        before[self.first] = START
        pair = mix64(mix64(before) * np.uint64(0x9E3779B97F4A7C15) + tok)
        self.train = ~np.repeat(self.held, self.n)
        # contexts are asked for with the unigrams; START has the count of documents
        self.uni, at = np.unique(np.append(tok, START), return_inverse=True)
        self.token = at[:-1]
        self.before = np.empty_like(self.token)
        self.before[1:] = self.token[:-1]
        self.before[self.first] = at[-1]
        self.two, self.pair = np.unique(pair, return_inverse=True)

    def asked(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(order, hashes, counts in the training documents of this block)"""
        c1 = np.bincount(self.token[self.train], minlength=len(self.uni))
        c1[self.uni == START] = int((~self.held).sum())
        c2 = np.bincount(self.pair[self.train], minlength=len(self.two))
        return [(1, self.uni, c1), (2, self.two, c2)]

    def answers(self, found: pa.Table, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts in the whole training part, of unigrams and of bigrams."""
        blobs = dict(zip(zip(found.column("order").to_pylist(), found.column("part").to_pylist()),
                         found.column("count").to_pylist()))
        out = []
        for order, hashes in ((1, self.uni), (2, self.two)):
            c = np.zeros(len(hashes), np.int64)
            for s, at in by_shard(hashes, cuts):
                c[at] = expand(blobs[order, s], np.int64)
            out.append(c)
        return out[0], out[1]


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two of its count."""
    return np.minimum(np.where(context > 0, np.frexp(context.astype(float))[1], 0), BUCKETS - 1)


def estimates(c2, context, c1, total, types):
    """The three estimates of each token."""
    two = np.divide(c2, context, out=np.zeros(len(c2)), where=context > 0)
    return two, c1 / max(total, 1), np.full(len(c2), 1.0 / (types + 1))


def learn_weights(hist: list[tuple[int, int, int, int]], rounds: int = ROUNDS) -> np.ndarray:
    """Expectation-maximisation over the histogram ``(bucket, a, b, n)``: a and
    b are the logarithms of the bigram's and unigram's estimates over the
    uniform one (None as MISSING: zero).  One row of weights a bucket."""
    w = np.tile([0.6, 0.3, 0.1], (BUCKETS, 1))
    w[0] = [0.0, 0.9, 0.1]
    for k in range(BUCKETS):
        rows = np.array([x[1:] for x in hist if x[0] == k], np.int64).reshape(-1, 3)
        if not len(rows):
            if k:
                w[k] = w[k - 1] if k > 1 else w[k]
            continue
        ratio = np.ones((len(rows), 3))
        for col in (0, 1):
            ratio[:, col] = np.where(rows[:, col] == NONE, 0.0, 2.0 ** (rows[:, col] / STEPS))
        for _ in range(rounds):
            share = ratio * w[k]
            share /= share.sum(1, keepdims=True)
            w[k] = (share * rows[:, 2:]).sum(0) / rows[:, 2].sum()
            w[k] = np.maximum(w[k], [0.0, 0.0, 1e-6])
            w[k] /= w[k].sum()
    return w


NONE = -(2**31)  # in the histogram: an estimate of zero


def score(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``, the last two log10 probabilities."""
    spark = docs.sparkSession
    on_workers(spark)
    d = docs.select("doc_id", "text")
    chars = corpus_chars(d)
    stored = store_blocks(d, chars, "lm_blocks")
    shards = max(16, -(-(chars // 6) // SHARD_GRAMS))
    cuts = hash_cuts(shards)

    def ask(key, t):
        g = Grams(in_order(t))
        out = {"order": [], "part": [], "block": [], "grams": [], "count": []}
        for order, hashes, counts in g.asked():
            for s, at in by_shard(hashes, cuts):
                out["order"].append(order)
                out["part"].append(s)
                out["block"].append(key[0].as_py())
                out["grams"].append(squeeze_sorted(hashes[at] - cuts[s]))
                out["count"].append(squeeze(counts[at]))
        return pa.table(out, schema=pa.schema([("order", pa.int64()), ("part", pa.int64()), ("block", pa.int64()),
                                               ("grams", pa.binary()), ("count", pa.binary())]))

    def add_up(key, t):
        grams = [expand_sorted(b.as_py()) for b in t.column("grams")]
        u, at = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([expand(b.as_py(), np.int64) for b in t.column("count")]),
                            minlength=len(u)).astype(np.int64)
        ends = np.cumsum([len(g) for g in grams])[:-1]
        tokens, types = int(total.sum()), int((total > 0).sum())
        if key[0].as_py() == 2:
            tokens = types = 0
        else:
            at_start = u == START - cuts[key[1].as_py()] if START >= cuts[key[1].as_py()] else np.zeros(len(u), bool)
            if at_start.any():
                tokens -= int(total[at_start].sum())
                types -= int((total[at_start] > 0).sum())
        k = t.num_rows
        first = np.arange(k) == 0
        return pa.table({"order": t.column("order"), "part": t.column("part"), "block": t.column("block"),
                         "count": pa.array([squeeze(total[x]) for x in np.split(at, ends)], pa.binary()),
                         "tokens": pa.array(np.where(first, tokens, 0)), "types": pa.array(np.where(first, types, 0))})

    asked = stored.groupBy("block").applyInArrow(
        ask, "order long, part long, block long, grams binary, count binary")
    answers = materialize(asked.groupBy("order", "part").applyInArrow(
        add_up, "order long, part long, block long, count binary, tokens long, types long"), "lm_counts")
    sums = answers.agg(F.sum("tokens"), F.sum("types")).first()
    total, types = (int(x or 0) for x in sums)
    both = stored.groupBy("block").cogroup(
        answers.select("order", "part", "block", "count").groupBy("block"))

    def histogram(t, found):
        """Training tokens by bucket and estimates with the token itself deleted."""
        g = Grams(in_order(t))
        c1, c2 = g.answers(found, cuts)
        m = g.train
        context = c1[g.before[m]] - 1
        two, one, flat = estimates(c2[g.pair[m]] - 1, context, c1[g.token[m]] - 1, total - 1, types)
        cell = np.full((3, len(two)), NONE, np.int64)
        cell[0] = bucket(context)
        for i, p in ((1, two), (2, one)):
            some = p > 0
            cell[i, some] = np.rint(STEPS * np.log2(p[some] / flat[some])).astype(np.int64)
        u, n = np.unique(cell, axis=1, return_counts=True) if len(two) else (cell, np.empty(0, np.int64))
        return pa.table({"bucket": u[0], "two": u[1], "one": u[2], "n": n})

    hist = both.applyInArrow(histogram, "bucket long, two long, one long, n long")
    weights = learn_weights([tuple(r) for r in hist.groupBy("bucket", "two", "one").agg(
        F.sum("n").alias("n")).collect()])

    def apply(t, found):
        t = in_order(t)
        g = Grams(t)
        c1, c2 = g.answers(found, cuts)
        context, c = c1[g.before], c1[g.token]
        two, one, flat = estimates(c2[g.pair], context, c, total, types)
        w = weights[bucket(context)]
        p = np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] * flat)
        base = np.log10((c + 0.5) / (total + 0.5 * (types + 1)))
        add = lambda x: np.add.reduceat(x, g.first) if len(g.first) else x
        return pa.table({
            "doc_id": t.column("doc_id"), "held_out": pa.array(g.held), "n_tokens": g.n,
            "n_known": add((c > 0).astype(np.int64)), "train_tokens": np.full(len(g.n), total),
            "base_score": add(base), "score": add(p)})

    return both.applyInArrow(
        apply, f"doc_id {dict(stored.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")
