"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (FTRL) and
elastic-net penalties, then calibrated by a temperature.

Document frequencies cover all training texts.  The classifier is fitted on a
bounded sample: at most ``SAMPLE`` training documents, as many of each
language, by hash; a fifth of them only sets the temperature.  The one task that
fits it gets sparse counts, at most 65,536 a document, never texts.
Prediction reads whole texts and nothing but them.

Features: letters in lower case, anything else as one space; n-grams of one to
three characters hashed to 2**16; log-damped counts times inverse document
frequency, of unit length.

Defined cases: a null text or one without a letter gives ``und`` with score 0,
as do all texts if there is no labelled training document; a null doc_id counts
as not held out; repeated rows count each; equal probabilities: the first
language in order; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import on_workers

BITS = 16
SIZE = 1 << BITS
SAMPLE = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.002
FOLDS, HELD_OUT = 4, 2
PIECE = 500_000  # characters at a time
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None without a letter."""
    if not text:
        return None
    is_letter, total, tail = letters(), None, np.array([32], np.uint32)
    for i in range(0, len(text), PIECE):
        c = np.frombuffer(text[i:i + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(is_letter[c], c, np.uint32(32))
        c = np.concatenate([tail, c])
        c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
        if len(c) <= len(tail):
            continue
        h = c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        one = (h >> np.uint64(64 - BITS)).astype(np.int64)
        two = h[:-1] * np.uint64(0xBF58476D1CE4E5B9) + h[1:]
        three = two[:-1] * np.uint64(0x94D049BB133111EB) + h[2:]
        skip = len(tail)  # n-grams that end in this piece
        grams = [one[skip:], (two[max(0, skip - 1):] >> np.uint64(64 - BITS)).astype(np.int64),
                 (three[max(0, skip - 2):] >> np.uint64(64 - BITS)).astype(np.int64)]
        n = np.bincount(np.concatenate(grams), minlength=SIZE)
        total = n if total is None else total + n
        tail = c[-2:]
    if total is None:
        return None
    return total if len(tail) > 1 or tail[0] != 32 else None


def vector(n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(n)
    return sparse_vector(at, n[at], idf)


def sparse_vector(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the counts above zero and their places."""
    x = (1 + np.log(n)) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def fit(samples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int,
        epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """FTRL-proximal weights (features x classes; the last row is the bias) and
    the temperature, from a fifth of the samples that the weights have not seen."""
    z, n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    def logits(i, w=None):
        at, x = samples[i]
        return x @ w[at] + w[SIZE]

    aside = np.arange(len(samples)) % 5 == 4
    learn = np.flatnonzero(~aside)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(learn):
            at, x = samples[i]
            at, x = np.append(at, SIZE), np.append(x, 1.0)
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = x[:, None] * p[None, :]
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * w
            n[at] = grown
    w = weights(z, n)
    check = np.flatnonzero(aside)
    temperature = 1.0
    if len(check):
        s = np.array([logits(i, w) for i in check])
        best = None
        for t in np.exp(np.linspace(np.log(0.05), np.log(20), 241)):
            u = s / t
            u -= u.max(1, keepdims=True)
            loss = float(np.mean(np.log(np.exp(u).sum(1)) - u[np.arange(len(check)), y[check]]))
            if best is None or loss < best:
                best, temperature = loss, float(t)
    return w, temperature


def held_out(doc_id: str = "doc_id") -> Column:
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The model from ``docs`` (doc_id, text, lang), all of them training data:
    languages, idf, weights, temperature; None if there is none to learn from."""
    on_workers(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null")

    def frequencies(batches):
        """Sums of the task, one row a feature; feature -1: documents."""
        df, n = np.zeros(SIZE, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                c = counts(text)
                if c is not None:
                    df += c > 0
                    n += 1
        at = np.flatnonzero(df)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["feature", "n"])

    found = docs.select("text").mapInArrow(frequencies, "feature long, n long")
    rows = found.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # at most SIZE + 1 rows
    if not len(rows):
        return None
    df = np.zeros(SIZE + 1)
    df[rows.feature.to_numpy()] = rows.n.to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    per_lang = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(per_lang, key=lambda s: s.encode())
    each = max(20, min(1000, sample // len(langs)))
    # hashes below about twice that share of a language, so that the ranking gets few rows of any
    parts = 1_000_000_000
    share = F.create_map(*[F.lit(x) for g in langs for x in (g, min(parts, 2 * each * parts // per_lang[g] + 1))])
    keyed = docs.select("doc_id", "lang", F.xxhash64("doc_id").alias("k")).filter(
        F.pmod("k", F.lit(parts)) < F.try_element_at(share, F.col("lang")))
    chosen = keyed.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k", "doc_id"))).filter(
        F.col("r") <= each).select(F.col("doc_id").alias("id"), F.col("lang").alias("of"), "r")
    picked = docs.join(F.broadcast(chosen), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of")))

    def ngrams(batches):
        """Sparse counts of the picked documents, so that no whole text reaches the one task."""
        for b in batches:
            found = [counts(text) for text in b.column(2).to_pylist()]
            at = [None if c is None else np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(at, pa.list_(pa.int32())),
                 pa.array([None if c is None else c[i] for c, i in zip(found, at)], pa.list_(pa.int64()))],
                ["r", "lang", "at", "n"])

    def learn(t):
        """One task over the bounded sample: at most SIZE counts a document."""
        t = t.sort_by([("r", "ascending"), ("lang", "ascending")])
        pairs = []
        for at, n, lang in zip(t.column("at"), t.column("n"), t.column("lang")):
            pairs.append((sparse_vector(at.values.to_numpy(), n.values.to_numpy(), idf), langs.index(lang.as_py())))
        w, temperature = fit([p[0] for p in pairs], np.array([p[1] for p in pairs], int), len(langs))
        return pa.table({"w": pa.array([w.astype(np.float32).tobytes()], pa.binary()), "t": [temperature]})

    grams = picked.select("r", "lang", "text").mapInArrow(ngrams, "r int, lang string, at array<int>, n array<bigint>")
    model = grams.filter("at is not null").select(F.lit(0).alias("g"), "r", "lang", "at", "n").groupBy("g").applyInArrow(
        learn, "w binary, t double").first()
    if model is None:
        return None
    return {"langs": langs, "idf": idf.astype(np.float32), "temperature": model["t"],
            "w": np.frombuffer(model["w"], np.float32).reshape(SIZE + 1, len(langs))}


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row of ``docs`` (doc_id, text)."""
    on_workers(docs.sparkSession)

    def run(batches):
        for b in batches:
            names, scores = [], []
            for text in b.column(1).to_pylist():
                c = counts(text) if model else None
                if c is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, x = vector(c, model["idf"])
                s = (x @ model["w"][at] + model["w"][SIZE]).astype(float) / model["temperature"]
                p = np.exp(s - s.max())
                k = int(np.argmax(p))
                names.append(model["langs"][k])
                scores.append(float(p[k] / p.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the documents that
    are not held out, predicted for all."""
    model = train(docs.filter(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
