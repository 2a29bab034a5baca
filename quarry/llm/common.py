"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and a word
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (a cluster gets the package by ``--py-files`` as usual)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, known) if x)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra ones can't clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` cuts at the same six
    characters as ``SPACE``."""
    return text_bytes(text).split()


_held: list[dict] = []  # the table that this worker uses


def hold(table: dict) -> None:
    """Empties the table of words that this worker used before, if it is another
    one: Spark hands its workers from one operator to the next, and their memory
    should hold the tables of one."""
    if not _held or _held[0] is not table:
        for other in _held:
            other.clear()
        _held[:] = [table]
        pa.default_memory_pool().release_unused()


class HashCache(dict):
    """64-bit hashes of words; emptied when it holds ``most`` entries, so its
    memory is bounded whatever the vocabulary."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = HashCache()


def word_hashes(text: str | None) -> np.ndarray:
    hold(_words)
    w = split_words(text)
    return np.fromiter(map(_words.__getitem__, w), np.uint64, len(w))


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` consecutive word hashes: a
    polynomial over scrambled values, built by doubling the run length."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = pow(0x9E3779B97F4A7C15, 2 * seed - 1, 1 << 64) | 1
    part = mix64(h + np.uint64((seed * 0xD1342543DE82EF95) & (2**64 - 1)))
    done, total, length, power = 0, None, 1, base
    while True:
        if width & length:  # the parts of the binary form of ``width``
            piece = part[done:done + n]
            total = piece if total is None else total * np.uint64(power) + piece
            done += length
        if done == width:
            return mix64(total)
        part = part[:-length] * np.uint64(power) + part[length:]
        power = power * power & (2**64 - 1)
        length *= 2
