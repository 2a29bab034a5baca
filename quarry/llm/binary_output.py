"""Token-id files: ids of documents in ascending doc_id order, as blocks of an
adaptive context-mixing range coder (``range_coder``), each independently
reset and checksummed.

File format: Parquet rows ("chunks") in the order of ``part, chunk``.  A chunk
holds whole documents: ``doc_ids`` and ``sizes`` (ids of each, end id
included), the order-zero table of its ids (``symbols`` and their ``widths``)
and the ids as ``blocks`` of 2,048 (``payload`` and ``crc``, the crc32 of the
block's ids as little-endian unsigned 32-bit integers; the last block of a chunk
may be shorter).  Any block can be decoded with its chunk's table alone.

The documents are range-partitioned by id, so each task writes one run of the
order; a chunk closes at ``CHUNK_IDS`` ids, which bounds memory.  Offsets in
the whole output are prefix sums over one number per part.

Defined cases: a null text is encoded like an empty one (only the end id); a
null doc_id comes first, rows of one doc_id are ordered by text; an empty table
writes no chunk and reads back empty; a block whose checksum differs fails the
read; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.blocks import corpus_chars
from quarry.llm.common import on_workers
from quarry.llm.range_coder import BLOCK, OrderZero, decode_blocks, encode_blocks
from quarry.session import scratch_path

END_ID = 2
CHUNK_IDS = 8192 * BLOCK
PART_CHARS = 24_000_000
TEXT_BYTES = 12_000_000  # of text that is encoded at a time

CHUNK_TYPE = pa.schema([
    ("part", pa.int64()), ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("symbols", pa.list_(pa.int32())), ("widths", pa.list_(pa.int32())),
    ("blocks", pa.list_(pa.struct([("payload", pa.binary()), ("crc", pa.int64())])))])
CHUNK_SCHEMA = ("part long, chunk long, doc_ids array<bigint>, sizes array<bigint>, "
                "symbols array<int>, widths array<int>, blocks array<struct<payload:binary,crc:bigint>>")


def runs(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of ``n`` values from ``start`` on in ``flat``, one after the other."""
    end = np.cumsum(n)
    return flat[np.repeat(start - (end - n), n) + np.arange(n.sum())]


def _numpy(a: pa.Array) -> np.ndarray:
    return a.to_numpy(zero_copy_only=False)


class WordIds:
    """Ids of texts, by the tokenizers library.  White space is dropped by this
    vocabulary and nothing in it looks across it, so a text's ids are those of its
    words in a row.  As in the library, the string of a special token is that
    token, also inside a word.

    The words of some texts are cut and numbered in Arrow, and each distinct one is
    taken once, as a core and the ASCII marks after it: the vocabulary always cuts
    between a letter or an ASCII digit and such a mark, and lower-cases.  A core of
    Latin letters is one piece of the vocabulary, so these go to the library's
    model at once, many in one string, spelled in its letters for bytes; all other
    pieces take the library's whole way and are kept, in bounded memory."""

    MOST = 1_000_000
    LONGEST = 64
    MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    LETTERS = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+\z"  # each is in normal form, also in lower case
    ALNUM = np.array([c < 128 and chr(c).isalnum() for c in range(256)])

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each core a task
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.last = np.zeros(1 << 16, bool)  # ids that end a word: nothing in a core of letters is spelled so
        self.last[[i for x, i in self.tokenizer.get_vocab().items() if x.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.pieces: dict[str, bytes] = {}
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spell(c)[0][0] for c in map(chr, range(ord("ß"), ord("ÿ") + 1))}

    def encode(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint16).tobytes()
                for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def letters(self, cores: list[str]) -> list[bytes]:
        """Ids of cores of lower-case Latin letters."""
        rows = [" ".join(cores[i:i + 100]) for i in range(0, len(cores), 100)]
        for i, row in enumerate(rows):
            if not row.isascii():
                for c, spelled in self.spelling.items():
                    row = row.replace(c, spelled)
                rows[i] = row
        found = self.model.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint16) for e in found])
        end = ((np.flatnonzero(self.last[ids]) + 1) * 2).tolist()
        ids = ids.tobytes()
        return [ids[i:j] for i, j in zip([0] + end, end)]

    def look_up(self, pieces: list[str], encode) -> list[bytes]:
        """Ids of pieces, of which ``encode`` gives those that are not known, a few
        thousand at a time; the short ones are kept."""
        if len(self.pieces) > self.MOST:
            self.pieces.clear()
        found = list(map(self.pieces.get, pieces))
        new = [i for i, x in enumerate(found) if x is None]
        for i in range(0, len(new), 5000):
            at = new[i:i + 5000]
            for j, ids in zip(at, encode([pieces[j] for j in at]), strict=True):
                found[j] = ids
                if len(pieces[j]) <= self.LONGEST:
                    self.pieces[pieces[j]] = ids
        return found

    def of_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words (a dictionary) in a row, and how many each has."""
        core = pc.utf8_rtrim(words, characters=self.MARKS)
        end = np.frombuffer(words.buffers()[1], np.int32)[1:len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8)
        kept = pc.binary_length(core).to_numpy()
        marks = np.diff(end, prepend=0) - kept
        letters = _numpy(pc.match_substring_regex(core, self.LETTERS))
        ends_alnum = kept > 0
        ends_alnum[ends_alnum] = self.ALNUM[data[(end - marks - 1)[ends_alnum]]]
        whole = ~letters & (~ends_alnum | _numpy(pc.match_substring(words, "<|")))
        marks[whole] = 0
        lower = ~whole & (letters | _numpy(pc.string_is_ascii(core)))
        core = pc.if_else(pa.array(lower), pc.utf8_lower(core), pc.if_else(pa.array(whole), words, core)).dictionary_encode()
        marked = np.flatnonzero(marks)
        n = marks[marked]
        tails = pa.StringArray.from_buffers(len(marked), pa.py_buffer(np.append(0, np.cumsum(n)).astype(np.int32)),
                                            pa.py_buffer(runs(data, end[marked] - n, n))).dictionary_encode()

        of_letters = np.zeros(len(core.dictionary), bool)
        of_letters[core.indices.to_numpy()] = letters
        place = np.empty(len(of_letters), np.int64)  # of a core among the pieces: letters, other cores, marks, nothing
        place[np.argsort(~of_letters, kind="stable")] = np.arange(len(place))
        names = _numpy(core.dictionary)
        found = self.look_up(names[of_letters].tolist(), self.letters)
        found += self.look_up(names[~of_letters].tolist() + tails.dictionary.to_pylist(), self.encode)
        ids = np.frombuffer(b"".join(found), np.uint16)
        size = np.append(np.fromiter(map(len, found), np.int64, len(found)) // 2, 0)
        pieces = np.full((len(words), 2), len(size) - 1)
        pieces[:, 0] = place[core.indices.to_numpy()]
        pieces[marked, 1] = len(place) + tails.indices.to_numpy()
        n = size[pieces]
        return runs(ids, (np.cumsum(size) - size)[pieces.ravel()], n.ravel()), n.sum(axis=1)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, each with the end id, and how many each has."""
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, "") if texts.null_count else texts)  # the six characters of ``SPACE``
        words = cut.flatten().dictionary_encode()
        ids, size = self.of_words(words.dictionary)
        ids, size = np.append(ids, np.uint16(END_ID)), np.append(size, 1)
        n = pc.list_value_length(cut).to_numpy() + 1
        end = np.cumsum(n, dtype=np.int64)
        is_word = np.ones(len(words) + len(texts), bool)
        is_word[end - 1] = False
        word = np.full(len(is_word), len(size) - 1)
        word[is_word] = words.indices.to_numpy()
        each = size[word]
        return runs(ids, (np.cumsum(size) - size)[word], each), np.add.reduceat(each, end - n)

    def encode_all(self, texts: list) -> list[np.ndarray]:
        """Ids of each text with the end id."""
        ids, size = self.encode_texts(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(size)[:-1])


def some_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch (part, doc_id, text), ``TEXT_BYTES`` of text at a time, one at least."""
    size = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().astype(np.int64)
    at = np.flatnonzero(np.diff((np.cumsum(size) - size) // TEXT_BYTES, prepend=-1)).tolist()
    for begin, end in zip(at, at[1:] + [batch.num_rows]):
        yield batch.slice(begin, end - begin)


_loaded: dict[str, WordIds] = {}


def load(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_chunks(docs: DataFrame, path: str) -> DataFrame:
    """Chunks of the token-id files of ``docs`` (doc_id, text)."""
    on_workers(docs.sparkSession)
    # the coder takes all blocks of a chunk at once: few large parts cost it less than many small ones
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-corpus_chars(docs) // PART_CHARS))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        parts, "doc_id").sortWithinPartitions("doc_id", "text").select(
        F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")

    def run(batches):
        known = load(path)
        part, chunk, ids, sizes, doc_ids, count = None, 0, [], [], [], 0

        def close():
            flat = np.concatenate(ids)
            blocks = [flat[i:i + BLOCK] for i in range(0, len(flat), BLOCK)]
            zero = OrderZero.of(flat)
            packed = [{"payload": p, "crc": crc_of(b)} for p, b in zip(encode_blocks(blocks, zero), blocks)]
            return pa.RecordBatch.from_pylist([{
                "part": part, "chunk": chunk, "doc_ids": doc_ids, "sizes": np.concatenate(sizes),
                "symbols": zero.symbols.tolist(), "widths": zero.widths.tolist(), "blocks": packed}],
                schema=CHUNK_TYPE)

        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(0)[0].as_py()
            for piece in some_texts(b):
                found, size = known.encode_texts(piece.column(2))
                ids.append(found)
                sizes.append(size)
                doc_ids += piece.column(1).to_pylist()
                count += len(found)
                if count >= CHUNK_IDS:
                    yield close()
                    chunk, ids, sizes, doc_ids, count = chunk + 1, [], [], [], 0
        if ids:
            yield close()

    return ordered.mapInArrow(run, CHUNK_SCHEMA)


def read_documents(chunks: DataFrame) -> DataFrame:
    """Documents of token-id files: ``part, chunk, at`` (ids before it in its
    chunk), ``doc_id, n_tokens, ids_crc32``."""
    on_workers(chunks.sparkSession)

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(i)[r].as_py() for i, c in enumerate(b.schema.names)}
                sizes = np.array(row["sizes"], np.int64)
                total = int(sizes.sum())
                n = [min(BLOCK, total - i) for i in range(0, total, BLOCK)]
                blocks = decode_blocks([x["payload"] for x in row["blocks"]], n, OrderZero(row["symbols"], row["widths"]))
                for x, ids in zip(row["blocks"], blocks, strict=True):
                    if crc_of(ids) != x["crc"]:
                        raise ValueError(f"checksum of a block differs: part {row['part']}, chunk {row['chunk']}")
                ids = np.concatenate(blocks)
                last = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), row["part"])), pa.array(np.full(len(sizes), row["chunk"])),
                     pa.array(last - sizes), pa.array(row["doc_ids"], pa.int64()), pa.array(sizes),
                     pa.array([crc_of(ids[e - s:e]) for s, e in zip(sizes, last)], pa.int64())],
                    ["part", "chunk", "at", "doc_id", "n_tokens", "ids_crc32"])

    return chunks.select("part", "chunk", "doc_ids", "sizes", "symbols", "widths", "blocks").mapInArrow(
        run, "part long, chunk long, at long, doc_id long, n_tokens long, ids_crc32 long")


def write_files(docs: DataFrame, tokenizer: str, out: str) -> None:
    """Writes the token-id files of ``docs`` to the folder ``out``."""
    write_chunks(docs, tokenizer).write.parquet(out)


def read_files(spark, out: str) -> DataFrame:
    """``doc_id, start`` (ids of all documents before it), ``n_tokens,
    ids_crc32``, from the files in ``out`` alone."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(out)
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = chunks.select("part", "chunk", total.alias("n"))
    in_part = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = sums.groupBy("part").agg(F.sum("n").alias("n")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_at"))
    places = sums.withColumn("chunk_at", F.coalesce(F.sum("n").over(in_part), F.lit(0))).join(
        parts, F.col("part") == F.col("p")).select(
        F.col("part").alias("p"), F.col("chunk").alias("c"), (F.col("part_at") + F.col("chunk_at")).alias("first"))
    d = read_documents(chunks)
    return d.join(places, (d.part == F.col("p")) & (d.chunk == F.col("c"))).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Files written to the shared folder and read back."""
    out = scratch_path(docs.sparkSession, "token_files")
    write_files(docs, tokenizer, out)
    return read_files(docs.sparkSession, out)
