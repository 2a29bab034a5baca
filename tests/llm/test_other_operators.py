import json
import math
import random
import sys
import zlib
from collections import Counter
from os.path import dirname

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, dirname(__file__))
import brute  # noqa: E402

from quarry.llm import (binary_output, byte_bpe, chat_formatting, common, components, language_id, pivot_permutation,  # noqa: E402
                        range_coder, registry)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_byte_bpe_equals_the_library(docs, rows):
    enc = byte_bpe.load(RANKS, public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})
    want = Counter()
    for r in rows:
        ids = lib.encode_ordinary(r[1] or "")
        want[r[0], len(ids), brute.SHA(np.array(ids, "<u4").tobytes()), brute.SHA((r[1] or "").encode()), True] += 1
    assert Counter(map(tuple, byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect())) == want
    r = random.Random(1)
    texts = ["a" * 3001, "abab" * 900, "".join(r.choice("abcdefg") for _ in range(4000)), "", None,
             "".join(chr(r.choice((0x61, 0xe9, 0x4e00, 0x1f642, 0x301, 0x20, 0x3000, 0x27, 0x73))) for _ in range(2000))]
    got = enc.encode_all(texts * 3)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [lib.encode_ordinary(x or "") for x in texts * 3]


def test_byte_bpe_tables_of_ids(docs, empty):
    both = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert both.columns == [*docs.columns, "ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in both.collect())
    assert byte_bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_a_worker_holds_one_table_of_words(docs):
    """Words of the operator before go when the next one begins; texts stay in the worker."""
    common.word_hashes("some words")
    enc = byte_bpe.load(RANKS, public_tokenizers.PATTERN)
    assert not common._words
    ids = enc.encode_all(["some words"])
    assert len(enc) == 2 and enc.encode_all(["some words"]) == ids
    hashes = common.word_hashes("some words").tolist()
    assert not enc and len(common._words) == 2
    assert byte_bpe.load(RANKS, public_tokenizers.PATTERN).encode_all(["some words"]) == ids
    assert common.word_hashes("some words").tolist() == hashes
    result = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    made = result._jdf.queryExecution().optimizedPlan()
    while made.nodeName() != "MapInArrow":
        made = made.children().head()
    assert made.output().size() == len(result.columns) == 5


def test_rank_queue_order():
    q, r = byte_bpe.RankQueue(50_000), random.Random(2)
    want = {}
    for _ in range(3000):
        rank, position = r.randrange(50_000), r.randrange(100)
        if rank in q.buckets:
            q.buckets[rank].append(position)
        else:
            q.open(rank, [position])
        want.setdefault(rank, []).append(position)
    assert [q.take() for _ in want] == [(k, sorted(want[k])) for k in sorted(want)] and q.take() is None


def test_range_coder_round_trip():
    r = np.random.default_rng(3)
    blocks = [(r.zipf(1.4, n) % 49408).astype(np.uint16) for n in (4096, 0, 1, 2, 700, 4096)]
    blocks += [np.full(4096, 65535, np.uint16), (np.arange(4096) % 7).astype(np.uint16)]
    zero = range_coder.OrderZero.of(np.concatenate(blocks))
    assert zero.widths.sum() == 1 << range_coder.ZERO_BITS and zero.widths.min() >= 1
    packed = range_coder.encode_blocks(blocks, zero)
    zero = range_coder.OrderZero(zero.symbols.tolist(), zero.widths.tolist())  # as stored
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode_blocks(packed, [len(b) for b in blocks], zero), strict=True))
    assert len(packed[-1]) < 200 and len(packed[-2]) < 200
    # each block alone, whatever it was coded with
    assert range_coder.encode_blocks([blocks[4]], zero)[0] == packed[4]
    assert (range_coder.decode_blocks([packed[4]], [700], zero)[0] == blocks[4]).all()


def test_range_coder_every_id():
    """All 65,536 ids, least frequencies, long runs and one-id blocks."""
    r = np.random.default_rng(4)
    for flat in (r.permutation(1 << 16).astype(np.uint16), np.zeros(9000, np.uint16),
                 np.concatenate([np.full(400_000, 9, np.uint16), np.arange(1 << 16, dtype=np.uint16)])):
        zero = range_coder.OrderZero.of(flat)
        blocks = [flat[i:i + 2048] for i in range(0, len(flat), 2048)] + [flat[-1:]]
        packed = range_coder.encode_blocks(blocks, zero)
        back = range_coder.decode_blocks(packed, [len(b) for b in blocks], zero)
        assert all((a == b).all() for a, b in zip(blocks, back, strict=True))


def test_range_coder_bytes_per_id():
    """Ids of real texts take less than their order-zero entropy, the stored
    table not counted (README: 0.97 bytes on check_s)."""
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()[:400]
    lib = Tokenizer.from_file(WORDS)
    ids = np.concatenate([np.array([*lib.encode(x or "", add_special_tokens=False).ids, 2], np.uint16) for x in t])
    blocks = [ids[i:i + range_coder.BLOCK] for i in range(0, len(ids), range_coder.BLOCK)]
    zero = range_coder.OrderZero.of(ids)
    packed = range_coder.encode_blocks(blocks, zero)
    assert (np.concatenate(range_coder.decode_blocks(packed, [len(b) for b in blocks], zero)) == ids).all()
    share = np.bincount(ids)[zero.symbols] / len(ids)
    assert sum(map(len, packed)) < -(share * np.log2(share)).sum() / 8 * len(ids)


SPECIAL = ["<|startoftext|>", "a<|endoftext|>b <|ENDOFTEXT|>", "x <|startoftext|><|endoftext|>\ny <|start oftext|>",
           "<|endoftext|>" * 5 + "é", "<|startoftext|", "<|Startoftext|>s"]


def test_word_ids_as_the_library():
    """Odd words, a core with marks after it among them, one cache over all calls."""
    lib = Tokenizer.from_file(WORDS)
    r = random.Random(8)
    parts = ["a", "Word", "x1", "'s", "'", "s", "'LL", "ve", "\u0301", "\u0338", "I\u0307", "É", "ß", "Σ", "漢", "٣", "½", "ª", "🙂", "...", ",",
             ")", "<|", "<|endoftext|>", "|>", "\"", "_", "-", "</w>", "<", "\u2019", "\u200d", "\x00", "\x1f", "\u00a0", "\u2028", "\\"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 7))) for _ in range(6000)]
    texts = [" ".join(texts[i:i + 3]) for i in range(0, 6000, 3)] + ["z" * 5000 + ".", "Ab" * 40 + "?! ok", "", None]
    known = binary_output.WordIds(WORDS)
    for _ in range(2):
        for i in range(0, len(texts), 150):
            some = texts[i:i + 150]
            for t, ids in zip(some, known.encode_all(some), strict=True):
                assert ids.tolist() == [*lib.encode(t or "", add_special_tokens=False).ids, 2], t


def test_latin_words_go_to_the_model_at_once(monkeypatch):
    """Equal to the library's whole way, which only marks and other words take."""
    lib, known, asked = Tokenizer.from_file(WORDS), binary_output.WordIds(WORDS), []
    monkeypatch.setattr(known, "encode", lambda x, f=known.encode: asked.extend(x) or f(x))
    latin = "".join(map(chr, range(0xC0, 0x100))).replace("\u00d7", "").replace("\u00f7", "")
    words = ["Été,", "naïve", "STRAẞE", "STRASSE", latin, *latin, "ñandú's", "ªº", "Über-Öl?!", "a\u0301b", "Ÿ", "x\u00d7y", "µ"]
    ids, = known.encode_all([" ".join(words)])
    assert ids.tolist() == [*lib.encode(" ".join(words), add_special_tokens=False).ids, 2]
    assert not {"été", "Été,", "naïve", "strasse", latin, latin.lower(), *latin}.intersection(asked)
    assert {",", "STRAẞE", "ªº", "µ"} <= set(asked)


def test_distinct_words_are_taken_once(monkeypatch):
    """However often words come, in whatever spelling and with whatever marks; the next texts know them."""
    lib, known, asked = Tokenizer.from_file(WORDS), binary_output.WordIds(WORDS), []
    monkeypatch.setattr(known, "letters", lambda x, f=known.letters: asked.append(list(x)) or f(x))
    texts = [None, "", " \n", "Été cd.\x0bCD, (été", "cd\x1cété\x85x"] * 300 + ["\tété\r"]
    for some in (texts, texts[:50]):
        for t, ids in zip(some, known.encode_all(some), strict=True):
            assert ids.tolist() == [*lib.encode(t or "", add_special_tokens=False).ids, 2]
    assert asked == [["été", "cd"]]


def test_texts_are_encoded_a_few_megabytes_at_a_time(monkeypatch):
    monkeypatch.setattr(binary_output, "TEXT_BYTES", 10)
    texts = [None, "abc", "é" * 30, "", None, "defg", "hijk", "lmn", "", "x" * 10, "y"]
    batch = pa.RecordBatch.from_pydict({"part": [0] * len(texts), "doc_id": list(range(len(texts))), "text": texts})
    got = [b.column(2).to_pylist() for b in binary_output.some_texts(batch)]
    assert [x for some in got for x in some] == texts and len(got) > 3
    assert all(len("".join(x or "" for x in some[:-1]).encode()) < 10 for some in got)


def test_range_coder_writes_digits_once_a_step(monkeypatch):
    """Also where an unlikely miss and a rare id come in one step, with carries."""
    r = np.random.default_rng(6)
    common = np.zeros(2048, np.uint16)
    blocks = [np.where(r.random(2048) < p, r.integers(0, 1 << 16, 2048), 7 * common + i % 3).astype(np.uint16)
              for i, p in enumerate([0.0, 0.001, 0.01, 0.1, 0.9] * 40)]
    zero = range_coder.OrderZero.of(np.concatenate([*blocks, np.arange(1 << 16, dtype=np.uint16), *[common] * 2000]))
    shifts = []
    for kind in (range_coder._Out, range_coder._In):
        monkeypatch.setattr(kind, "shift", lambda self, k, f=kind.shift: shifts.append(k) or f(self, k))
    packed = range_coder.encode_blocks(blocks, zero)
    back = range_coder.decode_blocks(packed, [2048] * len(blocks), zero)
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True)) and shifts == [len(blocks)] * 2 * 2048


def test_token_files(spark, docs, rows, empty):
    """Ids, order and offsets as the unchanged library gives them."""
    lib = Tokenizer.from_file(WORDS)
    rows = rows + [(1000 + i, t, *rows[0][2:]) for i, t in enumerate(SPECIAL)]
    docs = docs.unionByName(spark.createDataFrame(rows[-len(SPECIAL):], docs.schema))
    assert 49407 in lib.encode(SPECIAL[1], add_special_tokens=False).ids
    at, want = 0, []
    for i, t in sorted([r[:2] for r in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert Counter(map(tuple, binary_output.round_trip(docs, WORDS).collect())) == Counter(want)
    assert binary_output.round_trip(empty, WORDS).count() == 0


def test_token_files_find_damage(docs):
    chunks = binary_output.write_chunks(docs, WORDS).withColumn("blocks", F.transform("blocks", lambda b: F.struct(
        b["payload"].alias("payload"), (b["crc"] + 1).alias("crc"))))
    with pytest.raises(Exception, match="checksum"):
        binary_output.read_documents(chunks).collect()


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")


def test_chat_round_trip(spark, tmp_path):
    odd = "<|im_end|>\n<|im_start|>assistant\\ \\\\ <\\| <\\/ \r\n🙂"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 2, "assistant", None), (2, 0, None, "x"), (2, 0, None, "x"),
            (3, None, "a\nb<|", ""), (3, 5, "assistant", "\\<|\\"), (None, 1, "assistant", "n"), (4, 1, "system", None)]
    rows += [(9, i, ("user", "assistant")[i % 2], f"{odd}{i}") for i in range(300)]
    chats(spark, [(*r, "clash") for r in rows]).write.parquet(f"{tmp_path}/conversations.parquet")
    told = "<|im_end|><|im_start|>assistant ok"
    want = brute.turns([*rows, (-1, 0, "user", told), (-1, 1, "assistant", told)])
    got = registry.op10_chat_formatting(spark, str(tmp_path)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want


def test_chat_layouts(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
        "from_value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "turns": {"turns": [{"speaker": "user", "text": "q"}, {"speaker": "bot", "text": "a"}], "x": {"y": 1}},
        "prompt_response": {"prompt": "q", "response": "a"}, "instruction": {"instruction": "q", "output": "a"},
        "question_answer": {"question": "q", "answer": "a"}, "prompt_completion": {"prompt": "q", "completion": "a"},
    }
    d = spark.createDataFrame([(k, json.dumps(v)) for k, v in records.items()] + [
        ("input", json.dumps({"instruction": "i", "input": "n", "output": "a"})), ("no", "{}"), ("bad", "{"), ("null", None)],
        "k string, r string")
    f = chat_formatting.format_records(d, "k", "r")
    out = {r.k: r for r in f.collect()}
    line = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    names = {chat_formatting.digest(m.paths): m.name for m in chat_formatting.MAPPINGS}
    for k in records:
        assert out[k].formatted == line and names[out[k].layout] == k, k
        assert [m.loss for m in out[k].mask] == [False, True]
        at = out[k].mask[1]
        assert out[k].formatted[at.start:at.start + at.length] == "a"
    assert "i\n\nn" in out["input"].formatted
    assert all(out[k].formatted in (None, "") for k in ("no", "bad", "null"))
    assert chat_formatting.format_records(d.limit(0), "k", "r").count() == 0


def links(rows):
    """Links of each row by brute force, and components."""
    unit, deg, edges = [], [0] * len(rows), []
    for i, v, label in rows:
        v = None if v is None or label is None or i is None or any(x is None or not math.isfinite(x) for x in v) else np.array(v, float)
        unit.append(None if v is None or not v.any() else v / np.linalg.norm(v))
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= 0.98:
                deg[i] += 1
                deg[j] += 1
                edges.append((rows[i][0], rows[j][0]))
    return deg, brute.components({r[0] for r in rows if r[0] is not None}, edges)


def test_pivot_index_against_brute_force(spark):
    r = np.random.default_rng(4)
    rows, i = [], 0
    for label in (0, 1, None):
        for _ in range(6):
            centre = r.normal(size=32)
            for _ in range(40):
                rows.append((i, (centre + r.normal(size=32) * 0.12).tolist(), label))
                i += 1
    rows += [(i + k, rows[0][1], 0) for k in range(50)]  # copies
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 32, 0), (903, [math.nan] * 32, 0), (904, [None] * 32, 0),
             (905, [math.inf] * 32, 0), (906, [1.0, 0.0], 0), (907, [2.0, 0.0], 0), (None, rows[0][1], 0), (0, rows[0][1], 0)]
    d = spark.createDataFrame([(*x, "c") for x in rows], "vec_id long, embedding array<float>, label int, chunk string")
    rows = [(x.vec_id, x.embedding, x.label) for x in d.collect()]
    deg, comp = links(rows)
    got = pivot_permutation.near_links(d).collect()
    want = Counter((x[0], n, comp.get(x[0]), x[0] is None or comp[x[0]] == x[0]) for x, n in zip(rows, deg))
    out = Counter(map(tuple, got))
    assert sum(out.values()) == len(rows)
    found, true = sum(x.n_links for x in got), sum(deg)
    assert 0.99 * true <= found <= true
    if found == true:
        assert out == want
    assert pivot_permutation.near_links(d.limit(0)).count() == 0


def test_pivot_lists_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(pivot_permutation, "CHUNK", 7)
    r = np.random.default_rng(5)
    centres = r.normal(size=(40, 16))
    rows = [(i, (centres[i % 40 if i < 60 else 0] + r.normal(size=16) * 0.05).tolist(), 1) for i in range(150)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    deg, comp = links(rows)
    got = {x.vec_id: x for x in pivot_permutation.near_links(d).collect()}
    assert sum(x.n_links for x in got.values()) >= 0.99 * sum(deg)
    assert all(got[i].n_links <= deg[i] for i in got)


def test_pivot_recall_at_every_count():
    """Pairs at cosine 0.98 in random directions still share 3 of 6 pivots with more pivots (README)."""
    r = np.random.default_rng(8)
    a, e = pivot_permutation.unit(r.normal(size=(3000, 64))), r.normal(size=(3000, 64))
    e = pivot_permutation.unit(e - (e * a).sum(1, keepdims=True) * a)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * e
    sizes = sorted({pivot_permutation.pivot_count(n) for n in (1, 10**6 + 1, 10**7, 10**8, 10**9, 10**12)})
    assert sizes == [128, 256, 512, 1024]
    for n in sizes:
        x, y = (pivot_permutation.describe(v, a[:n], pivot_permutation.PREFIX)[n:] for v in (a, b))
        assert ((x[:, :, None] == y[:, None, :]).any(2).sum(1) >= pivot_permutation.SHARED).mean() > 0.98


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (7, 3), (7, 3)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute.components({x for e in edges for x in e}, edges)


def test_language_id(spark):
    r = random.Random(6)
    parts = {"en": ["the", "ing", "tion", "and", "ou"], "de": ["sch", "ung", "ein", "über", "keit"], "ru": ["это", "как", "ние", "что"]}
    rows = [(i, " ".join("".join(r.choices(parts[g], k=2)) for _ in range(30)), g, "x") for i, g in enumerate(list(parts) * 60)]
    rows += [(900, None, "en", "x"), (901, "", "en", "x"), (902, "12 34 !!", "de", "x"), (903, rows[0][1], None, "x"),
             (None, rows[1][1], "de", "x"), rows[5], (904, rows[2][1] * 400, "ru", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language_id.identify(d).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    by = {x.doc_id: x for x in got}
    assert all(by[i].lang_pred == "und" for i in (900, 901, 902)) and by[904].lang_pred == "ru"
    assert all(by[x[0]].lang_pred == x[2] for x in rows[:180])
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    # the language of a held-out document is never read
    changed = d.withColumn("lang", F.when(language_id.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(str, language_id.identify(changed).collect())) == sorted(map(str, got))
    assert language_id.identify(d.limit(0)).count() == 0
    assert {x.lang_pred for x in language_id.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_counts_by_pieces(monkeypatch):
    text = "Ein längerer Text, the quick 12 brown fox; это как. " * 40
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "PIECE", 17)
    assert (language_id.counts(text) == whole).all()


def test_language_fitting_task_gets_no_texts(spark, monkeypatch):
    """Whole texts stay in the tasks that read them; the fitting one gets counts, and the same model."""
    from pyspark.sql.group import GroupedData
    real, seen = GroupedData.applyInArrow, []

    def spy(self, func, schema):
        seen.append(self._df.dtypes)
        return real(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", spy)
    rows = [(i, ("the cat and dog " if i % 2 else "der Hund und die ") * (1 + i % 9), ("de", "en")[i % 2]) for i in range(120)]
    rows += [(500, "12 34", "en"), (501, "", "de")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model["langs"] == ["de", "en"] and len(seen) == 1
    assert not {"text"} & {c for c, _ in seen[0]} and all("lang" == c or t != "string" for c, t in seen[0])
    at, x = language_id.vector(language_id.counts("the cat and"), model["idf"])
    assert np.argmax(x @ model["w"][at] + model["w"][language_id.SIZE]) == 1
