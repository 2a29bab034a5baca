import math
import random
import re
import sys
from collections import Counter, defaultdict
from os.path import dirname

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, dirname(__file__))
import brute  # noqa: E402

from quarry.llm import best_position, hard_negatives, line_dedup, perfect_hash  # noqa: E402

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK = " \t\n\x0b\x0c\r"


def test_perfect_hash_is_minimal():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        place = perfect_hash.PerfectHash(*perfect_hash.build(keys))
        assert sorted(place.places(keys).tolist()) == list(range(len(keys)))
        assert len(place.words) * 64 <= 128 + 5 * max(len(keys), 64)
    assert (place.places(r.integers(0, 2**64, 1000, dtype=np.uint64)) < len(keys)).all()
    with pytest.raises(ValueError, match="distinct"):
        perfect_hash.build(np.zeros(2, np.uint64))


def line_rows(rows):
    """The fixture's rows with lines that 9, 10 and all documents hold, in odd forms."""
    out = []
    for i, r in enumerate(rows):
        t = r[1]
        if t is not None and i % 2:
            t = f"\t {'COMMON Line É'.swapcase() if i % 4 == 1 else 'common line é'.swapcase()} \r\n{t}\n\n \x0b\nx\x85"
        if i < 10:
            t = (t or "") + "\nin ten"
        if i < 9:
            t += "\nin nine\nin nine"
        out.append((r[0], t, *r[2:]))
    return out


def plain_lines(rows, least, chars=1):
    key = lambda x: x.strip(BLANK).translate(LOW)
    count = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if len(k) >= chars)
    out = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least or len(key(x)) < chars]
        out[r[0], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_line_dedup(spark, docs, rows, empty):
    rows = line_rows(rows)
    d = spark.createDataFrame(rows, docs.schema).repartition(3)
    for least, chars in ((10, 1), (9, 1), (2, 4)):
        want = plain_lines(rows, least, chars)
        assert sum(k[2] > 0 for k in want) > 20
        got = line_dedup.drop_lines(d, least, chars, with_text=True).collect()
        assert Counter(map(tuple, got)) == want
    want = plain_lines(rows, 10)
    got = Counter(map(tuple, line_dedup.drop_lines(d).collect()))
    assert got == Counter({(a, b, c, brute.SHA(t.encode())): n for (a, b, c, t), n in want.items()})
    assert line_dedup.drop_lines(empty).count() == 0


def test_line_index_counts_every_line(docs, rows):
    """The arrays hold each line's number of documents; a foreign line has none."""
    _, sent, index, cuts = line_dedup.line_index(docs)
    shards = {r.shard: line_dedup.Shard(r.asDict()) for r in index.collect()}
    count = Counter(k for r in rows for k in set(line_dedup.key_lines((r[1] or "").encode())) if k)
    assert sum(len(s.counts) for s in shards.values()) == len(count)
    for k, n in count.items():
        h = np.array([line_dedup._lines[k]], np.uint64)
        s = int(np.searchsorted(cuts, h[0], side="right")) - 1
        assert shards[s].probe(h - cuts[s])[0] == n
    foreign = np.random.default_rng(2).integers(0, 2**64, 20_000, dtype=np.uint64)
    assert sum((s.probe(foreign) > 0).sum() for s in shards.values()) < 40


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(rows, items, k):
    terms = lambda t: TERM.findall((t or "").translate(LOW))
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    n_docs, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in q if t in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "the and of"), (2, "Changed altered ÜNÏCODE 漢字"), (3, None), (4, ""), (5, "nothing-holds-zzzqqq"), (6, "same line here"),
         (None, "one two"), (7, "a"), (7, "one"), (2, "in")]


def test_best_position(spark, docs, rows, empty, monkeypatch):
    texts = [(i, r[1]) for i, r in enumerate(rows[25:45], 100)]  # whole documents as queries
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS + texts], "item_id long, text string, n string")
    for k, postings in ((50, 2_000_000), (3, 2_000_000), (5, 200)):
        monkeypatch.setattr(best_position, "BLOCK_POSTINGS", postings)
        got = best_position.search(docs, items, k).collect()
        assert Counter(map(tuple, got)) == plain_search(rows, ITEMS + texts, k)
    assert best_position.search(empty, items).count() == 0
    assert best_position.search(docs, items.limit(0)).count() == 0


def test_best_position_in_batches(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(best_position, "BATCH_TERMS", 5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert Counter(map(tuple, best_position.search(docs, items, 4).collect())) == plain_search(rows, ITEMS, 4)


def test_best_position_stops_early_and_keeps_ties():
    """A selective query reads a part of a long list only; equal scores at the
    k-th place are all found."""
    r = np.random.default_rng(4)
    n = 20_000
    tfs = r.integers(1, 50, (n, 2))
    tfs[:, 1] = np.where(np.arange(n) % 500 == 0, 60, 0)
    sizes = (tfs > 0).sum(1)
    terms = np.concatenate([[0, 1][:s] for s in sizes]).astype(np.int64)
    block = best_position.Block(np.arange(n), np.full(n, 100), sizes, terms, tfs[tfs > 0], np.array([5, 9000]), n, 100 * n)
    top = best_position.Best(10)
    asked = np.array([True, True])
    read = block.search(np.array([0, 1]), asked, top)
    assert read < n / 4
    score = sum(np.where(tfs[:, t] > 0, w * (10**9 * tfs[:, t] // (1000 * tfs[:, t] + 2000)), 0) for t, w in ((0, 5), (1, 9000)))
    want = sorted(zip(-score, range(n)))[:10]
    assert list(zip((-top.scores).tolist(), top.ids.tolist())) == want
    same = best_position.Block(np.arange(100)[::-1], np.full(100, 9), np.ones(100, int), np.zeros(100, int), np.ones(100, int),
                               np.array([7]), 100, 900)
    top = best_position.Best(4)
    same.search(np.array([0]), asked[:1], top)
    assert top.ids.tolist() == [0, 1, 2, 3]


VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, score long"


def plain_negatives(rows, positives=5, negatives=3):
    sound = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = tuple(float(np.float32(x)) for x in v)
        if i not in sound or (label, v) < sound[i]:
            sound[i] = (label, v)
    q = {i: ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, (label, v) in sound.items()}
    out = Counter()
    for a in (i for i in q if i % 50 == 0):
        s = sorted((-sum(x * y for x, y in zip(q[a][1], q[b][1])), b) for b in q if b != a and len(q[a][1]) == len(q[b][1]))
        for ps, p in [x for x in s if q[x[1]][0] == q[a][0]][:positives]:
            fit = [x for x in s if q[x[1]][0] != q[a][0] and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:negatives]
            out.update((a, p, rank, n, -ps, -ns) for rank, (ns, n) in enumerate(fit, 1))
    return out


def vector_rows():
    r = random.Random(6)
    vec = lambda n=4: [round(r.gauss(0.4, 0.5), 2) for _ in range(n)]
    rows = [(i, vec(), r.randrange(10) if i % 3 else 4, "k", "w", 0) for i in range(700)]
    rows += [(700 + i, [0.5] * 4, i % 3, "k", "w", 0) for i in range(250)]  # a hot vector
    rows += [(-50, vec(), 1, None, None, None), (-7, vec(), 9, "", "", 0), (None, vec(), 1, "", "", 0), (2000, None, 1, "", "", 0),
             (2050, vec(), None, "", "", 0), (2100, [1.0, None, 0.0, 1.0], 1, "", "", 0), (2150, [float("nan")] * 4, 1, "", "", 0),
             (2200, [float("inf"), 0.0, 0.0, 0.0], 1, "", "", 0), (2250, vec(3), 1, "", "", 0), (2251, vec(3), 1, "", "", 0),
             (2252, vec(3), 2, "", "", 0), (2300, [], 1, "", "", 0), (2301, [], 1, "", "", 0), (2302, [], 2, "", "", 0),
             (2350, [0.0] * 4, 5, "", "", 0), (100, vec(), 4, "", "", 0), rows[50], rows[50], rows[3]]
    return rows


def test_hard_negatives(spark, monkeypatch):
    rows = vector_rows()
    d = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = plain_negatives(rows)
    assert len(want) > 100
    assert Counter(map(tuple, hard_negatives.hard_negatives(d).collect())) == want
    for name, n in (("CHUNK_ROWS", 7), ("GROUP_ANCHORS", 3), ("BLOCK_ROWS", 40)):
        monkeypatch.setattr(hard_negatives, name, n)
    assert Counter(map(tuple, hard_negatives.hard_negatives(d, 3, 2).collect())) == plain_negatives(rows, 3, 2)
    assert hard_negatives.hard_negatives(d.limit(0)).count() == 0


def test_hard_negative_keys():
    r = random.Random(1)
    keys = [(r.randint(-9, 9), r.choice((-2**62, -1, 0, 1, 2**62)), r.randint(0, 1), r.randint(-2**63, 2**63 - 1)) for _ in range(500)]
    packed = sorted(hard_negatives.pack_key(*k) for k in keys)
    assert [hard_negatives.unpack_key(k) for k in packed] == sorted(keys, key=lambda k: (k[0], -k[1], k[2], k[3]))


def test_hard_negative_scores_are_exact():
    x = np.array([[2.0**29, 1.0], [2.0**26, 3.0]])
    y = np.array([[2.0**29 + 1, 1.0], [2.0**24 + 1, -1.0]])
    want = [[int(a[0]) * int(b[0]) + int(a[1]) * int(b[1]) for b in y.tolist()] for a in x.tolist()]
    assert hard_negatives.scores_of(x, y).tolist() == want
    with pytest.raises(OverflowError):
        hard_negatives.scores_of(x * 2.0**10, y)
    wide = np.array([[2**61, -2**61, 5, 5]])
    assert hard_negatives.first_rows(wide, np.ones((1, 4), bool), 3).tolist() == [[0, 2, 3]]
