import re
import sys
from collections import Counter
from os.path import dirname

import numpy as np
import public_tokenizers
import tiktoken

sys.path.insert(0, dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from quarry.llm import byte_bpe, quality_rules  # noqa: E402
from quarry.session import materialize  # noqa: E402


def test_quality_stage_keeps_clean_short_texts(spark):
    texts = {1: "Please call our office before Friday noon at 555 0199 123", 2: "Ship crates to harbour dock 12 before noon 14 May",
             3: "### *** $$$ %%% &&& <<< >>> ||| ### *** $$$ %%%", 4: "zq xv kj wp qq zz vv kk jj ww xx yy", 5: "short text", 6: None}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.quality_stage(spark, d, "").collect()} == {1, 2}


def brute_kept(text):
    """The rules of the corpus, plainly."""
    n, chars, symbols, dup, _, failed = brute.base_quality(text)
    if failed:
        return False
    w, lines = brute.words(text), [x for x in text.split("\n") if brute.words(x)]
    share = lambda f: sum(map(bool, map(f, w))) / n
    stop = share(lambda x: x.strip(".,;:!?\"'()[]").lower() in quality_rules.STOP_WORDS)
    upper = sum("A" <= c <= "Z" for c in text) / max(chars, 1)
    ellipsis = sum(bool(re.search("(\\.\\.\\.|…)[\x20\x09-\x0d]*$", x)) for x in lines)
    bullets = sum(x.lstrip(" \t\n\v\f\r")[:1] in "-*•" for x in lines)
    return (3 <= chars / n <= 10 and symbols / n <= 0.1 and share(lambda x: any(c.isalpha() for c in x)) >= 0.6
            and upper <= 0.3 and stop >= 0.05 and dup / len(lines) <= 0.3 and ellipsis / len(lines) <= 0.3
            and bullets / len(lines) <= 0.9)


def plain(df):
    return sorted(map(str, df.collect()))


def words_by_source(rows):
    n = Counter()
    for r in rows:
        n[r.source] += len(brute.words(r.text))
    return n


def test_chained_stages(spark, docs, rows, tmp_path):
    """Each stage against its plain version on what the one before kept, and ``run`` against the chain."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "MinHash near-dedup", "substring dedup", "source mixing", "byte-level BPE"]
    step = lambda name, d: materialize(stages[name](spark, d, str(tmp_path)), "test")

    good = step("quality rules", docs)
    assert good.columns == docs.columns
    want = Counter(r for r in map(tuple, rows) if brute_kept(r[1]))
    assert Counter(map(tuple, good.collect())) == want and 0 < sum(want.values()) < len(rows)

    apart = step("MinHash near-dedup", good)
    texts = {r[0]: brute.words(r[1]) for r in want if r[0] is not None}
    ids = sorted(texts)
    comp = brute.components(ids, [(a, b) for a in ids for b in ids if a < b and brute.near_copies(texts[a], texts[b])])
    want = Counter({r: n for r, n in want.items() if r[0] is None or comp[r[0]] == r[0]})
    assert Counter(map(tuple, apart.collect())) == want and len(set(comp.values())) < len(comp)

    cut = step("substring dedup", apart)
    assert cut.columns == docs.columns
    once = cut.collect()
    flat = list(want.elements())
    hashes = Counter((i, sha if gone else None) for i, n, gone, sha in brute.substring([r[:2] for r in flat])
                     if not gone or gone < n)
    original = {(r[0], r[1]): r for r in flat}
    got = Counter((r.doc_id, None if (r.doc_id, r.text) in original else brute.SHA(r.text.encode())) for r in once)
    assert got == hashes and any(sha for _, sha in got)
    for r in once:
        same = original.get((r.doc_id, r.text))
        assert tuple(r) == same if same else r.n_chars == len(r.text)

    mixed = step("source mixing", cut)
    assert mixed.columns == docs.columns
    sizes, taken = words_by_source(once), words_by_source(mixed.collect())
    target = brute.targets(sizes)
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in once}

    out = stages["byte-level BPE"](spark, mixed, str(tmp_path)).collect()
    enc = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})
    want = Counter()
    for r in mixed.collect():
        tokens = lib.encode_ordinary(r.text)
        want[r.doc_id, len(tokens), brute.SHA(np.array(tokens, "<u4").tobytes()), brute.SHA(r.text.encode()), True] += 1
    assert Counter(map(tuple, out)) == want
    assert plain(corpus_pipeline.run(spark, str(tmp_path))) == sorted(map(str, out))


def test_null_and_empty_tables(spark, empty, tmp_path):
    nulls = spark.createDataFrame([(None,) * 8, (1, None, None, None, None, None, None, None), (2, "", "", "", 0, 0, "", "")], empty.schema)
    for k, d in enumerate((empty, nulls)):
        d.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{k}").count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name
        n = stage(spark, nulls, "").count()
        assert n == {"quality rules": 0, "source mixing": 0}.get(name, 3), name


def test_scratch_of_a_stage_is_deleted(docs):
    """A stage deletes what the one before wrote, unless its documents read it."""
    import corpus_pipeline
    from quarry.session import materialize, scratch_written
    spark = docs.sparkSession
    stored = materialize(corpus_pipeline.near_dedup_stage(spark, docs, ""), "stored")
    own = list(corpus_pipeline._left)
    assert own and all(p in scratch_written() for p in own)
    lazy = corpus_pipeline.substring_stage(spark, stored, "")
    assert not any(p in scratch_written() for p in own)
    assert corpus_pipeline.mixing_stage(spark, lazy, "").count() > 0  # not stored: its tables stay
