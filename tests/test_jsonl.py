"""JSONL source: physical line numbers, drop rules, key defaults, strict and
tolerant modes (fixture of FIXTURES.md section 3)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import ingest
from quarry.sources import jsonl

RECORDS = [
    {"func_name": "normal_func", "func_code_string": "def normal_func():\n    return 1",
     "func_documentation_string": "Return one.", "language": "python",
     "repository_name": "r", "func_path_in_repository": "p.py", "func_code_url": "u"},
    {"func_code_string": "def x(): pass"},                                   # name missing
    {"func_name": "   ", "func_code_string": "def x(): pass"},               # name blank
    {"func_name": "no_code"},                                                # code missing
    {"func_name": "ws_code", "func_code_string": "   ", "whole_func_string": "def w(): pass"},
    {"func_name": "empty_code", "func_code_string": "", "whole_func_string": "def e(): pass",
     "language": None},                                                      # kept, explicit null
    {"func_name": "nodoc", "func_code_string": "x = 1", "func_documentation_string": None,
     "language": "go"},
    {"func_name": "é", "func_code_string": "(); {} []"},                     # no tokens
]


def _write(lines, name):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return p


@pytest.fixture(scope="module")
def raw(spark):
    lines = [json.dumps(r, ensure_ascii=False) for r in RECORDS]
    lines.insert(3, "")  # a blank line: numbering advances
    path = _write(lines, "test.jsonl")
    return jsonl.read_records(spark, {"test": path}).cache()


def test_line_numbers_count_blank_lines(raw):
    got = [r["line_no"] for r in raw.orderBy("line_no").collect()]
    assert got == [1, 2, 3, 5, 6, 7, 8, 9]
    ids = {r["id"] for r in raw.collect()}
    assert "test-5" in ids and "test-4" not in ids


def test_drop_reasons_and_kept(raw):
    prepared = ingest.prepare(raw)
    reasons = {r["line_no"] if "line_no" in r else None: None for r in []}
    rows = {r["id"]: r["drop_reason"] for r in prepared.collect()}
    assert rows["test-1"] is None
    assert rows["test-2"] == "missing_name" and rows["test-3"] == "missing_name"
    assert rows["test-5"] == "missing_code"
    assert rows["test-6"] == "missing_code"        # whitespace code does not fall back
    assert rows["test-7"] is None                  # empty code falls back
    assert rows["test-8"] is None
    assert rows["test-9"] == "empty_lexical"
    stats = ingest.corpus_stats(prepared).first()
    assert stats["raw_records"] == 8 and stats["kept_records"] == 3
    assert stats["raw_records"] == stats["kept_records"] + stats["dropped_missing_name"] + \
        stats["dropped_missing_code"] + stats["dropped_empty_lexical"]


def test_language_default_only_when_missing(raw):
    meta = {r["id"]: r for r in ingest.metadata(ingest.prepare(raw)).collect()}
    assert meta["test-1"]["language"] == "python"
    assert meta["test-7"]["language"] is None       # explicit null stays null
    assert meta["test-8"]["language"] == "go"
    assert meta["test-7"]["repository_name"] == ""  # missing key -> ''


def test_malformed_line_strict_fails_tolerant_skips(spark):
    path = _write([json.dumps(RECORDS[0]), "{not json", json.dumps(RECORDS[6])], "bad.jsonl")
    with pytest.raises(Exception) as err:
        jsonl.read_records(spark, {"train": path}).collect()
    assert "at line 2" in str(err.value)
    tolerant = jsonl.read_records(spark, {"train": path}, mode="DROPMALFORMED")
    assert sorted(r["line_no"] for r in tolerant.collect()) == [1, 3]


def test_offsets_last_wins(spark):
    path = _write([json.dumps({"id": "a"}), "garbage", "", json.dumps({"id": "a"}),
                   json.dumps({"id": ""}), json.dumps({"id": "b"})], "docs.jsonl")
    got = {r["id"]: r["line_no"] for r in jsonl.read_offsets(spark, path).collect()}
    assert got == {"a": 4, "b": 6}


def test_line_numbers_across_many_blocks(spark):
    lines = [json.dumps({"func_name": f"f{i}", "func_code_string": f"x{i} = {i}"}) if i % 7 else ""
             for i in range(1, 20001)]
    path = _write(lines, "big.jsonl")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        recs = jsonl.read_records(spark, {"train": path})
        bad = recs.filter(F.col("func_name") != F.concat(F.lit("f"), F.col("line_no").cast("string")))
        assert recs.count() == len([x for x in lines if x]) and bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_numbers_per_file_in_a_folder(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, n in (("a.jsonl", 30000), ("b.jsonl", 25000)):
        with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
            for i in range(1, n + 1):
                fh.write(json.dumps({"k": f"{name}:{i}"}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "131072")
    try:
        lines = jsonl.numbered_lines(spark, d)
        bad = lines.filter(F.get_json_object("value", "$.k") != F.concat(
            F.regexp_extract("file", r"([ab]\.jsonl)$", 1), F.lit(":"), F.col("line_no").cast("string")))
        assert lines.count() == 55000 and bad.count() == 0
        assert lines.rdd.getNumPartitions() > 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_nested_corpus_stats(raw):
    prepared = ingest.prepare(raw)
    docs = ingest.documents(prepared)
    nested = ingest.corpus_stats_nested(ingest.corpus_stats(prepared),
                                        ingest.length_histogram(docs)).first()
    test = nested["splits"]["test"]
    assert nested["total_kept_records"] == test["kept_records"] == 3
    assert sum(test["length_histogram"].values()) == 3
    assert list(test["length_histogram"]) == sorted(test["length_histogram"])


def test_export_split_renaming(spark):
    df = spark.createDataFrame([("validation",), ("train",)], "split string")
    assert [r[0] for r in jsonl.export_splits(df).collect()] == ["valid", "train"]


def test_pipeline_from_jsonl_end_to_end(spark):
    from quarry.operators import rerank
    from quarry.operators import evaluate as E
    from quarry.plans.pipeline import Pipeline
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    words = ["parse json file", "open ssh connection", "hash a string with sha256",
             "split list into chunks", "download url to disk", "read csv rows"]
    paths = {}
    for split, n in (("train", 30), ("valid", 6), ("test", 12)):
        p = os.path.join(d, f"{split}.jsonl")
        with open(p, "w", encoding="utf-8") as fh:
            for i in range(n):
                w = words[i % len(words)]
                name = w.replace(" ", "_") + f"_{split}{i}"
                fh.write(json.dumps({"func_name": name,
                                     "func_code_string": f"def {name}():\n    return '{w}'",
                                     "func_documentation_string": f"{w.capitalize()} ({split} {i})."})
                         + "\n")
        paths[split] = p
    pipe = Pipeline.from_jsonl(spark, paths)
    assert pipe.documents.count() == 48
    assert pipe.index.statistics.first()["document_count"] == 48
    q = pipe.queries
    assert q.count() == 12 and q.filter(~F.col("query_id").startswith("test-")).count() == 0
    m = pipe.bm25_metrics.first()
    assert m["query_count"] == 12 and m["recall_at_10"] == 1.0
    qv = rerank.hashed_query_vectors(q)
    dv = rerank.hashed_document_vectors(pipe.index)
    rr = rerank.rerank(pipe.bm25_ranking, qv, dv, 50)
    rm = E.metrics(E.per_query(q.join(qv.select("query_id"), "query_id"), rr)).first()
    assert rm["recall_at_50"] == m["recall_at_50"]


def test_empty_split_gets_zero_stats(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    paths = {}
    for split, recs in (("train", RECORDS[:1]), ("valid", [])):
        p = os.path.join(d, f"{split}.jsonl")
        with open(p, "w", encoding="utf-8") as fh:
            fh.write("".join(json.dumps(r) + "\n" for r in recs))
        paths[split] = p
    raw = jsonl.read_records(spark, paths)
    stats = {r["split"]: r for r in ingest.corpus_stats(ingest.prepare(raw), list(paths)).collect()}
    assert stats["valid"]["raw_records"] == 0 and stats["valid"]["lexical_token_avg"] == 0.0
    assert stats["train"]["kept_records"] == 1


def test_line_numbers_in_gzip_files(spark):
    import gzip
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with gzip.open(os.path.join(d, "part.jsonl.gz"), "wt", encoding="utf-8") as fh:
        for i in range(1, 3001):
            fh.write("\n" if i % 10 == 0 else json.dumps({"k": i}) + "\n")
    lines = jsonl.numbered_lines(spark, d).filter(F.col("value") != "")
    bad = lines.filter(F.get_json_object("value", "$.k").cast("long") != F.col("line_no"))
    assert lines.count() == 2700 and bad.count() == 0


def test_corrupt_line_fails_whatever_is_read(spark):
    good = json.dumps(RECORDS[0])
    for bad in ("{not json", good + " trailing junk", good + good, good + "] }", good + "}", "[1]", "3"):
        path = _write([good, bad, json.dumps(RECORDS[6])], "bad.jsonl")
        prepared = ingest.prepare(jsonl.read_records(spark, {"train": path}))
        for out in (ingest.documents(prepared).select("id"), ingest.corpus_stats(prepared).select("split"),
                    ingest.rejected(prepared), prepared.groupBy().count()):
            with pytest.raises(Exception, match="at line 2"):
                out.collect()
        tolerant = jsonl.read_records(spark, {"train": path}, mode="DROPMALFORMED")
        assert sorted(r["line_no"] for r in tolerant.collect()) == [1, 3]


def test_first_n_in_file_order(spark):
    from quarry.operators import evaluate as E
    from quarry.plans.pipeline import DensePipeline
    lines = [json.dumps({"func_name": f"f{i}", "func_code_string": f"x = {i}",
                         "func_documentation_string": f"Unique word{i} text"}) for i in range(1, 25)]
    pipe = DensePipeline.from_jsonl(spark, {"test": _write(lines, "test.jsonl")}, max_queries=5)
    assert [r.query_id for r in pipe.queries.orderBy("ordinal").collect()] == [f"test-{i}" for i in range(1, 6)]
    got = {r.query_id for r in E.sample_rankings(pipe.queries, pipe.bm25_ranking, n_queries=3).collect()}
    assert got == {"test-1", "test-2", "test-3"}
    from quarry.operators import report
    ex = report.example_queries(pipe.index, pipe.documents, count=4).orderBy("example_rank").collect()
    assert [r.doc_id for r in ex] == [f"test-{i}" for i in range(1, 5)]
    # the rerank needs no stored vectors, and keeps every query
    assert pipe.rerank_metrics.first()["query_count"] == 5
    none = DensePipeline.from_jsonl(spark, {"test": _write(["{}"], "none.jsonl")})
    shown = report.example_queries(none.index, none.documents)
    assert dict(shown.dtypes)["doc_id"] == "string" and shown.count() == 6


def test_line_numbers_run_on_over_a_folder(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, n in (("a.jsonl", 3), ("b.jsonl", 2)):
        with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
            fh.writelines(json.dumps({"func_name": f"{name}{i}"}) + "\n" for i in range(n))
    got = {r["id"]: r["func_name"] for r in jsonl.read_records(spark, {"train": d}).collect()}
    assert got == {"train-1": "a.jsonl0", "train-2": "a.jsonl1", "train-3": "a.jsonl2",
                   "train-4": "b.jsonl0", "train-5": "b.jsonl1"}


# line, and whether it is one JSON object
LINES = [('{"a":1}', True), ("{'a':1}", False), ('{"a":"x\ty"}', False), ('{"a":1},"end"]', False), ('{"a":1} x', False),
         ('{"a":NaN}', False), ('{"a":1,"a":2}', True), ("[1]", False), ('"x"', False), ("{}", True), ("{a:1}", False),
         ('{"a":1}}', False), (' {"a":1} ', True), ('{"a":01}', False), ('{"a":1,}', False), ('{"a":"\x01"}', False),
         ('{"a":"\\q"}', False), ("null", False), ('{"a":\t1}', True), ('{"a":{"b":[1,{"c":"d"}]}}', True)]


def test_strict_json(spark):
    """As Python's parser decides (but for NaN): strict mode fails on each
    invalid line, tolerant mode skips them all."""
    for text, good in LINES:
        try:
            python = isinstance(json.loads(text), dict)
        except ValueError:
            python = False
        assert good == (python and "NaN" not in text)
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LINES)], "i int, value string")
    got = {r["i"]: r["k"] for r in d.select("i", jsonl.is_record().alias("k")).collect()}
    assert [got[i] for i in range(len(LINES))] == [good for _, good in LINES]
    path = _write([t for t, _ in LINES], "mixed.jsonl")
    kept = jsonl.read_records(spark, {"test": path}, "DROPMALFORMED").select("line_no").collect()
    assert sorted(r[0] for r in kept) == [i for i, (_, good) in enumerate(LINES, 1) if good]
    for text in ("{'a':1}", '{"a":"x\ty"}', '{"a":1},"end"]'):
        with pytest.raises(Exception, match="Invalid JSON in .* at line 2"):
            jsonl.read_records(spark, {"test": _write(['{"a":1}', text], "bad.jsonl")}).collect()
