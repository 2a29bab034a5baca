"""The command line runs the stages end to end on a small JSONL corpus."""

import json
import os
import tempfile

from quarry.__main__ import main


def test_cli_stages(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raw = os.path.join(d, "raw")
    os.makedirs(raw)
    texts = ["parse json file", "open ssh connection", "hash a string", "split list into chunks"]
    for split, n in (("train", 12), ("valid", 4), ("test", 8)):
        with open(os.path.join(raw, f"{split}.jsonl"), "w", encoding="utf-8") as fh:
            for i in range(n):
                t = texts[i % len(texts)]
                fh.write(json.dumps({"func_name": f"{t.replace(' ', '_')}_{split}{i}",
                                     "func_code_string": f"def f{i}():\n    return '{t}'",
                                     "func_documentation_string": f"{t} {split} {i}"}) + "\n")
    processed, index = os.path.join(d, "processed"), os.path.join(d, "index")
    main(["corpus", "--raw-dir", raw, "--output-dir", processed], spark)
    main(["sanity", "--processed-dir", processed], spark)
    main(["index", "--processed-dir", processed, "--output-dir", index], spark)
    main(["evaluate", "--processed-dir", processed, "--index-dir", index,
          "--output", os.path.join(d, "bm25")], spark)
    main(["rerank", "--processed-dir", processed, "--index-dir", index,
          "--output", os.path.join(d, "rerank")], spark)
    vectors = os.path.join(d, "vectors")
    main(["embed", "--processed-dir", processed, "--index-dir", index, "--output-dir", vectors], spark)
    main(["rerank", "--processed-dir", processed, "--index-dir", index, "--output",
          os.path.join(d, "rerank_stored"), "--vectors", os.path.join(vectors, "documents"),
          "--query-vectors", os.path.join(vectors, "queries")], spark)
    summary = {r["split"]: r["documents"] for r in
               spark.read.json(os.path.join(vectors, "summary")).collect()}
    assert summary == {"train": 12, "valid": 4, "test": 8}
    stored = spark.read.json(os.path.join(d, "rerank_stored")).first()
    bm25 = spark.read.json(os.path.join(d, "bm25")).first()
    rr = spark.read.json(os.path.join(d, "rerank")).first()
    assert bm25["metrics"]["query_count"] == 8 and bm25["metrics"]["recall_at_10"] == 1.0
    assert rr["metrics"]["recall_at_50"] == bm25["metrics"]["recall_at_50"]
    # stored hashed vectors give the same rerank as encoding on the fly
    assert stored["metrics"].asDict() == rr["metrics"].asDict()
    qfile = os.path.join(d, "q.jsonl")
    with open(qfile, "w") as fh:
        fh.write(json.dumps({"query_id": "a", "query_text": "ssh connection"}) + "\n")
    main(["search", "--index-dir", index, "--queries", qfile, "--output", os.path.join(d, "hits"),
          "--top-k", "3"], spark)
    hits = spark.read.parquet(os.path.join(d, "hits")).orderBy("rank").collect()
    assert len(hits) == 3 and hits[0]["doc_id"].startswith(("train-", "valid-", "test-"))
    stats = spark.read.json(os.path.join(processed, "corpus_stats")).first()
    assert stats["total_kept_records"] == 24
