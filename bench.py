"""Benchmark: the end-to-end pipeline at one scale factor (cold operators:
each phase runs once in a fresh JVM, after one trivial job).

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line with the seconds of each
phase: corpus build (clean + tokenize, materialised), index build (postings
bucketed by doc_id, vocabulary, statistics), BM25 query phase over the
test-split queries (top-50), BM25 evaluation, dense rerank + evaluation with
stored vectors, hashed-encoder document vectors, and the report queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.operators import ingest, quality, report, rerank, search  # noqa: E402
from quarry.plans.pipeline import DensePipeline  # noqa: E402
from quarry.session import checkpoint_root, local_session  # noqa: E402
from quarry.sources import tables  # noqa: E402


def consume(df) -> int:
    """Evaluate every column of ``df`` (a plain count would let the optimizer
    prune unused columns) and return the row count."""
    from pyspark.sql import functions as F
    r = df.select(F.xxhash64(*df.columns).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.max("h").alias("s")).first()
    return int(r["n"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # one shuffle partition per core: at sf0.1 each partition stays small
    parts = int(os.environ.get("BENCH_PARTITIONS", str(max(int(cpus), 1))))
    spark = local_session(cpus, parts, driver_memory=os.environ.get("BENCH_MEMORY", "16g"))
    if not checkpoint_root(spark):
        d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)

    # Runtime start-up is not pipeline work: like the session creation, the
    # first (trivial) job's JVM warm-up stays out of the phase timings.  It
    # runs none of the library's code, so no operator is warmed up by it.
    spark.range(1).count()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    p = DensePipeline(spark, sf_dir, materialize=True)
    timed("corpus_build", lambda: p.prepared)
    stats_rows = timed("corpus_stats", lambda: p.corpus_stats.collect())
    rows["corpus_stats"] = len(stats_rows)
    idx = timed("index_build", lambda: p.index)
    rows["postings"] = idx.postings.count()
    qs = timed("queries", lambda: p.queries)
    n_queries = qs.count()
    rows["queries"] = n_queries
    ranking = timed("bm25_query_phase", lambda: p.bm25_ranking)
    rows["bm25_ranked_rows"] = ranking.count()
    m = timed("bm25_evaluation", lambda: p.bm25_metrics.collect())
    rr = timed("rerank_query_phase", lambda: p.rerank_ranking)
    rows["rerank_rows"] = rr.count()
    m2 = timed("rerank_evaluation", lambda: p.rerank_metrics.collect())
    rows["hashed_doc_vectors"] = timed(
        "hashed_doc_vectors", lambda: consume(rerank.hashed_document_vectors(idx)))
    bq = tables.benchmark_queries(spark, sf_dir)
    rows["adhoc_search"] = timed(
        "adhoc_search", lambda: consume(search.search(idx, bq, 10)))
    rows["result_cards"] = timed("result_cards", lambda: consume(report.result_cards(
        p.bm25_ranking.filter("rank <= 10").drop("score_fp"),
        documents=p.documents, metadata=p.metadata)))
    rows["examples"] = timed("examples", lambda: consume(report.example_queries(idx, p.documents)))
    rows["quality"] = timed("data_quality", lambda: len(
        quality.id_report(p.documents, p.metadata).collect()))

    # steady state (not in the total): the query phase again on the warm index
    t = time.perf_counter()
    consume(search.bm25_topk(idx, qs, p.depth))
    warm_query = round(time.perf_counter() - t, 3)

    total = round(sum(times.values()), 3)
    qps = round(n_queries / times["bm25_query_phase"], 2) if times["bm25_query_phase"] else None
    out = {
        "metric": "pipeline_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "master": f"local[{cpus}]",
        "shuffle_partitions": parts,
        "driver_memory": os.environ.get("BENCH_MEMORY", "16g"),
        "bm25_queries_per_sec": qps,
        "warm": {"bm25_query_phase": warm_query,
                 "bm25_queries_per_sec": round(n_queries / warm_query, 2) if warm_query else None},
        "rows": rows,
        "corpus": {r["split"]: {k: r[k] for k in ("kept_records", "document_char_avg",
                                                  "lexical_token_avg", "missing_docstring_rate")}
                   for r in stats_rows},
        "index": {k: v for k, v in idx.statistics.first().asDict().items()},
        "bm25_metrics": m[0].asDict() if m else None,
        "rerank_metrics": m2[0].asDict() if m2 else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
