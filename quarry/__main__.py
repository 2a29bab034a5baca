"""Command line for the pipeline stages (runs under ``spark-submit`` or plain
``python -m quarry``; the session comes from the environment).

    python -m quarry corpus   --raw-dir RAW --output-dir PROCESSED [--splits train valid test]
    python -m quarry index    --processed-dir PROCESSED --output-dir INDEX [--splits ...] [--buckets N]
    python -m quarry evaluate --processed-dir PROCESSED --index-dir INDEX --output OUT [--top-k 10]
                              [--max-queries N] [--query-split test]
    python -m quarry rerank   --processed-dir PROCESSED --index-dir INDEX --output OUT
                              [--vectors PARQUET] [--top-k 10] [--bm25-candidates 50] [--query-split test]
    python -m quarry search   --index-dir INDEX --queries QUERIES.jsonl --output OUT [--top-k 10]
    python -m quarry sanity   --processed-dir PROCESSED [--samples 3] [--seed 13] [--splits ...]
    python -m quarry embed    --processed-dir PROCESSED --index-dir INDEX --output-dir VECTORS
                              [--query-splits test]
    (rerank also takes --query-vectors VECTORS/queries: stored query vectors,
     encoded on the fly only for queries without one)

``RAW`` holds ``{split}.jsonl``; every output is a folder of parquet / JSON
files.  Without ``--vectors`` the rerank uses the built-in hashed encoder on
both sides; a vector table has ``(doc_id, embedding)``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluate as E
from quarry.operators import ingest, rerank, search
from quarry.operators.index import build_index
from quarry.session import bucket_count
from quarry.sources import jsonl, sinks

SPLITS = ("train", "valid", "test")
META_SCHEMA = ("id string, split string, language string, repository_name string, "
               "func_path_in_repository string, func_name string, func_code_url string")
PROCESSED_SCHEMA = ("id string, split string, func_name string, docstring string, code string, "
                    "document_text string, lexical_document string, lexical_token_count long, "
                    "has_docstring boolean, ordinal long")


def _processed(spark, path, splits):
    df = spark.read.schema(PROCESSED_SCHEMA).json(f"{path}/documents")
    return df.filter(F.col("split").isin(list(splits)))


def cmd_corpus(spark, a):
    raw = jsonl.read_records(spark, {s: f"{a.raw_dir}/{s}.jsonl" for s in a.splits})
    corpus = ingest.build_corpus(raw, a.splits)
    sinks.write_processed(corpus.documents, corpus.metadata, a.output_dir)
    sinks.write_stats(ingest.corpus_stats_nested(corpus.stats, corpus.histogram),
                      f"{a.output_dir}/corpus_stats")


def cmd_index(spark, a):
    docs = _processed(spark, a.processed_dir, a.splits)
    n = a.buckets or bucket_count(spark, docs.agg(F.sum("lexical_token_count")).first()[0] or 0)
    sinks.write_index(build_index(docs, n).materialized(), a.output_dir)  # the postings are built once


def _evaluation(spark, a):
    idx = sinks.read_index(spark, a.index_dir)
    docs = _processed(spark, a.processed_dir, [a.query_split])
    queries = E.build_queries(docs, a.query_split, a.max_queries)
    return idx, queries, E.evaluation_depth(a.top_k)


def cmd_evaluate(spark, a):
    idx, queries, depth = _evaluation(spark, a)
    ranking = search.bm25_topk(idx, queries, depth)
    metrics = E.metrics(E.per_query(queries, ranking))
    samples = E.sample_rankings_nested(E.sample_rankings(queries, ranking))
    setup = {"query_split": a.query_split, "retrieval_depth": depth}
    sinks.write_result(sinks.evaluation_result(setup, idx.statistics, metrics, samples), a.output)


def cmd_embed(spark, a):
    """Document vectors of every indexed document, query vectors per query
    split, and a one-row summary (the built-in hashed encoder)."""
    idx = sinks.read_index(spark, a.index_dir)
    dv = _by_hash(rerank.hashed_document_vectors(idx)).join(
        idx.documents.select("doc_id", "split"), "doc_id")
    sinks.write_vectors(dv, f"{a.output_dir}/documents", partition_by="split")
    docs = _processed(spark, a.processed_dir, a.query_splits)
    for split in a.query_splits:
        q = E.build_queries(docs, split)
        qv = q.join(_by_hash(rerank.hashed_query_vectors(q)), "query_id").withColumn("split", F.lit(split))
        qv.withColumn("embedding", F.col("embedding").cast("array<float>")) \
            .write.mode("overwrite").parquet(f"{a.output_dir}/queries/split={split}")
    stored = spark.read.parquet(f"{a.output_dir}/documents")
    summary = stored.groupBy("split").agg(F.count(F.lit(1)).alias("documents"),
                                          F.max(F.size("embedding")).alias("embedding_dimension"))
    summary.coalesce(1).write.mode("overwrite").json(f"{a.output_dir}/summary")


def _by_hash(vectors):
    return vectors.withColumn("encoder", F.lit(rerank.HASHED))


def _named_vectors(spark, path, key, where=None):
    v = spark.read.parquet(path)
    if "encoder" not in v.columns:
        raise SystemExit(f"{path} does not name the encoder of its vectors")
    return (v if where is None else v.filter(where)).select(
        key, F.col("embedding").cast("array<double>").alias("embedding"), "encoder")


def cmd_rerank(spark, a):
    idx, queries, depth = _evaluation(spark, a)
    cands = search.bm25_topk(idx, queries, max(a.bm25_candidates, depth))
    # every vector table names its encoder; rerank fails where the two sides differ
    dv = _named_vectors(spark, a.vectors, "doc_id") if a.vectors \
        else _by_hash(rerank.hashed_document_vectors(idx, cands.select("doc_id").distinct()))
    qv = _by_hash(rerank.hashed_query_vectors(queries))
    encoder = rerank.HASHED
    if a.query_vectors:
        stored = _named_vectors(spark, a.query_vectors, "query_id", F.col("split") == a.query_split)
        qv = stored.unionByName(qv.join(stored, "query_id", "left_anti"))
        encoder = f"stored query vectors ({a.query_vectors}), hashed tokens for misses"
    ranking = rerank.rerank(cands, qv, dv, depth)
    metrics = E.metrics(E.per_query(queries, ranking))
    samples = E.sample_rankings_nested(E.sample_rankings(queries, ranking, extra_cols=("bm25_score",)),
                                       ("bm25_score",))
    setup = {"query_split": a.query_split, "retrieval_depth": depth,
             "bm25_candidate_count": max(a.bm25_candidates, depth), "reranker": encoder}
    sinks.write_result(sinks.evaluation_result(setup, idx.statistics, metrics, samples), a.output)


def cmd_sanity(spark, a):
    from quarry.operators import quality
    docs = _processed(spark, a.processed_dir, a.splits)
    meta = spark.read.schema(META_SCHEMA).json(f"{a.processed_dir}/metadata")
    stats = sinks.read_split_stats(spark, f"{a.processed_dir}/corpus_stats")
    samples = quality.sanity_check(docs, meta, stats, a.splits, a.samples, a.seed)
    stats.orderBy("split").show(truncate=False)
    samples.orderBy("split", "sample_rank").show(truncate=False, vertical=True)
    print("Sanity checks passed.")


def cmd_search(spark, a):
    idx = sinks.read_index(spark, a.index_dir)
    qs = spark.read.schema("query_id string, query_text string").json(a.queries)
    search.search(idx, qs, a.top_k).drop("score_fp").write.mode("overwrite").parquet(a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarry")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("corpus")
    c.add_argument("--raw-dir", required=True)
    c.add_argument("--output-dir", required=True)
    c.add_argument("--splits", nargs="+", default=list(SPLITS))
    i = sub.add_parser("index")
    i.add_argument("--processed-dir", required=True)
    i.add_argument("--output-dir", required=True)
    i.add_argument("--splits", nargs="+", default=list(SPLITS))
    i.add_argument("--buckets", type=int, default=None)
    for name in ("evaluate", "rerank"):
        e = sub.add_parser(name)
        e.add_argument("--processed-dir", required=True)
        e.add_argument("--index-dir", required=True)
        e.add_argument("--output", required=True)
        e.add_argument("--top-k", type=int, default=10)
        e.add_argument("--max-queries", type=int, default=None)
        e.add_argument("--query-split", default="test")
        if name == "rerank":
            e.add_argument("--vectors", default=None)
            e.add_argument("--query-vectors", default=None)
            e.add_argument("--bm25-candidates", type=int, default=50)
    m = sub.add_parser("embed")
    m.add_argument("--processed-dir", required=True)
    m.add_argument("--index-dir", required=True)
    m.add_argument("--output-dir", required=True)
    m.add_argument("--query-splits", nargs="+", default=["test"])
    q = sub.add_parser("sanity")
    q.add_argument("--processed-dir", required=True)
    q.add_argument("--splits", nargs="+", default=list(SPLITS))
    q.add_argument("--samples", type=int, default=3)
    q.add_argument("--seed", type=int, default=13)
    s = sub.add_parser("search")
    s.add_argument("--index-dir", required=True)
    s.add_argument("--queries", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--top-k", type=int, default=10)
    return p


COMMANDS = {"corpus": cmd_corpus, "index": cmd_index, "evaluate": cmd_evaluate,
            "rerank": cmd_rerank, "search": cmd_search, "sanity": cmd_sanity,
            "embed": cmd_embed}


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"quarry-{args.cmd}").getOrCreate()
    COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
