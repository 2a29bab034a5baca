"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each one reads the driver tables (whole tables, whole texts) and returns a
DataFrame whose column names equal those of the matching SQL in
``quarry.plans.oracle``.  Doubles are rounded to 6 decimals through the
fixed-point grid; array results are exploded to scalars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numeric import from_fixed, round6
from quarry.operators import evaluate as E
from quarry.operators import ingest, quality, report, rerank, search
from quarry.operators.blockmax import KEEP_BUCKETS
from quarry.operators.index import build_index
from quarry.operators.term_store import write_term_store
from quarry.plans.pipeline import DensePipeline, Pipeline, long_rank
from quarry.session import release_scratch, scratch_path, scratch_written, settings
from quarry.sources import jsonl, sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOP_K = 10


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _docs_table(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "documents")


def _explode_vector(df: DataFrame, key: str, col: str = "embedding") -> DataFrame:
    return df.select(key, F.posexplode(col).alias("dim", "value")).select(
        key, F.col("dim").cast("long").alias("dim"), round6("value").alias("value"))


# -- text functions (whole texts of the documents table) ----------------------

@register
def q_normalize_ws(spark, sf_dir):
    """whitespace normalisation of every document's whole text."""
    return _docs_table(spark, sf_dir).select(
        "doc_id", T.normalize_whitespace("text").alias("normalized"))


@register
def q_split_identifier(spark, sf_dir):
    """identifier splitting of every document's whole text."""
    d = _docs_table(spark, sf_dir).select("doc_id", T.split_identifier("text").alias("p"))
    return d.select("doc_id", F.size("p").cast("long").alias("piece_count"),
                    F.array_join("p", " ").alias("pieces"))


@register
def q_tokenize(spark, sf_dir):
    """lexical tokens of every document's whole text, one row per position."""
    d = _docs_table(spark, sf_dir).select("doc_id", T.tokenize("text").alias("t"))
    return d.select("doc_id", F.posexplode("t").alias("pos", "token")).select(
        "doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "token")


@register
def q_document_text(spark, sf_dir):
    """document text of every raw record (name, docstring, code)."""
    p = Pipeline(spark, sf_dir).prepared
    return p.select("id", T.document_text("func_name", "docstring", "code").alias("document_text"))


@register
def q_preview(spark, sf_dir):
    """whitespace-flattened 160-character preview of every text."""
    return _docs_table(spark, sf_dir).select("doc_id", T.preview("text").alias("text_preview"))


# -- corpus build ---------------------------------------------------------------

@register
def q_documents(spark, sf_dir):
    """Processed documents (kept records)."""
    return Pipeline(spark, sf_dir).documents


@register
def q_metadata(spark, sf_dir):
    """Metadata rows with the missing-key defaults."""
    return Pipeline(spark, sf_dir).metadata


def _flawed_records(spark, sf_dir):
    """All records of ``documents`` and a record per row of ``labels``: of low
    quality without a name, toxic ones without code, others with odd ids
    without a token."""
    raw = tables.raw_records(spark, sf_dir)
    lab = tables.read_table(spark, sf_dir, "labels")
    even = F.col("doc_id") % 2 == 0
    code = F.when(F.col("toxic") == 1, F.lit(" \n")).when(even, F.lit("x = 1")).otherwise(F.lit("();\u00e9"))
    flawed = lab.select(
        F.col("doc_id").alias("id"), tables.split_of("doc_id").alias("split"), F.col("doc_id").alias("ordinal"),
        F.when(F.col("quality") == 1, F.lit("\u00e9\u00e8")).otherwise(F.lit("  ")).alias("func_name"),
        code.alias("func_code_string"))
    return raw.unionByName(flawed, allowMissingColumns=True)


@register
def q_rejected_records(spark, sf_dir):
    """P5: every dropped record with its single reason."""
    return ingest.rejected(Pipeline(spark, sf_dir, raw=_flawed_records(spark, sf_dir)).prepared)


@register
def q_drop_reasons(spark, sf_dir):
    """P5: dropped records per split and reason."""
    return ingest.drop_reason_counts(Pipeline(spark, sf_dir, raw=_flawed_records(spark, sf_dir)).prepared)


@register
def q_corpus_stats(spark, sf_dir):
    """Per-split statistics and the total of kept records."""
    s = Pipeline(spark, sf_dir).corpus_stats
    # one row per split: the total over splits is a window over a few rows
    return s.withColumn("total_kept_records",
                        F.sum("kept_records").over(Window.partitionBy()).cast("long"))


@register
def q_length_histogram(spark, sf_dir):
    """Token-length histogram per split."""
    return ingest.length_histogram(Pipeline(spark, sf_dir).documents)


# -- index ------------------------------------------------------------------------

@register
def q_postings(spark, sf_dir):
    """Postings (term frequency per document)."""
    return Pipeline(spark, sf_dir).index.postings.select(
        "doc_id", "term", F.col("term_frequency").cast("long").alias("term_frequency"))


@register
def q_vocabulary(spark, sf_dir):
    """Document / collection frequency and idf per term."""
    v = Pipeline(spark, sf_dir).index.vocabulary
    return v.select("term", "document_frequency", "collection_frequency",
                    round6("idf").alias("idf"))


@register
def q_index_stats(spark, sf_dir):
    """Corpus totals, rounded average length, vocabulary size."""
    return Pipeline(spark, sf_dir).index.statistics


@register
def q_index_stats_kv(spark, sf_dir):
    """The statistics as key / JSON-value rows."""
    from quarry.operators.index import statistics_long
    return statistics_long(Pipeline(spark, sf_dir).index.statistics)


# -- BM25 retrieval and evaluation ---------------------------------------------------

@register
def q_queries(spark, sf_dir):
    """Query records from the test split's non-blank docstrings."""
    return Pipeline(spark, sf_dir).queries


@register
def q_bm25_scores(spark, sf_dir):
    """BM25 score of every matching (query, document)."""
    p = Pipeline(spark, sf_dir)
    s = search.bm25_scores(p.index, p.queries)
    return s.select("query_id", "doc_id", from_fixed("score_fp").alias("score"))


@register
def q_bm25_topk(spark, sf_dir):
    """BM25 top-50 per query (ties by doc_id)."""
    p = Pipeline(spark, sf_dir)
    return long_rank(p.bm25_ranking.select("query_id", "rank", "doc_id", "score"))


@register
def q_bm25_topk_pruned(spark, sf_dir):
    """The same top-50 from an index with more document buckets than
    files (its second level), pruned by the block maxima of each."""
    p = Pipeline(spark, sf_dir)
    n = p.index.files * p.index.parts
    # its layout is all that is read: its tables go, by the names of their folders
    folders = {f.rsplit("/", 2)[-2] for t in (p.index.lists, p.index.documents, p.index.vocabulary) for f in t.inputFiles()}
    release_scratch(spark, [x for x in scratch_written() if x.rsplit("/", 1)[-1] in folders])
    idx = build_index(p.documents, 4 * n, files=n).materialized()
    return long_rank(search.bm25_topk(idx, p.queries, p.depth).select("query_id", "rank", "doc_id", "score"))


@register
def q_bm25_per_query(spark, sf_dir):
    """Per-query rank of the relevant document and metrics."""
    pq = Pipeline(spark, sf_dir).bm25_per_query
    return pq.select("query_id", F.col("relevant_rank").cast("long").alias("relevant_rank"),
                     *[round6(c).alias(c) for c in
                       ("rr_at_10", "recall_at_10", "recall_at_50", "ndcg_at_10")])


@register
def q_bm25_metrics(spark, sf_dir):
    """A10 H8: MRR@10, Recall@10/50, nDCG@10 over the queries."""
    return Pipeline(spark, sf_dir).bm25_metrics


@register
def q_sample_rankings(spark, sf_dir):
    """First five queries with their top five results."""
    p = Pipeline(spark, sf_dir)
    return long_rank(E.sample_rankings(p.queries, p.bm25_ranking))


@register
def q_adhoc_search(spark, sf_dir):
    """H1: ad-hoc search of the benchmark texts (top 10)."""
    p = Pipeline(spark, sf_dir)
    qs = tables.benchmark_queries(spark, sf_dir)
    return long_rank(search.search(p.index, qs, TOP_K).drop("score_fp"))


@register
def q_conversation_search(spark, sf_dir):
    """H1: ad-hoc search of all turns of the conversations (top 10)."""
    p = Pipeline(spark, sf_dir)
    qs = tables.conversation_queries(spark, sf_dir)
    return long_rank(search.search(p.index, qs, TOP_K).drop("score_fp"))


@register
def q_examples(spark, sf_dir):
    """Self-retrieving example queries."""
    p = Pipeline(spark, sf_dir)
    return report.example_queries(p.index, p.documents)


# -- vectors and rerank -----------------------------------------------------------------

def _with_stored_vectors(spark, sf_dir):
    """The dense stages with a stored vector table: hashed vectors of the
    documents that ``embeddings`` lists, written as float32 and read back."""
    p = Pipeline(spark, sf_dir)
    path = scratch_path(spark, "stored_vectors")
    listed = tables.stored_vectors(spark, sf_dir).select("doc_id").distinct()
    with settings(spark, KEEP_BUCKETS):
        sinks.write_vectors(rerank.hashed_document_vectors(p.index, listed), path)
    out = DensePipeline(spark, sf_dir, vectors=spark.read.parquet(path), vectors_encoder=rerank.HASHED)
    out.__dict__.update(prepared=p.prepared, index=p.index)
    return out


@register
def q_l2_normalize(spark, sf_dir):
    """V3: L2-normalised stored vectors."""
    v = tables.stored_vectors(spark, sf_dir)
    return _explode_vector(rerank.normalized(v), "doc_id")


@register
def q_cosine(spark, sf_dir):
    """V4: cosine of each BM25 candidate with its query's vector."""
    p = _with_stored_vectors(spark, sf_dir)
    return rerank.cosine_pairs(p.candidates, p.query_vectors, p.candidate_vectors)


@register
def q_mean_pool(spark, sf_dir):
    """V1: hashed-encoder document vectors (summed and normalised)."""
    p = Pipeline(spark, sf_dir)
    return _explode_vector(rerank.hashed_document_vectors(p.index), "doc_id")


@register
def q_rerank_topk(spark, sf_dir):
    """Rerank of the BM25 candidates by stored document
    vectors (encoded on a miss) and the query texts, both by one encoder."""
    return _with_stored_vectors(spark, sf_dir).rerank_ranking


@register
def q_rerank_metrics(spark, sf_dir):
    """A10: metrics of that rerank over all queries."""
    return _with_stored_vectors(spark, sf_dir).rerank_metrics


@register
def q_rerank_hashed_topk(spark, sf_dir):
    """Rerank with the hashed encoder on both sides."""
    return DensePipeline(spark, sf_dir).rerank_ranking


@register
def q_rerank_hashed_metrics(spark, sf_dir):
    """A10: metrics of the hashed-encoder rerank."""
    return DensePipeline(spark, sf_dir).rerank_metrics


@register
def q_metrics_table(spark, sf_dir):
    """Metrics side by side for the two pipelines."""
    p = _with_stored_vectors(spark, sf_dir)
    return report.metrics_table(p.bm25_metrics, p.rerank_metrics)


@register
def q_compare_pipelines(spark, sf_dir):
    """H3: both pipelines for each benchmark text, with counts."""
    p = Pipeline(spark, sf_dir)
    qs = tables.benchmark_queries(spark, sf_dir)
    return report.compare_pipelines(p.index, qs, rerank.hashed_query_vectors(qs),
                                    rerank.hashed_document_vectors(p.index), top_k=TOP_K)


@register
def q_dense_summary(spark, sf_dir):
    """Documents, vectors and judged queries per split; dimension."""
    p = DensePipeline(spark, sf_dir)
    docs = p.documents.select("split", F.col("id").alias("doc_id"),
                              (T.strip("document_text") != "").alias("full")).filter("full")
    sizes = p.vectors.select("doc_id", F.size("embedding").cast("long").alias("dimension"))
    dv = docs.join(sizes, "doc_id", "left")
    with_vector = p.queries.join(p.query_vectors.select("query_id"), "query_id").count()
    return dv.groupBy("split").agg(
        F.count(F.lit(1)).alias("documents"), F.count("dimension").alias("vectors"),
        F.max("dimension").alias("embedding_dimension")).select(
        "*", F.when(F.col("split") == p.query_split, F.lit(with_vector)).otherwise(0).cast("long")
        .alias("queries_with_vector"))


@register
def q_encode_on_miss(spark, sf_dir):
    """V7: document vectors, stored where there is one and encoded otherwise."""
    p = Pipeline(spark, sf_dir)
    ids = p.documents.select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    return _explode_vector(rerank.vectors_or_encode(
        ids, tables.stored_vectors(spark, sf_dir), lambda missing: rerank.hashed_document_vectors(
            p.index, missing.select("doc_id")), "doc_id", "text"), "doc_id")


@register
def q_masked_mean_pool(spark, sf_dir):
    """Masked mean of three token vectors (the stored vector, its
    reverse, its negative) by the signs of its first three components; a zero
    vector when no token counts."""
    v = tables.stored_vectors(spark, sf_dir).select("doc_id", F.transform(
        "embedding", lambda x: x.cast("double")).alias("e"))
    v = v.select("doc_id", F.array("e", F.reverse("e"), F.transform("e", lambda x: -x)).alias("v"),
                 F.array(*[(F.get("e", i) > 0).cast("int") for i in range(3)]).alias("m"))
    return _explode_vector(v.select("doc_id", rerank.mean_pool("v", "m").alias("embedding")), "doc_id")


@register
def q_latest_turn(spark, sf_dir):
    """The last turn of each conversation (last wins by key)."""
    c = tables.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return rerank.latest_by_key(c.withColumn("last_turn", F.col("turn")), "conv_id", "turn")


@register
def q_vector_sink(spark, sf_dir):
    """Normalised vectors written as float32 and read back."""
    path = scratch_path(spark, "vectors")
    sinks.write_vectors(rerank.normalized(tables.stored_vectors(spark, sf_dir)), path)
    return _explode_vector(spark.read.parquet(path), "doc_id")


# -- reports -------------------------------------------------------------------------------

@register
def q_document_lookup(spark, sf_dir):
    """Documents with the truthy metadata overrides, from tables stored
    by id."""
    return Pipeline(spark, sf_dir).records.lookup()


@register
def q_result_cards(spark, sf_dir):
    """Enriched top-10 result rows (late materialisation)."""
    p = Pipeline(spark, sf_dir)
    top = p.bm25_ranking.filter(F.col("rank") <= TOP_K).drop("score_fp")
    cards = report.result_cards(top, documents=p.documents, metadata=p.metadata)
    return long_rank(cards)


@register
def q_max_queries(spark, sf_dir):
    """P10: the first twenty queries in file order."""
    return E.build_queries(Pipeline(spark, sf_dir).documents, "test", 20)


@register
def q_evaluation_run(spark, sf_dir):
    """H8: the evaluation run, written as one nested record, read back and
    flattened to its sample results."""
    path = scratch_path(spark, "result")
    sinks.write_result(Pipeline(spark, sf_dir).bm25_result(), path)
    r = sinks.read_result(spark, path).select(
        "metrics.*", F.col("index_statistics.document_count").alias("document_count"),
        F.explode("sample_rankings").alias("s"))
    return r.select("query_count", "mrr_at_10", "recall_at_10", "recall_at_50", "ndcg_at_10", "document_count",
                    F.col("s.query_id").alias("query_id"), F.explode("s.top_results").alias("t")).select(
        "*", F.col("t.rank").cast("long").alias("rank"), "t.doc_id", "t.score").drop("t")


@register
def q_postings_lookup(spark, sf_dir):
    """Point lookup of the postings of three terms in the term-clustered copy."""
    return write_term_store(Pipeline(spark, sf_dir).index, files=32).postings(["the", "und", "que"]).select(
        "term", "doc_id", F.col("term_frequency").cast("long").alias("term_frequency"))


@register
def q_jsonl_records(spark, sf_dir):
    """The raw records, their splits under the dataset's names
    renamed by the export, written as JSON lines, a folder per split in file
    order, read back strictly with ids from line numbers."""
    raw = jsonl.export_splits(tables.raw_records(spark, sf_dir).replace({"valid": "validation"}, subset=["split"]))
    base = scratch_path(spark, "jsonl")
    paths = {split: f"{base}/{split}" for split in quality.EXPECTED_SPLITS}
    for split, path in paths.items():
        raw.filter(F.col("split") == split).orderBy("ordinal").select(*jsonl.RAW_FIELDS).write.json(path)
    return jsonl.read_records(spark, paths).select(
        "id", "split", F.col("ordinal").cast("long").alias("ordinal"), "func_name", "func_code_url",
        F.md5("whole_func_string").alias("text_md5"))


# -- data quality ----------------------------------------------------------------------------

@register
def q_dq_counts(spark, sf_dir):
    """Document and metadata counts per split."""
    p = Pipeline(spark, sf_dir)
    return quality.count_check(p.documents, p.metadata)


@register
def q_dq_id_mismatch(spark, sf_dir):
    """Id-set comparison of documents and metadata."""
    p = Pipeline(spark, sf_dir)
    return quality.id_report(p.documents, p.metadata)


@register
def q_dq_empty_fields(spark, sf_dir):
    """Blank name / code / lexical text per split."""
    return quality.empty_fields(Pipeline(spark, sf_dir).documents)


@register
def q_dq_sample(spark, sf_dir):
    """Seeded sample per split with previews."""
    return quality.sample(Pipeline(spark, sf_dir).documents)


@register
def q_dq_stats_present(spark, sf_dir):
    """Statistics present for every expected split."""
    return quality.split_stats_present(Pipeline(spark, sf_dir).corpus_stats)


@register
def q_dq_vector_alignment(spark, sf_dir):
    """Query / vector alignment and dimensions of the stored vectors."""
    p = DensePipeline(spark, sf_dir)
    return quality.vector_alignment(p.queries, p.query_vectors, tables.stored_vectors(spark, sf_dir))


def _ids(spark, sf_dir, name: str, key: str) -> DataFrame:
    t = tables.read_table(spark, sf_dir, name)
    return t.select(tables.split_of(key).alias("split"), F.col(key).alias("id"))


@register
def q_dq_label_counts(spark, sf_dir):
    """Documents and labels per split (labels cover only some documents)."""
    return quality.count_check(_ids(spark, sf_dir, "documents", "doc_id"), _ids(spark, sf_dir, "labels", "doc_id"))


@register
def q_dq_label_ids(spark, sf_dir):
    """Id sets of documents and labels."""
    return quality.id_report(_ids(spark, sf_dir, "documents", "doc_id"), _ids(spark, sf_dir, "labels", "doc_id"))


@register
def q_dq_vector_ids(spark, sf_dir):
    """Documents without a stored vector and vectors without a document."""
    return quality.id_mismatch(_ids(spark, sf_dir, "documents", "doc_id"), _ids(spark, sf_dir, "embeddings", "vec_id"))


@register
def q_dq_raw_empty_fields(spark, sf_dir):
    """Blank fields of the raw records, before the fallback and the
    drops: a text without a newline has no code of its own."""
    raw = tables.raw_records(spark, sf_dir)
    return quality.empty_fields(raw.select(
        "split", "func_name", F.col("func_code_string").alias("code"),
        F.col("func_documentation_string").alias("lexical_document")))


@register
def q_lookup_overrides(spark, sf_dir):
    """Lookup with metadata from another table, of which some values
    are empty and some documents have none."""
    docs = Pipeline(spark, sf_dir).documents.select("id", "func_name")
    lab = tables.read_table(spark, sf_dir, "labels")
    name = lambda c: F.when(F.col(c) == 1, F.concat(F.lit(f"{c}/"), F.col("doc_id").cast("string"))).otherwise("")
    meta = lab.select(F.col("doc_id").alias("id"), name("quality").alias("repository_name"),
                      name("toxic").alias("func_path_in_repository"), F.lit("").alias("func_code_url"),
                      F.lit(None).cast("string").alias("language"))
    return report.document_lookup(docs, meta)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
