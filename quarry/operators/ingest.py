"""Corpus build: raw records -> cleaned documents, metadata, drop reasons,
per-split statistics and the token-length histogram.

Input: a raw-record DataFrame with columns ``id, split, func_name,
func_code_string, whole_func_string, func_documentation_string, language,
repository_name, func_path_in_repository, func_code_url`` and optionally
``_keys`` (the JSON keys present in the record, for the missing-vs-null rule
of the metadata defaults).  Everything is a narrow projection except the
statistics: counters that are taken while the prepared rows are written
(``observed``), or one partial-aggregated ``groupBy(split)`` where the splits
are not known beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numeric import round_ratio

DROP_MISSING_NAME = "missing_name"
DROP_MISSING_CODE = "missing_code"
DROP_EMPTY_LEXICAL = "empty_lexical"

DOCUMENT_COLUMNS = ("id", "split", "func_name", "docstring", "code", "document_text",
                    "lexical_document", "lexical_token_count", "has_docstring", "ordinal")
METADATA_COLUMNS = ("id", "split", "language", "repository_name",
                    "func_path_in_repository", "func_name", "func_code_url")


def file_order(records: DataFrame) -> F.Column:
    """``ordinal``, the place of a record in its file; tables without one are
    in the order of their ids."""
    return F.col("ordinal" if "ordinal" in records.columns else "id").alias("ordinal")


def prepare(raw: DataFrame) -> DataFrame:
    """Every raw record with its cleaned fields, tokens and drop reason
    (null for kept records).  Tokenizes once; persist the result when it is
    used by several consumers."""
    has_keys = "_keys" in raw.columns
    name = T.strip(F.coalesce(F.col("func_name"), F.lit("")))
    code = T.clean_code(T.first_non_empty("func_code_string", "whole_func_string"))
    docstring = T.clean_docstring(T.first_non_empty("func_documentation_string"))

    def meta(key: str, default):
        # the default applies only when the key is missing; an explicit null stays
        if not has_keys:
            return F.col(key)
        return F.when(F.array_contains(F.col("_keys"), key), F.col(key)).otherwise(F.lit(default))

    staged = raw.select(
        "id", "split", file_order(raw),
        name.alias("func_name"), docstring.alias("docstring"), code.alias("code"),
        meta("language", "python").alias("language"),
        meta("repository_name", "").alias("repository_name"),
        meta("func_path_in_repository", "").alias("func_path_in_repository"),
        meta("func_code_url", "").alias("func_code_url"),
    )
    with_tokens = staged.withColumn(
        "tokens", T.tokenize_parts("func_name", "docstring", "code"))
    reason = (F.when(F.col("func_name") == "", DROP_MISSING_NAME)
               .when(F.col("code") == "", DROP_MISSING_CODE)
               .when(F.size("tokens") == 0, DROP_EMPTY_LEXICAL))
    # the token list travels as its space-joined text (tokens never contain
    # whitespace, so splitting it gives the list back)
    cols = [c for c in with_tokens.columns if c != "tokens"]
    return with_tokens.select(
        *cols, F.array_join("tokens", " ").alias("lexical_document"),
        F.size("tokens").cast("long").alias("lexical_token_count"), reason.alias("drop_reason"))


def documents(prepared: DataFrame) -> DataFrame:
    """Kept records in the processed-document shape."""
    cols = [
        "id", "split", "func_name", "docstring", "code",
        T.document_text("func_name", "docstring", "code").alias("document_text"),
        "lexical_document", "lexical_token_count",
        (F.length("docstring") > 0).alias("has_docstring"), "ordinal",
    ]
    return prepared.filter(F.col("drop_reason").isNull()).select(*cols)


def metadata(prepared: DataFrame) -> DataFrame:
    """Kept records in the metadata shape (1:1 with documents by id)."""
    return prepared.filter(F.col("drop_reason").isNull()).select(*METADATA_COLUMNS)


def rejected(prepared: DataFrame) -> DataFrame:
    """Dropped records with their single drop reason."""
    return prepared.filter(F.col("drop_reason").isNotNull()) \
        .select("id", "split", "drop_reason")


def drop_reason_counts(prepared: DataFrame) -> DataFrame:
    return rejected(prepared).groupBy("split", "drop_reason") \
        .agg(F.count(F.lit(1)).alias("n_records"))


def _counters(of: F.Column) -> list[F.Column]:
    """The counters and totals over the prepared records where ``of`` holds."""
    kept = of & F.col("drop_reason").isNull()
    doc_text_len = F.length(T.document_text("func_name", "docstring", "code"))

    def count(name: str, condition: F.Column) -> F.Column:
        return F.count_if(condition).alias(name)

    def total(name: str, value: F.Column) -> F.Column:
        return F.coalesce(F.sum(F.when(kept, value)), F.lit(0)).cast("long").alias(name)

    return [
        count("raw_records", of),
        count("kept_records", kept),
        count("dropped_missing_name", of & (F.col("drop_reason") == DROP_MISSING_NAME)),
        count("dropped_missing_code", of & (F.col("drop_reason") == DROP_MISSING_CODE)),
        count("dropped_empty_lexical", of & (F.col("drop_reason") == DROP_EMPTY_LEXICAL)),
        count("records_with_docstring", kept & (F.length("docstring") > 0)),
        count("records_without_docstring", kept & (F.length("docstring") == 0)),
        total("document_char_total", doc_text_len),
        total("lexical_token_total", F.col("lexical_token_count")),
        total("docstring_char_total", F.length("docstring")),
    ]


def corpus_stats(prepared: DataFrame, splits=None) -> DataFrame:
    """One row per split with the reference's counters, totals, averages
    (2 decimals) and missing-docstring rate (4 decimals).  With ``splits``,
    a split without records still gets its row (all counters 0)."""
    agg = prepared.groupBy("split").agg(*_counters(F.lit(True)))
    if splits:
        spark = prepared.sparkSession
        expected = spark.createDataFrame([(x,) for x in splits], "split string")
        counters = [c for c in agg.columns if c != "split"]
        agg = expected.join(agg, "split", "left").select(
            "split", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counters])
    return _with_averages(agg)


def observed(prepared: DataFrame, splits: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``prepared`` with the counters of each of ``splits`` taken by the first
    action on it, so that the statistics need no second read of the texts.  The
    observed node must stay in the stage that writes (no shuffle after it):
    there Spark counts each partition once, tasks that run again included.
    Records of other splits are not counted."""
    seen = Observation()
    return prepared.observe(seen, F.count(F.lit(1)).alias("records"), *[
        F.struct(*_counters(F.col("split") == s)).alias(f"split_{i}") for i, s in enumerate(splits)]), seen


def observed_stats(spark: SparkSession, seen: Observation, splits: Sequence[str]) -> DataFrame:
    """``corpus_stats(prepared, splits)`` from the counters of ``observed``, whose
    action must have run.  What reaches the driver is one row a split."""
    found = seen.get
    rows = [(s, *found[f"split_{i}"]) for i, s in enumerate(splits)]
    names = found["split_0"].__fields__
    return _with_averages(spark.createDataFrame(
        rows, "split string not null, " + ", ".join(f"{c} long not null" for c in names)))


def _with_averages(agg: DataFrame) -> DataFrame:
    denom = "greatest(kept_records, 1)"
    return agg.select(
        "*",
        round_ratio("document_char_total", denom, 2).alias("document_char_avg"),
        round_ratio("lexical_token_total", denom, 2).alias("lexical_token_avg"),
        round_ratio("docstring_char_total", denom, 2).alias("docstring_char_avg"),
        round_ratio("records_without_docstring", denom, 4).alias("missing_docstring_rate"),
    )


def length_histogram(docs: DataFrame) -> DataFrame:
    """``(split, bucket, n_documents)`` over kept documents' token counts."""
    return docs.groupBy("split", T.histogram_bucket("lexical_token_count").alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("n_documents"))


def corpus_stats_nested(stats: DataFrame, histogram: DataFrame) -> DataFrame:
    """The nested statistics document: one row with ``splits`` as a map from
    split name to its stats struct (histogram as ``map<string,long>``) and
    the total of kept records."""
    hist = histogram.groupBy("split").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("bucket", "n_documents"))))
        .alias("length_histogram"))
    per_split = stats.join(hist, "split", "left")
    fields = [c for c in per_split.columns if c != "split"]
    return per_split.agg(
        F.map_from_entries(F.collect_list(F.struct("split", F.struct(*fields)))).alias("splits"),
        F.sum("kept_records").alias("total_kept_records"))


@dataclass
class Corpus:
    """The three outputs of a corpus build."""
    documents: DataFrame
    metadata: DataFrame
    stats: DataFrame
    histogram: DataFrame


def store_prepared(raw: DataFrame, splits: Sequence[str] | None) -> tuple[DataFrame, Observation | None]:
    """The prepared records, tokenized once and stored for all outputs, with the
    counters of ``splits`` (none: not observed)."""
    from quarry.session import materialize
    prepared, seen = observed(prepare(raw), splits) if splits else (prepare(raw), None)
    return materialize(prepared, "prepared"), seen


def build_corpus(raw: DataFrame, splits=None) -> Corpus:
    """The corpus of ``raw``.  With ``splits`` the statistics come from the pass
    that stores the records; the histogram reads the stored token counts only."""
    prepared, seen = store_prepared(raw, splits)
    stats = observed_stats(raw.sparkSession, seen, splits) if seen else corpus_stats(prepared)
    docs = documents(prepared)
    return Corpus(docs, metadata(prepared), stats, length_histogram(docs))
