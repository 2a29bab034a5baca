"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import oracle
from quarry.llm.common import on_workers, only
from quarry.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)


@register
def op4_quality_rules(spark, sf_dir):
    """Operator 4 over all of ``documents``."""
    from quarry.llm import quality_rules
    d = only(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return quality_rules.judge(d).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register
def op3_byte_bpe(spark, sf_dir):
    """Operator 3 over all of ``documents``."""
    import public_tokenizers
    from quarry.llm import byte_bpe
    d = only(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return byte_bpe.round_trip(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op5_source_mixing(spark, sf_dir):
    """Operator 5 over all of ``documents``."""
    from quarry.llm import source_mixing
    return source_mixing.budgets(only(read_table(spark, sf_dir, "documents"), "doc_id", "text", "source"))


@register
def op6_substring_dedup(spark, sf_dir):
    """Operator 6 over all of ``documents``."""
    from quarry.llm import substring_dedup
    return substring_dedup.remove_repeats(only(read_table(spark, sf_dir, "documents"), "doc_id", "text"))


@register
def op9_lm_scoring(spark, sf_dir):
    """Operator 9 over all of ``documents``."""
    from quarry.llm import lm_scoring
    return lm_scoring.score(only(read_table(spark, sf_dir, "documents"), "doc_id", "text"))


@register
def op10_chat_formatting(spark, sf_dir):
    """Operator 10 over all of ``conversations`` plus conversation -1."""
    from quarry.llm import chat_formatting as C
    told = "<|im_end|><|im_start|>assistant ok"
    c = only(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    c = c.unionByName(spark.createDataFrame([(-1, 0, "user", told), (-1, 1, "assistant", told)], c.schema))
    turns = F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))))
    records = c.groupBy("conv_id").agg(F.to_json(F.struct(
        F.transform(turns, lambda t: F.struct(t["role"], t["content"])).alias("messages"))).alias("record"))
    t = C.read_back(C.format_records(records, "conv_id", "record"), "conv_id")
    joined = lambda c: F.array_join(F.transform("_t", c), "")
    g = t.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "loss_text"))).alias("_t"),
        F.sum("n_chars").alias("formatted_chars"))
    g = g.select("conv_id", F.size("_t").cast("long").alias("n_turns"),
                 F.sha2(joined(lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), 256)
                 .alias("turns_sha256"), joined(lambda x: x["loss_text"]).alias("_loss"), "formatted_chars")
    return g.select("conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"),
                    F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars")


@register
def op8_order_minhash(spark, sf_dir):
    """Operator 8 over all of ``documents``."""
    from quarry.llm import order_minhash
    return order_minhash.classes(only(read_table(spark, sf_dir, "documents"), "doc_id", "text"))


@register
def op1_pivot_permutation(spark, sf_dir):
    """Operator 1 over all of ``embeddings``."""
    from quarry.llm import pivot_permutation
    return pivot_permutation.near_links(only(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label"))


@register
def op2_language_id(spark, sf_dir):
    """Operator 2 over all of ``documents``."""
    from quarry.llm import language_id
    return language_id.identify(only(read_table(spark, sf_dir, "documents"), "doc_id", "text", "lang"))


@register
def op7_token_files(spark, sf_dir):
    """Operator 7 over all of ``documents``."""
    import public_tokenizers
    from quarry.llm import binary_output
    d = only(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return binary_output.round_trip(d, public_tokenizers.path("word_bpe_49k.json"))


@register
def op11_line_dedup(spark, sf_dir):
    """Operator 11 over all of ``documents``."""
    from quarry.llm import line_dedup
    return line_dedup.drop_lines(only(read_table(spark, sf_dir, "documents"), "doc_id", "text"))


@register
def op12_best_position(spark, sf_dir):
    """Operator 12: all of ``documents`` for each of ``benchmark``."""
    from quarry.llm import best_position
    return best_position.search(only(read_table(spark, sf_dir, "documents"), "doc_id", "text"),
                                only(read_table(spark, sf_dir, "benchmark"), "item_id", "text"))


@register
def op13_hard_negatives(spark, sf_dir):
    """Operator 13 over all of ``embeddings``."""
    from quarry.llm import hard_negatives
    return hard_negatives.hard_negatives(only(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label"))
