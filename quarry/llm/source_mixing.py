"""Mixing sources to target weights with built-in expressions only.

Each document gets a hash-random key; documents stand in the order of their
keys within their source, in equal key ranges ("bins").  Sums of sizes by
(source, bin) give each bin's offset, a running sum inside the bin gives each
document's place, and the mix takes whole passes over the source plus the part
of the order before the cut at the source's exact budget.  The document at the
cut is taken in part.

A hot source is spread over all bins, so no task holds more than a small part
of it; the sums have at most (sources x bins) rows, one source at most ``bins``.

Defined cases: a null text has size 0; a null source is a source of its own,
the last in order; documents without words are never taken; rows with equal
keys (repeated rows) are ordered by id and size, so that reruns agree; an empty
table gives an empty result; result names replace extra columns of that name in
``mix_documents``, and ``budgets`` ignores extra columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, SPACE_CHARS, WORD
from quarry.session import materialize

WEIGHTS = (1, 2, 3)  # by source in order, repeating
MOST_EPOCHS = 3
SEED = 42


def bin_bits(spark: SparkSession) -> int:
    """Bins of a source: a few times the shuffle's partitions, so that a third
    of all rows in one source is spread evenly over all of them."""
    return max(8, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def sized(docs: DataFrame, bits: int, extra: list[str]) -> DataFrame:
    key = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text"))
    return docs.select(
        *extra, "doc_id", "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        key.alias("_key"), F.shiftrightunsigned(key, 64 - bits).alias("_bin"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size`` with ``target``: shares by weight, none above
    ``most`` times its source, the excess reshared by weight until none is.

    In ascending order of cap per weight the capped sources come first, and the
    level (target per weight) of the others follows from prefix sums alone.
    One row per source, already summed.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.select("source", "source_size", weight.cast("double").alias("_w"),
                       (F.lit(most) * F.col("source_size")).cast("double").alias("_cap"))
    ratio = F.col("_cap") / F.col("_w")
    up = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_w").over(up.rowsBetween(0, Window.unboundedFollowing))
    everyone = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_level", (F.sum("source_size").over(everyone) - before) / left)
    # the level rises over the capped sources and falls after them
    return s.select("source", "source_size", F.least(
        F.col("_cap"), F.max("_level").over(everyone) * F.col("_w")).alias("target"))


def budgets(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each document (and the
    ``extra`` columns)."""
    spark = docs.sparkSession
    bits = bin_bits(spark)
    d = sized(docs, bits, list(extra))
    bins = d.select("source", "_bin", "size").groupBy("source", "_bin").agg(F.sum("size").alias("_n"))
    bins = materialize(bins, "mixing_bins")  # a row per source and bin
    sums = bins.groupBy("source").agg(F.sum("_n").alias("source_size"))
    in_source = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select("source", "_bin", "_n", F.coalesce(F.sum("_n").over(in_source), F.lit(0)).alias("_offset"))
    t = targets(sums).withColumnRenamed("source", "_s")
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    offsets = materialize(offsets.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), F.col("_bin").alias("_b"), "source_size", "target", whole.alias("_whole"),
        (budget - whole * F.col("source_size") - F.col("_offset")).alias("_rest"), "_n"), "mixing_offsets")
    d = d.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    # only in the bin at the cut does a document's place matter; the others are wholly in or out
    at_cut = (F.col("_rest") > 0) & (F.col("_rest") < F.col("_n"))
    placed = Window.partitionBy("source", "_bin").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    clear = d.filter(~at_cut).withColumn("_before", F.lit(0).cast("long"))
    split = d.filter(at_cut).withColumn("_before", F.coalesce(F.sum("size").over(placed), F.lit(0)))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before")))
    taken = (F.col("_whole") * F.col("size") + cut).cast("long").alias("taken")
    clear, split = (x.select(*extra, "doc_id", "size", "source_size", "target", taken) for x in (clear, split))
    return clear.union(split)


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is taken.
    The copy at the cut holds its first words, joined by one space; ``n_chars``,
    if there, follows a cut text."""
    columns = docs.columns
    packed = docs.select("doc_id", "text", "source", F.struct(*[f"`{c}`" for c in columns]).alias("_row"))
    b = budgets(packed, extra=("_row",)).filter(F.col("taken") > 0)
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    words = F.least(F.col("size"), F.col("taken") - F.col("_copy") * F.col("size"))
    b = b.select("_row", "size", "taken", F.explode(F.sequence(F.lit(0), copies - 1)).alias("_copy"))
    part = words < F.col("size")
    cut = F.array_join(F.slice(F.split(F.btrim("_row.text", F.lit(SPACE_CHARS)), SPACE),
                               F.lit(1), words.cast("int")), " ")
    changed = {"text": F.when(part, cut).otherwise(F.col("_row.text"))}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(part, F.length(cut).cast("long")).otherwise(F.col("_row.n_chars"))
    return b.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns])
