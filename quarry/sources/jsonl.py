"""JSON-lines sources with physical line numbers.

``read_records`` reads one JSONL file (or folder) per split into the raw
record shape used by :mod:`quarry.operators.ingest`:

* every physical line is numbered from 1, blank lines included (they are
  counted and then skipped), so record ids ``{split}-{line}`` are stable; in a
  folder the numbers run on from file to file in path order;
* a line is valid if the whole of it is one JSON object (nothing after it);
* ``mode='FAILFAST'`` fails the job on the first malformed line, naming the
  file and line, whatever columns the plan reads; ``mode='DROPMALFORMED'``
  skips such lines;
* ``_keys`` lists the keys present in each record, so defaults can apply
  only to missing keys (an explicit null stays null).

Line numbers are computed without shuffling the text: rows of one file
block are read in order inside one task, so a row's line number is the
block's line offset plus its position in the block.  The offsets come from
a small aggregate (one row per file block), broadcast back while it is small
and joined otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from quarry.functions import text as T

RAW_FIELDS = ("func_name", "func_code_string", "whole_func_string", "func_documentation_string",
              "language", "repository_name", "func_path_in_repository", "func_code_url")
RAW_SCHEMA = Ty.StructType([Ty.StructField(f, Ty.StringType()) for f in RAW_FIELDS])

# The dataset's split names and the export renaming.
SPLIT_RENAMES = {"validation": "valid"}


# Bytes of the block offsets that may be broadcast; a row is its file's path and four numbers.
BROADCAST_BYTES = 64 * 1024 * 1024


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, ordinal, value)`` for every physical line of the text
    files: its number in its file and in the whole folder."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_row"))
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"),
                                                F.min("_row").alias("first_row"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", "first_row",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.withColumn("file_offset", F.min("offset").over(Window.partitionBy("file")))
    size = blocks.agg(F.sum(F.length("file") + 64)).first()[0] or 0
    small = F.broadcast(offsets) if size <= BROADCAST_BYTES else offsets
    place = F.col("offset") + F.col("_row") - F.col("first_row") + 1
    return lines.join(small, ["file", "block"]).select(
        "file", (place - F.col("file_offset")).alias("line_no"), place.alias("ordinal"), "value")


# double quotes only, no raw control characters in strings
STRICT = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false", "columnNameOfCorruptRecord": "_bad"}


def is_record(value: str = "value") -> F.Column:
    """Whether the whole line is one JSON object.  The strict parser stops after
    the object; inside a list with a random mark behind it, a parser reaches the
    mark only if nothing else follows the object.  As Python decides, but that
    NaN and Infinity, which are not JSON, are refused."""
    v = F.col(value)
    mark = uuid.uuid4().hex
    listed = F.concat(F.lit("["), v, F.lit(f',"{mark}"]'))
    bad = F.from_json(v, "_bad string", STRICT)["_bad"]
    return (F.json_object_keys(v).isNotNull() & bad.isNull()
            & F.coalesce(F.get_json_object(listed, "$[1]") == mark, F.lit(False)))


def parse_records(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Non-blank numbered lines parsed into raw records with ``_keys``."""
    lines = lines.filter(T.strip("value") != "")
    record = F.from_json("value", RAW_SCHEMA)
    if mode.upper() == "FAILFAST":
        # in the fields, so that a later filter on them can't get below the check, and as a filter,
        # so that a plan without the fields keeps it
        failure = F.raise_error(F.concat(F.lit("Invalid JSON in "), F.col("file"), F.lit(" at line "),
                                         F.col("line_no").cast("string")))
        lines = lines.filter(F.when(is_record(), F.lit(True)).otherwise(failure.cast("boolean")))
        record = F.when(is_record(), record).otherwise(failure.cast(RAW_SCHEMA))
    elif mode.upper() in ("DROPMALFORMED", "PERMISSIVE"):
        lines = lines.filter(is_record())
    else:
        raise ValueError(f"unknown mode {mode}")
    return lines.select("file", "line_no", "ordinal", F.json_object_keys("value").alias("_keys"),
                        record.alias("r")).select(
        "file", "line_no", "ordinal", "_keys", "r.*")


def read_records(spark: SparkSession, paths_by_split: dict[str, str],
                 mode: str = "FAILFAST") -> DataFrame:
    """Raw records of several splits; the split comes from the file (not
    from the record), the id is ``{split}-{line}`` and ``ordinal`` the line."""
    frames = []
    for split, path in paths_by_split.items():
        recs = parse_records(numbered_lines(spark, path), mode)
        frames.append(recs.select(
            F.concat_ws("-", F.lit(split), F.col("ordinal").cast("string")).alias("id"),
            F.lit(split).alias("split"), "line_no", "ordinal", *RAW_FIELDS, "_keys"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_offsets(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Tolerant lookup scan: ``(key, file, line_no)`` for each record with a
    non-empty key; malformed and blank lines are skipped, a repeated key keeps
    its last line."""
    lines = numbered_lines(spark, path).filter(T.strip("value") != "")
    k = F.get_json_object("value", f"$.{key}")
    good = lines.filter(is_record()).select(
        k.alias(key), "file", "line_no").filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return good.groupBy(key).agg(F.max_by(F.struct("file", "line_no"), "line_no").alias("loc")) \
        .select(key, "loc.file", "loc.line_no")


def export_splits(records: DataFrame, split_col: str = "split") -> DataFrame:
    """Dataset export mapping: split names renamed (``validation`` -> ``valid``)."""
    mapping = F.create_map(*[x for kv in SPLIT_RENAMES.items() for x in map(F.lit, kv)])
    return records.withColumn(split_col, F.coalesce(mapping[F.col(split_col)], F.col(split_col)))
