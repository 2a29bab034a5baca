"""The corpus pipeline: each stage takes all documents that the one before has
kept, its decisions take effect, and it returns documents again (the last
returns its result).  Stages are written to the shared folder and read back.

Since a stage reads what the one before has stored, the scratch tables of that
one are deleted when it begins, so disk holds one stage's tables at a time.  A
stage's result must therefore be stored before the next stage is called; where
the next one's documents still read the scratch tables, they stay.

Defined cases, for all stages: a null text counts as empty, and a null doc_id or
source is a value like another; near-dedup never removes rows without words or
id, equal rows of one id stay or go together; ties are broken by id, then text;
an empty table gives an empty table with the same columns; further columns pass
through, whatever their names."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import byte_bpe, order_minhash, quality_rules, source_mixing, substring_dedup
from quarry.session import materialize, release_scratch, scratch_written
from quarry.sources.tables import read_table


_left: list[str] = []  # scratch tables of the stage before


def stage(fn):
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _left:
            read = docs.inputFiles()
            release_scratch(spark, [p for p in _left if not any(p.rsplit("/", 1)[-1] in f for f in read)])
            _left.clear()
        before = set(scratch_written())
        out = fn(spark, docs, sf_dir)
        _left.extend(p for p in scratch_written() if p not in before)
        return out
    return run_stage


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rules of a corpus reject go."""
    # packed, since the results of ``judge`` replace columns of their names
    packed = docs.select("text", F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"))
    return quality_rules.judge(packed, rules=quality_rules.CORPUS_RULES).filter("kept").select("_row.*")


@stage
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each class of near-copies the smallest id stays."""
    return order_minhash.keep_one(docs)


@stage
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: passages that start earlier are cut out of the texts."""
    return substring_dedup.dedup_texts(docs)


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: each document as often as its source's target asks for."""
    return source_mixing.mix_documents(docs)


@stage
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token ids of each text, checked by decoding them."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("source mixing", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

# sketches, random keys and token merges have no SQL; tests/llm/test_corpus_pipeline.py checks each stage
# and the chain by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
