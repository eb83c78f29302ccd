"""A training-data pipeline: quality rules, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns of
documents.

Defined results: a null, empty or very short text fails the quality rules and goes; whole texts count, however long; null
ids stay null and come first where order matters; rows that repeat id and text are one document from near-dedup on;
columns beside doc_id, text and n_chars stay as they are, whatever their names; an empty table gives no rows.

The result of a stage reads its intermediate tables. They are deleted when the next stage begins, which is when that
result has been written and read again; so write one stage's result before you call another.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import line_dedup, near_copies, packing, quality_rules, shared

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_of_stage_before: list[str] = []


def _alone(stage: Stage) -> Stage:
    """The stage, with the intermediate tables of the one before deleted as it begins."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _of_stage_before:
            shared.discard(spark, path)
        begin = len(shared.made)
        result = stage(spark, docs, sf_dir)
        _of_stage_before[:] = shared.made[begin:]
        return result

    return run_stage


@_alone
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules find good."""
    return quality_rules.kept(docs)


@_alone
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of three lines, or whole texts of fewer, that occurred before; every document stays, n_chars follows the text."""
    from pyspark.sql import functions as F

    return line_dedup.without_repeats(docs, short=True).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@_alone
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: SimHash links and what lies beyond their radius, an exact Jaccard similarity of five-word shingles of at least 0.8."""
    return near_copies.one_of_each(docs)


@_alone
def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", keep_one_of_each),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each but the last written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Shingle hashes, the components of near copies and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None
