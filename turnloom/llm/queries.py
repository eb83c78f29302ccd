"""One query per operator of this subpackage, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import chat_format, html_text, line_dedup, packing, pieces, quality_rules, simhash, sketch, suffix_tree, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"verdict.{name}" for name in fields])


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(_table(spark, sf_dir, "conversations"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compare_edits(_table(spark, sf_dir, "documents"))


def op6_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(_table(spark, sf_dir, "documents"))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"), digests=True)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.without_repeats(_table(spark, sf_dir, "documents"), count="n_removed")
    return docs.select("doc_id", "n_removed", "text")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality_rules,
        op2_chat_formatting,
        op3_packing,
        op4_simhash_near_duplicates,
        op5_document_fingerprints,
        op6_language_model_scores,
        op7_sentence_pieces,
        op8_line_dedup,
        op9_warc,
        op10_html_text,
    )
}

ORACLE_SQL: dict[str, str] = {"op1_quality_rules": quality_rules.sql(), "op2_chat_formatting": chat_format.sql(), "op8_line_dedup": line_dedup.sql(), "op9_warc": warc.sql()}
