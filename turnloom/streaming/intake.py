"""Intake of transcripts as they arrive: files are read as a stream and their turns written, each batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnloom.operators.turns import parse_turns


def body_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """meeting_id (the file's name without its ending), body: a stream of text files."""
    rows = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return rows.select(F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("meeting_id"), F.col("value").alias("body"))


def turns_to(bodies: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes the turns of each batch to a folder of its own, so that a batch that runs again replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        parse_turns(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return bodies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
