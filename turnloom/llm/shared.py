"""What the operators of this subpackage have in common: word splitting and intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.session import shared_folder

#: Fixed by the operators' contract: what separates words (space and x09 to x0D).
WHITE_SPACE = " \t\n\x0b\x0c\r"
WHITE_SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"

#: bytes.translate table that lower-cases A-Z and nothing else.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text."""
    stripped = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, WHITE_SPACE_RUN))


def held(column: Column) -> Column:
    """The column, evaluated where it stands.

    Spark moves a filter below the columns that it uses and writes their expressions out in it, one inside the other;
    inside a lambda they would be evaluated for each element. It does not where a column is not deterministic.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)


#: Where the tables of this process are, in the order in which they were stored.
made: list[str] = []


def discard(spark: SparkSession, path: str | None = None) -> None:
    """Deletes all intermediate tables of this application, or one of them; results that still read them can't be used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path or shared_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back.

    This cuts the lineage and survives lost executors, and what is expensive or not repeatable (Python passes,
    generated row ids) is done once. The tables belong to the application; discard() deletes them.
    """
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As stored(), and where the table is, for one that is discarded as soon as what was made of it is stored itself."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def portions(column: pa.Array, chars: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of a column, null as empty, in lists of about as many characters."""
    portion, held = [], 0
    for text in column:
        portion.append(text.as_py() or "")
        held += len(portion[-1])
        if held >= chars:
            yield portion
            portion, held = [], 0
    if portion:
        yield portion


def slices(batch: pa.RecordBatch, texts: int, chars: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about as many bytes of the text column with that index, so that what is made of a slice stays small."""
    start, held = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_pylist()):
        held += n
        if held >= chars:
            yield batch.slice(start, k + 1 - start)
            start, held = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
