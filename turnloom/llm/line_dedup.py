"""Line deduplication over overlapping windows of three lines.

Every three consecutive lines with a word are hashed. A window that occurs more than once, in one text or in several,
stays where it occurs first (by document id, then position); each later occurrence marks its lines, and the union of
what is marked is removed. So a passage goes from where it is repeated, and lines that only happen to be the same stay.

Everything is DataFrame and SQL expressions. A window travels as two 64-bit hashes and its place; the counts are summed
before the shuffle, so a passage that very many documents share is one row per task. Then the texts move once, to the
marks of their lines: these grow with the corpus and are never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.shared import WHITE_SPACE, WORD_CHARACTER, held, stored

WINDOW = 3


def _numbered(text: Column) -> Column:
    """The lines with a word, without white space around them, and their numbers among all lines."""
    numbered = F.transform(F.split(text, "\n"), lambda x, k: F.struct(F.btrim(x, F.lit(WHITE_SPACE)).alias("line"), k.alias("number")))
    return F.filter(numbered, lambda x: x["line"].rlike(WORD_CHARACTER))


def windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, short: bool = False) -> DataFrame:
    """doc_id, text_hash, h1, h2, at: a row for each window, with its place among the lines that have a word.

    short: a text with fewer such lines than a window, but at least one, is one window of those it has.
    """
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), _numbered(F.col(text_col)).alias("lines"))
    line = lambda i, k: F.get("lines", i + k)["line"]
    hashed = F.transform(
        F.sequence(F.lit(0), F.size("lines") - size),
        lambda i: F.struct(F.xxhash64(*[line(i, k) for k in range(size)]).alias("h1"), F.xxhash64(F.lit(size), *[line(i, k) for k in range(size)]).alias("h2"), i.alias("at")),
    )
    found = F.when(F.size("lines") >= size, hashed)
    if short:
        bare = F.transform("lines", lambda x: x["line"])
        found = found.when(F.size("lines") > 0, F.array(F.struct(F.xxhash64(bare).alias("h1"), F.xxhash64(F.size("lines"), bare).alias("h2"), F.lit(0).alias("at"))))
    # the outer form, for Spark would evaluate the other one twice, to filter out empty arrays beforehand
    return rows.select("doc_id", "text_hash", F.inline_outer(found)).where("h1 IS NOT NULL")


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, short: bool = False) -> DataFrame:
    """doc_id, text_hash, places: where in a document windows are that occurred before."""
    found = windows(docs, id_col=id_col, text_col=text_col, size=size, short=short)
    place = F.struct("doc_id", "text_hash", "at")
    known = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2", "first")
    # stored, so that both sides of the join are plain exchanges: Spark deals a passage with very many places to several tasks
    later = found.join(stored(known, "repeated-windows").hint("merge"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("places"))


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, count: str | None = None, short: bool = False) -> DataFrame:
    """docs with repeated passages taken out of the text, all columns as they were; count: a column more, of removed lines.
    short: texts with fewer than three lines that have a word are one window of those they have, and go where they are repeated whole.

    Defined results: null and empty texts, and without short texts with fewer than three lines that have a word, stay as they are; a
    text that is wholly repeated becomes empty (its row stays); lines without a word stay and count for no window; a null id comes
    before all others; rows with the same id are in the order of a hash of their texts, and rows that repeat id and text
    are one document; white space around a line makes no difference to what is equal; a window
    that overlaps its own first occurrence is a later one all the same (of the lines a a a a b, a b is left); an empty table gives no rows.
    """
    extra = ["_marked_id", "_marked_hash", "_places", "_lines", "_numbers", "_gone"]
    while {c.lower() for c in docs.columns} & set(extra):
        extra = [c + "_" for c in extra]
    marked_id, marked_hash, places, lines, numbers, gone = extra
    marks = stored(repeats(docs, id_col=id_col, text_col=text_col, size=size, short=short).toDF(marked_id, marked_hash, places), "repeats")
    same = docs[id_col].cast("long").eqNullSafe(marks[marked_id]) & (F.xxhash64(docs[text_col]) == marks[marked_hash])
    joined = docs.join(marks.hint("merge"), same, "left").withColumn(lines, held(F.when(F.col(places).isNotNull(), F.split(text_col, "\n"))))
    numbered = joined.withColumn(numbers, held(F.when(F.col(places).isNotNull(), F.transform(_numbered(F.col(text_col)), lambda x: x["number"]))))
    joined = numbered.withColumn(gone, held(F.array_distinct(F.flatten(F.transform(places, lambda p: F.slice(numbers, p + 1, size))))))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    if count:
        joined = joined.withColumn(count, F.when(F.col(places).isNull(), 0).otherwise(F.size(gone)).cast("long"))
    text = F.when(F.col(places).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(left, lambda k: F.get(lines, k)), "\n"))
    return joined.withColumn(text_col, text).select(*docs.columns, *([count] if count else []))


def sql(size: int = WINDOW) -> str:
    """DuckDB SQL for doc_id, n_removed, text over documents."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH lines AS (
  SELECT doc_id, number, line, trim(line, {white}) AS bare
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS number FROM documents WHERE text IS NOT NULL)
), worded AS (
  SELECT doc_id, number, bare, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS nth FROM lines WHERE bare <> ''
), windows AS (
  SELECT doc_id, nth, {" || chr(10) || ".join(f"lead(bare, {k}) OVER (PARTITION BY doc_id ORDER BY nth)" if k else "bare" for k in range(size))} AS passage FROM worded
), later AS (
  SELECT doc_id, nth FROM (SELECT doc_id, nth, row_number() OVER (PARTITION BY passage ORDER BY doc_id, nth) AS turn FROM windows WHERE passage IS NOT NULL) WHERE turn > 1
), gone AS (
  SELECT DISTINCT w.doc_id, w.number FROM later l JOIN worded w ON w.doc_id = l.doc_id AND w.nth BETWEEN l.nth AND l.nth + {size - 1}
), rebuilt AS (
  SELECT x.doc_id, count(g.number) AS n_removed, coalesce(string_agg(x.line, chr(10) ORDER BY x.number) FILTER (WHERE g.number IS NULL), '') AS text
  FROM lines x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.number = x.number GROUP BY x.doc_id
)
SELECT d.doc_id, CAST(coalesce(r.n_removed, 0) AS BIGINT) AS n_removed, r.text AS text FROM documents d LEFT JOIN rebuilt r ON r.doc_id = d.doc_id
"""
