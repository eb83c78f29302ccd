"""Edits returned for packs: coverage, order, reasons for deletions, and assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN = ["meeting_id", "turn_no"]


def missing_turns(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """meeting_id, turn_no: source turns that no edit accounts for."""
    return turns.select(*TURN).join(edits.select(*TURN), TURN, "left_anti")


def unknown_turns(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """meeting_id, turn_no: edits of turns that the source does not have."""
    return edits.select(*TURN).join(turns.select(*TURN), TURN, "left_anti").distinct()


def repeated_edits(edits: DataFrame) -> DataFrame:
    """meeting_id, turn_no, n: turns that were edited more than once."""
    return edits.groupBy(*TURN).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def order_violations(edits: DataFrame) -> DataFrame:
    """meeting_id, position, turn_no, turn_before: edits whose turn does not come after that of the edit before.

    edits: with their position in what was returned. The order is not repaired by sorting, it is checked.
    """
    before = F.lag("turn_no").over(Window.partitionBy("meeting_id").orderBy("position"))
    return edits.select("meeting_id", "position", "turn_no", before.alias("turn_before")).where("turn_no <= turn_before")


def unreasoned_deletions(edits: DataFrame) -> DataFrame:
    """meeting_id, turn_no: whole turns that were deleted without a reason."""
    return edits.where((F.col("action") == "delete") & (F.trim(F.coalesce("reason", F.lit(""))) == "")).select(*TURN)


def assembly_summary(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """One row: n_turns, n_edits, n_missing, n_unknown, n_repeated, n_out_of_order, n_unreasoned, ok."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(name))
        for name, df in (
            ("n_turns", turns), ("n_edits", edits), ("n_missing", missing_turns(turns, edits)), ("n_unknown", unknown_turns(turns, edits)), ("n_repeated", repeated_edits(edits)),
            ("n_out_of_order", order_violations(edits)), ("n_unreasoned", unreasoned_deletions(edits)),
        )
    ]
    names = [c.columns[0] for c in counts]
    rows = counts[0].select(F.lit(names[0]).alias("name"), F.col(names[0]).alias("n"))
    for c, name in zip(counts[1:], names[1:], strict=True):
        rows = rows.unionByName(c.select(F.lit(name).alias("name"), F.col(name).alias("n")))
    one = rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])
    return one.withColumn("ok", sum((F.col(name) for name in names[2:]), F.lit(0)) == 0)


def assembled(turns: DataFrame, edits: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """meeting_id, n_turns, text: the edited turns joined in source order, one line each with its speaker.

    Deleted turns are left out; an edit without a text keeps the source's. entities: meeting_id, surface, form: names
    that are written one way throughout (longest first). Nothing else is changed.
    """
    once = edits.groupBy(*TURN).agg(F.min_by(F.struct("action", "text"), "position").alias("edit"))
    source = turns.select(*TURN, "speaker", F.col("text").alias("source"))
    rows = source.join(once, TURN).where("edit.action <> 'delete'")
    line = F.concat(F.when(F.col("speaker").isNotNull(), F.concat(F.col("speaker"), F.lit(": "))).otherwise(""), F.coalesce("edit.text", "source", F.lit("")))
    lines = rows.select(*TURN, line.alias("line")).groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("turn_no", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    out = lines.select("meeting_id", F.size("lines").cast("long").alias("n_turns"), text.alias("text"))
    if entities is None:
        return out
    names = entities.groupBy(F.col("meeting_id").alias("of_meeting")).agg(F.collect_set(F.struct("surface", "form")).alias("names"))
    longest = F.array_sort("names", lambda a, b: F.length(b["surface"]) - F.length(a["surface"]))
    spelled = F.aggregate(longest, F.col("text"), lambda t, e: F.replace(t, e["surface"], e["form"]))
    return out.join(names, F.col("meeting_id") == F.col("of_meeting"), "left").select("meeting_id", "n_turns", F.when(F.col("names").isNull(), F.col("text")).otherwise(spelled).alias("text"))
