"""Speaker turns: reading labels, choosing a body, packs of bounded capacity, routes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import LABEL, plain_digits, stripped
from turnloom.session import map_arrow


def parse_turns(meetings: DataFrame, *, id_col: str = "meeting_id", body_col: str = "body", label: str = LABEL) -> DataFrame:
    """meeting_id, turn_no (from 1), speaker (digits as text, null before the first label), text.

    Labels may stand anywhere in the text, not only at the start of a line. A body without labels is one turn without a
    speaker; a label without text is a turn with an empty text; null and blank bodies have no turns.
    """
    parts = F.split(F.col(body_col), f"(?={label})")
    rows = meetings.select(F.col(id_col).alias("meeting_id"), F.posexplode(parts).alias("place", "part"))
    speaker = F.regexp_extract("part", rf"^[^0-9０-９]*?([0-9０-９]+)[：:]", 1)
    labelled = F.col("part").rlike(f"^{label}")
    rows = rows.select(
        "meeting_id", "place", F.when(labelled, plain_digits(speaker)).alias("speaker"), stripped(F.when(labelled, F.regexp_replace("part", f"^{label}", "")).otherwise(F.col("part"))).alias("text")
    ).where("speaker IS NOT NULL OR text <> ''")
    number = F.row_number().over(Window.partitionBy("meeting_id").orderBy("place"))
    return rows.select("meeting_id", number.cast("long").alias("turn_no"), "speaker", "text")


def anonymous_turns(materials: DataFrame, boundaries: DataFrame) -> DataFrame:
    """meeting_id, turn_no, speaker (null), text, boundary_source: bodies without labels cut where a model decided.

    boundaries: meeting_id, begins (code points before a turn, ascending or not; 0 is implied). Decisions are data here.
    """
    cuts = boundaries.groupBy(F.col("meeting_id").alias("of_meeting")).agg(F.sort_array(F.collect_set(F.col("begins").cast("int"))).alias("cuts"))
    rows = materials.join(cuts, F.col("meeting_id") == F.col("of_meeting"), "left")
    begins = F.array_distinct(F.array_sort(F.array_union(F.array(F.lit(0)), F.filter(F.coalesce("cuts", F.array().cast("array<int>")), lambda c: (c > 0) & (c < F.length("body"))))))
    rows = rows.withColumn("begins", begins)
    piece = lambda c, k: F.substring(F.col("body"), c + 1, F.coalesce(F.get("begins", k + 1), F.length("body")) - c)
    turns = rows.select("meeting_id", F.posexplode(F.transform("begins", piece)).alias("place", "text"))
    return turns.select("meeting_id", (F.col("place") + 1).cast("long").alias("turn_no"), F.lit(None).cast("string").alias("speaker"), "text", F.lit("model").alias("boundary_source"))


def body_metrics(candidates: DataFrame, turns: DataFrame) -> DataFrame:
    """meeting_id, source_id, coverage, in_order: what a choice of body can be based on, for each candidate source.

    candidates: meeting_id, source_id, body; turns: meeting_id, turn_no, text (the reference order). coverage is the
    share of turns found in the body; in_order whether all of those are found one behind the other, each searched for
    from the end of the one before, so that turns with the same text need a place each. The choice itself is made outside.
    """
    texts = turns.groupBy(F.col("meeting_id").alias("of_meeting")).agg(F.array_sort(F.collect_list(F.struct("turn_no", "text"))).alias("turns"))
    rows = candidates.join(texts, F.col("meeting_id") == F.col("of_meeting"))
    state = lambda begins, found, ordered: F.struct(begins.cast("int").alias("begins"), found.cast("int").alias("found"), ordered.alias("ordered"))

    def step(done: Column, turn: Column) -> Column:
        at = F.position(turn["text"], F.col("body"), done["begins"])
        known = (at > 0) | (F.position(turn["text"], F.col("body")) > 0)
        return F.when(at > 0, state(at + F.length(turn["text"]), done["found"] + 1, done["ordered"])).when(known, state(done["begins"], done["found"] + 1, F.lit(False))).otherwise(done)

    walk = F.aggregate("turns", state(F.lit(1), F.lit(0), F.lit(True)), step).alias("walk")
    rows = rows.select("meeting_id", "source_id", F.size("turns").alias("n"), walk)
    return rows.select("meeting_id", "source_id", (F.col("walk.found") / F.col("n")).alias("coverage"), F.col("walk.ordered").alias("in_order"))


def chosen_body(candidates: DataFrame, choices: DataFrame) -> DataFrame:
    """The candidate that was chosen for each meeting; one without a choice or with an unknown one has no row."""
    return candidates.join(choices.select("meeting_id", "source_id"), ["meeting_id", "source_id"])


def pack_turns(turns: DataFrame, capacity: int, *, id_col: str = "meeting_id", turn_col: str = "turn_no", size: Column | None = None) -> DataFrame:
    """meeting_id, turn_no, size, pack_no (from 1), used: runs of whole turns, each pack filled in order until the next does not fit.

    size: by default the code points of the column text. A turn larger than the capacity has a pack of its own. Linear,
    in source order; no search for a better filling. Meetings are sorted and walked through batch by batch: only one
    pack's state is held, however long a meeting is.
    """
    size = F.coalesce(F.length("text"), F.lit(0)) if size is None else size
    rows = turns.select(F.col(id_col).alias("meeting_id"), F.col(turn_col).cast("long").alias("turn_no"), size.cast("long").alias("size"))
    kind = rows.schema["meeting_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting, pack, filled = object(), 0, 0
        for batch in batches:
            packs, used = [], []
            for of, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if of != meeting:
                    meeting, pack, filled = of, 1, n
                elif filled + n <= capacity:
                    filled += n
                else:
                    pack, filled = pack + 1, n
                packs.append(pack)
                used.append(filled)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packs, pa.int64()), pa.array(used, pa.int64())], names=["meeting_id", "turn_no", "size", "pack_no", "used"])

    ordered = rows.repartition("meeting_id").sortWithinPartitions("meeting_id", "turn_no", "size")
    return map_arrow(ordered, run, f"meeting_id {kind}, turn_no long, size long, pack_no long, used long")


def long_packs(turns: DataFrame, routes: DataFrame, capacity: int) -> DataFrame:
    """pack_turns of the meetings that were routed "segmented"; all others stay whole and have no packs."""
    return pack_turns(turns.join(routes.where("route = 'segmented'").select("meeting_id").distinct(), "meeting_id", "left_semi"), capacity)


def pack_summary(packs: DataFrame) -> DataFrame:
    """meeting_id, pack_no, n_turns, first_turn, last_turn, size."""
    return packs.groupBy("meeting_id", "pack_no").agg(F.count(F.lit(1)).alias("n_turns"), F.min("turn_no").alias("first_turn"), F.max("turn_no").alias("last_turn"), F.sum("size").alias("size"))


def qa_units(turns: DataFrame, asks: Column, *, id_col: str = "meeting_id", turn_col: str = "turn_no") -> DataFrame:
    """meeting_id, turn_no, qa_no: a unit begins with each turn that asks; turns before the first one are unit 0.

    asks: whether a turn asks; a decision from outside, such as a column or a role.
    """
    w = Window.partitionBy("meeting_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.select(F.col(id_col).alias("meeting_id"), F.col(turn_col).cast("long").alias("turn_no"), asks.cast("int").alias("asks"))
    return rows.select("meeting_id", "turn_no", F.coalesce(F.sum("asks").over(w), F.lit(0)).cast("long").alias("qa_no"))


def pack_units(units: DataFrame, sizes: DataFrame, capacity: int) -> DataFrame:
    """meeting_id, qa_no, size, pack_no, used: packs that cut between complete questions with their answers only.

    units: as of qa_units; sizes: meeting_id, turn_no, size.
    """
    whole = units.join(sizes, ["meeting_id", "turn_no"]).groupBy("meeting_id", "qa_no").agg(F.sum("size").alias("n"))
    return pack_turns(whole, capacity, turn_col="qa_no", size=F.col("n")).withColumnRenamed("turn_no", "qa_no")


def routed(meetings: DataFrame, routes: DataFrame) -> DataFrame:
    """meetings with their route, "direct" or "segmented", from a table of decisions (never from a length); null if undecided.

    Long material alone takes the segmented way; what has no decision waits.
    """
    known = routes.where(F.col("route").isin("direct", "segmented")).select("meeting_id", "route")
    return meetings.join(known, "meeting_id", "left")
