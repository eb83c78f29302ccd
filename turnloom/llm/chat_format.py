"""Chat formatting with cumulative-snapshot collapse.

A chat is often logged again after each turn, so that a logged conversation is the beginning of a longer one. Each turn
is hashed with its position; the hashes of a conversation's first k turns combine into a rolling prefix hash. A
conversation whose hash is the prefix hash of a longer one is dropped by an anti-join; of equal conversations the one
with the smallest id stays. Those that remain are rendered.

Everything is DataFrame and SQL expressions. Positions and prefix hashes are taken within blocks of a conversation and
carried over from block to block, because sums and exclusive ors can be; so one conversation with very many turns is
many small groups. Only hashes are compared; the texts move once, to be rendered, in parts of a block each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.shared import stored

#: Turn numbers of a block, and so about as many turns of a rendered part.
BLOCK = 512
#: How a turn is rendered.
TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")


def _turn_hash(part: int) -> Column:
    """60 bits of the MD5 of role and text; null is not the empty string."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.col("role").isNull().cast("string"), F.length(role).cast("string"), F.lit(":"), role, F.col("text").isNull().cast("string"), text)
    return F.conv(F.substring(F.md5(said), 1 + 15 * part, 15), 16, 10).cast("long")


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return rows.withColumns({"h1": _turn_hash(0), "h2": _turn_hash(1), "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))})


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, block, turn, h1, h2, position (from 1), p1, p2: the rolling hash of the turns up to each one."""
    distinct = turns.groupBy("conv_id", "block", "turn", "h1", "h2").agg(F.lit(1).alias("one")).drop("one")
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "h1", "h2")
    sizes = distinct.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), "offset")
    of_block = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block"))
    placed = distinct.withColumn("place", F.row_number().over(within)).join(offsets, of_block)
    placed = placed.withColumn("position", F.col("offset") + F.col("place")).withColumns({"g1": F.xxhash64("position", "h1"), "g2": F.xxhash64("position", "h2")})
    placed = placed.select("conv_id", "block", "turn", "h1", "h2", "position", "g1", "g2")
    whole = placed.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"))
    carried = whole.select(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), *[F.coalesce(F.bit_xor(x).over(before.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"c{x}") for x in ("x1", "x2")])
    rolling = Window.partitionBy("conv_id", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.withColumns({"r1": F.bit_xor("g1").over(rolling), "r2": F.bit_xor("g2").over(rolling)}).join(carried, of_block)
    return rolled.select("conv_id", "block", "turn", "h1", "h2", "position", F.expr("r1 ^ cx1").alias("p1"), F.expr("r2 ^ cx2").alias("p2"))


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id, n_turns: the conversations that are no beginning of another one, one of each that are equal."""
    ends = rolled.groupBy("conv_id").agg(F.max(F.struct("position", "p1", "p2")).alias("end")).select("conv_id", "end.*")
    longer = rolled.join(ends.select(F.col("conv_id").alias("of_conv"), F.col("position").alias("n")), F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("position") < F.col("n")), "left_semi")
    begins = longer.select("position", "p1", "p2").distinct()
    # equal conversations become one before they are dealt by their hash, however many there are
    one = ends.groupBy("position", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    return one.join(begins, ["position", "p1", "p2"], "left_anti").select("conv_id", F.col("position").alias("n_turns"))


def render(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """One row per part of each conversation that is kept: conv_id, part (from 0), n_turns (of the part), rendered.

    A part holds the turns of BLOCK positions; all but very long conversations have one part.

    Defined results: rows that repeat conversation, turn, role and text are one turn; turns with the same number follow
    each other in the order of a hash, a null number comes first; a null role is rendered as "unknown", a null text as
    empty; a text that contains the template's marks is rendered as it is, so turns are told apart only where texts don't; rows with a null conversation id are one conversation, which gives way to an equal one that has an id; texts
    are never cut; an empty table gives no rows; other columns are not read.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    rolled = stored(prefixes(turns), "turn-prefixes")
    kept = maximal(rolled).select(F.col("conv_id").alias("kept_conv"))
    places = rolled.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_conv")), "left_semi").select(F.col("conv_id").alias("of_conv"), F.col("turn").alias("of_turn"), F.col("h1").alias("of_h1"), F.col("h2").alias("of_h2"), "position")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & F.col("turn").eqNullSafe(F.col("of_turn")) & (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))
    start, middle, end = (F.lit(x) for x in template)
    shown = F.concat(start, F.coalesce("role", F.lit("unknown")), middle, F.coalesce("text", F.lit("")), end)
    rows = turns.join(stored(places, "kept-turns"), same).select("conv_id", F.floor((F.col("position") - 1) / BLOCK).cast("long").alias("part"), "position", shown.alias("shown"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_set(F.struct("position", "shown"))).alias("turns"))
    return parts.select("conv_id", "part", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda x: x["shown"]), "").alias("rendered"))


def sql() -> str:
    """DuckDB SQL for render() over conversations."""
    return f"""
WITH said AS (
  SELECT *, md5(concat(role IS NULL, length(coalesce(role, '')), ':', role, text IS NULL, text)) AS hash FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), turns AS (
  SELECT conv_id, role, text, hash, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, hash) AS position FROM said
), rolled AS (
  SELECT *, string_agg(hash, '') OVER (PARTITION BY conv_id ORDER BY position) AS prefix,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
), kept AS (
  SELECT min(conv_id) AS conv_id FROM rolled
  WHERE position = n AND prefix NOT IN (SELECT prefix FROM rolled WHERE position < n) GROUP BY prefix
)
SELECT t.conv_id, CAST((position - 1) // {BLOCK} AS BIGINT) AS part, count(*) AS n_turns,
  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY position) AS rendered
FROM turns t JOIN kept k ON t.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY ALL
"""
