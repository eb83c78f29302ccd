"""The note: sections in order, two of them only where there is something to say."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed by the format: the sections in their order, with their titles. The layout below them is ours.
SECTIONS = (("minutes", "会议纪要"), ("reference", "参考原文"), ("doubtful", "存疑与待确认"), ("changes", "重要信息修改记录"))
ALWAYS = ("minutes", "reference")


def doubtful_items(candidates: DataFrame) -> DataFrame:
    """meeting_id, section, ord, md: a list item for each candidate that cannot be resolved, with what it may be."""
    rows = candidates.where("disposition = 'genuinely_doubtful'")
    hint = F.when(F.size(F.coalesce("options", F.array().cast("array<string>"))) > 0, F.concat(F.lit("（疑似："), F.array_join("options", "、"), F.lit("）"))).otherwise("")
    return rows.select("meeting_id", F.lit("doubtful").alias("section"), F.col("turn_no").cast("long").alias("ord"), F.concat(F.lit("- "), F.col("surface"), hint).alias("md"))


def change_items(changes: DataFrame) -> DataFrame:
    """meeting_id, section, ord, md: a list item for each visible substantive correction, with the evidence it was made on.

    changes: meeting_id, turn_no, old, new, evidence. A change that shows nothing new is no item.
    """
    rows = changes.where("old <> new")
    return rows.select("meeting_id", F.lit("changes").alias("section"), F.col("turn_no").cast("long").alias("ord"), F.concat(F.lit("- "), F.col("old"), F.lit(" → "), F.col("new"), F.when(F.col("evidence").isNotNull(), F.concat(F.lit("（"), F.col("evidence"), F.lit("）"))).otherwise("")).alias("md"))


def with_templates(meetings: DataFrame, templates: DataFrame) -> DataFrame:
    """meetings with the template of their meeting_type (null for an unknown type, or none); templates: meeting_type, template."""
    one = templates.groupBy("meeting_type").agg(F.min("template").alias("template"))
    return meetings.join(one, "meeting_type", "left")


def rendered(parts: DataFrame, headings: tuple[tuple[str, str], ...] = SECTIONS) -> DataFrame:
    """meeting_id, n_sections, md: one Markdown text per meeting from parts (meeting_id, section, ord, md).

    Parts of a section stand in the order of ord, then text; a section without parts is left out; unknown sections are an
    error of the caller and are left out too.
    """
    rank = F.create_map(*[x for k, (name, _) in enumerate(headings) for x in (F.lit(name), F.lit(k))])
    title = F.array(*[F.lit(t) for _, t in headings])
    rows = parts.withColumn("rank", F.try_element_at(rank, F.col("section"))).where("rank IS NOT NULL AND md IS NOT NULL")
    sections = rows.groupBy("meeting_id", "rank").agg(F.array_sort(F.collect_list(F.struct("ord", "md"))).alias("items"))
    text = F.concat(F.lit("## "), F.get(title, F.col("rank")), F.lit("\n\n"), F.array_join(F.transform("items", lambda x: x["md"]), "\n"), F.lit("\n"))
    whole = sections.select("meeting_id", "rank", text.alias("text")).groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("all"))
    return whole.select("meeting_id", F.size("all").cast("long").alias("n_sections"), F.array_join(F.transform("all", lambda x: x["text"]), "\n").alias("md"))
