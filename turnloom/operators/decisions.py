"""Invariants of text decisions.

Which word to repair, keep or doubt is decided by a model or a person and comes as a table. These operators only check
what a decision must not break; each returns the rows that do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import DIGITS, HAN_DIGITS, YEAR, added_numbers, masked, missing, plain_digits, present, quantities

#: Fixed by the contract: what can become of a candidate.
DISPOSITIONS = ("genuinely_doubtful", "normal_copyedit", "preserve_meeting_uncertainty", "preserve_source", "resolved_identity")


def repair_violations(repairs: DataFrame) -> DataFrame:
    """repair_id, fault: repairs of a span that is not in the source, whose new form is not in the result, or that add what is forbidden.

    repairs: repair_id, source, edited, old_span, new_span, forbidden (array). A forbidden phrase that the source has is no addition.
    """
    added = F.filter(present(F.col("edited"), F.col("forbidden")), lambda p: ~F.contains(F.col("source"), p))
    fault = (
        F.when(~F.contains(F.col("source"), F.col("old_span")), "span not in source")
        .when(~F.contains(F.col("edited"), F.col("new_span")), "repair not in result")
        .when(F.size(added) > 0, "forbidden addition")
    )
    return repairs.select("repair_id", fault.alias("fault")).where("fault IS NOT NULL")


def identity_copies(turns: DataFrame) -> DataFrame:
    """The turns whose edited text is the source unchanged; a warning, for a copyedit may change nothing."""
    return turns.where(F.col("edited") == F.col("source"))


def unproven_changes(changes: DataFrame, evidence: DataFrame) -> DataFrame:
    """change_id: changes of identity, category, action, attribute, scope or strength without evidence from the meeting.

    changes: change_id, kind; evidence: change_id, in_meeting (boolean).
    """
    needs = changes.where(F.col("kind").isin("identity", "category", "action", "attribute", "scope", "strength"))
    return needs.join(evidence.where("in_meeting").select("change_id"), "change_id", "left_anti").select("change_id")


def number_additions(turns: DataFrame, logged: Column | None = None) -> DataFrame:
    """turns with a column added (array): numbers that the source does not have, unless logged; only turns that have any.

    logged: an array of numbers that the change log explains, such as a year written out. For units see quantity_changes.
    """
    added = added_numbers(F.col("source"), F.col("edited"))
    if logged is not None:
        added = F.array_except(added, F.coalesce(logged, F.array().cast("array<string>")))
    return turns.withColumn("added", added).where(F.size("added") > 0)


def quantity_changes(turns: DataFrame) -> DataFrame:
    """turns with a column added (array): numbers with the unit behind them that the source does not have so; only turns that have any."""
    added = F.array_sort(F.array_except(quantities(F.col("edited")), quantities(F.col("source"))))
    return turns.withColumn("added", added).where(F.size("added") > 0)


def year_faults(years: DataFrame) -> DataFrame:
    """decision_id, fault: two-digit years that were spelled out otherwise than by their digits, or where the context leaves a doubt.

    years: decision_id, spoken (two digits, Chinese or not, and a year sign), written, certain (boolean, decided outside).
    """
    digits = F.translate(plain_digits(F.regexp_extract("spoken", f"^([{HAN_DIGITS}0-9０-９]{{2}}){YEAR}", 1)), HAN_DIGITS, DIGITS)
    fault = (
        F.when(F.coalesce(digits, F.lit("")) == "", "no two-digit year")
        .when(~F.coalesce("certain", F.lit(False)), "context leaves a doubt")
        .when(~F.coalesce(F.col("written").rlike(f"^(19|20)[0-9]{{2}}{YEAR}") & (F.substring("written", 3, 2) == digits), F.lit(False)), "other digits")
    )
    return years.select("decision_id", fault.alias("fault")).where("fault IS NOT NULL")


def metric_faults(metrics: DataFrame) -> DataFrame:
    """decision_id, fault: metrics that were restored without a definition before them in the sentence, or with characters it does not have.

    metrics: decision_id, sentence, definition, short (as it stands), restored. The restored name must be made of
    characters of the definition, in their order.
    """
    begins = F.position("definition", "sentence")
    step = lambda at, c: F.when(at > 0, F.when(F.position(c, F.col("definition"), at) > 0, F.position(c, F.col("definition"), at) + 1).otherwise(0)).otherwise(0)
    made_of = F.aggregate(F.split("restored", "(?!^)"), F.lit(1), step) > 0
    fault = (
        F.when(~F.coalesce((begins > 0) & (F.length("definition") > 0), F.lit(False)), "no definition")
        .when(~F.coalesce(F.position("short", "sentence", begins + F.length("definition")) > 0, F.lit(False)), "not behind its definition")
        .when(~F.coalesce(made_of, F.lit(False)), "not of the definition")
    )
    return metrics.select("decision_id", fault.alias("fault")).where("fault IS NOT NULL")


def unit_faults(numbers: DataFrame) -> DataFrame:
    """decision_id, fault: numbers whose unit the source says is missing but that are not doubtful or got a unit, and complete ones that are doubtful.

    numbers: decision_id, number (as the source has it), unit_missing (decided outside), disposition, edited.
    """
    doubtful = F.col("disposition") == "genuinely_doubtful"
    bare = F.array_contains(quantities(F.col("edited")), F.col("number"))
    fault = F.when(F.col("unit_missing") & ~doubtful, "missing unit is not doubtful").when(F.col("unit_missing") & ~bare, "unit was supplied").when(~F.col("unit_missing") & doubtful, "complete number is doubtful")
    return numbers.select("decision_id", fault.alias("fault")).where("fault IS NOT NULL")


def compression_faults(notes: DataFrame) -> DataFrame:
    """id, lost, added: minutes that lost a required phrase or added a forbidden one (outside of required ones), sorted; only those with any.

    notes: id, minutes, required, forbidden (arrays).
    """
    lost = F.array_sort(missing(F.col("minutes"), F.col("required"))).alias("lost")
    added = F.array_sort(present(masked(F.col("minutes"), F.coalesce("required", F.array().cast("array<string>"))), F.col("forbidden"))).alias("added")
    return notes.select("id", lost, added).where((F.size("lost") > 0) | (F.size("added") > 0))


def abbreviation_faults(abbreviations: DataFrame, edited: DataFrame, doubtful: DataFrame) -> DataFrame:
    """meeting_id, surface, fault: abbreviations that the meeting never defines and that do not stand as they were, or are not one doubtful item.

    abbreviations: meeting_id, surface, defined (boolean); edited: meeting_id, text; doubtful: meeting_id, surface.
    """
    items = doubtful.groupBy("meeting_id", "surface").agg(F.count(F.lit(1)).alias("items"))
    rows = abbreviations.where("NOT coalesce(defined, false)").join(edited.select("meeting_id", "text"), "meeting_id", "left").join(items, ["meeting_id", "surface"], "left")
    fault = F.when(~F.coalesce(F.contains("text", "surface"), F.lit(False)), "replaced").when(F.coalesce("items", F.lit(0)) != 1, "not one doubtful item")
    return rows.select("meeting_id", "surface", fault.alias("fault")).where("fault IS NOT NULL")


def lost_fragments(turns: DataFrame) -> DataFrame:
    """turns whose edited text misses one of its ``fragments`` (array): cut-off words, both sides of a conflict, undefined abbreviations."""
    return turns.withColumn("lost", missing(F.col("edited"), F.col("fragments"))).where(F.size("lost") > 0)


def speaker_changes(turns: DataFrame, edited: DataFrame) -> DataFrame:
    """meeting_id, turn_no, speaker, edited_speaker: turns whose speaker was changed.

    turns, edited: meeting_id, turn_no, speaker. Deleted turns do not count.
    """
    other = edited.select("meeting_id", "turn_no", F.col("speaker").alias("edited_speaker"))
    return turns.select("meeting_id", "turn_no", "speaker").join(other, ["meeting_id", "turn_no"]).where(~F.col("speaker").eqNullSafe(F.col("edited_speaker")))


def longer_minutes(notes: DataFrame) -> DataFrame:
    """The notes whose minutes are longer than the reference text that they are derived from, or that lack one of the two."""
    return notes.where(F.col("reference").isNull() | F.col("minutes").isNull() | (F.length("minutes") > F.length("reference")))


def disposition_faults(candidates: DataFrame) -> DataFrame:
    """candidate_id, fault: unknown dispositions, and doubtful items for what is not doubtful or none for what is."""
    doubtful = F.col("disposition") == "genuinely_doubtful"
    fault = F.when(~F.coalesce(F.col("disposition").isin(*DISPOSITIONS), F.lit(False)), "unknown disposition").when(doubtful != (F.col("doubtful_items") > 0), "doubtful items do not fit")
    return candidates.select("candidate_id", fault.alias("fault")).where("fault IS NOT NULL")
