"""Checks of finished notes and scores of evaluation cases. Developer tools; no production step calls them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import has_han, masked, missing, present
from turnloom.operators.notes import ALWAYS, SECTIONS


def utf8_check(files: DataFrame, require_cjk: bool = False) -> DataFrame:
    """path, valid_utf8, has_cjk, ok for binary content (path, content)."""
    valid = F.coalesce(F.is_valid_utf8(F.col("content").cast("string")), F.lit(False))
    cjk = valid & has_han(F.try_validate_utf8(F.col("content").cast("string")))
    return files.select("path", valid.alias("valid_utf8"), cjk.alias("has_cjk"), (valid & (cjk if require_cjk else F.lit(True))).alias("ok"))


def structure_faults(notes: DataFrame, headings: tuple[tuple[str, str], ...] = SECTIONS, always: tuple[str, ...] = ALWAYS) -> DataFrame:
    """meeting_id, fault, heading: missing, repeated, unknown and misplaced second-level headings of notes (meeting_id, md).

    What stands between code fences (three backticks) is no heading; a fence without an end runs to the end of the note.
    """
    titles = [t for _, t in headings]
    bare = F.regexp_replace(F.coalesce("md", F.lit("")), r"(?s)(?:^|(?<=\n))```.*?(?:\n```[^\n]*|\z)", "")
    found = notes.select("meeting_id", F.regexp_extract_all(bare, F.lit(r"(?m)^##[ \t]+(.+?)[ \t]*$"), F.lit(1)).alias("found"))
    known = F.array(*[F.lit(t) for t in titles])
    lacking = F.transform(F.array_except(F.array(*[F.lit(t) for n, t in headings if n in always]), "found"), lambda t: F.struct(F.lit("missing").alias("fault"), t.alias("heading")))
    unknown = F.transform(F.array_except("found", known), lambda t: F.struct(F.lit("unknown").alias("fault"), t.alias("heading")))
    twice = F.transform(F.filter(F.array_distinct("found"), lambda t: F.size(F.filter("found", lambda x: x == t)) > 1), lambda t: F.struct(F.lit("repeated").alias("fault"), t.alias("heading")))
    ranks = F.transform(F.filter("found", lambda t: F.array_contains(known, t)), lambda t: F.array_position(known, t).cast("int"))
    misplaced = F.transform(F.filter(F.sequence(F.lit(1), F.size(ranks)), lambda k: (k > 1) & (F.get(ranks, k - 1) < F.get(ranks, k - 2))), lambda k: F.struct(F.lit("misplaced").alias("fault"), F.get(known, F.get(ranks, k - 1) - 1).alias("heading")))
    return found.select("meeting_id", F.inline(F.concat(lacking, unknown, twice, misplaced)))


def score_density(cases: DataFrame, outputs: DataFrame) -> DataFrame:
    """id, minutes_missing, reference_missing, forbidden, shorter, copied, passed: density cases against outputs (id, minutes, reference).

    Required phrases are taken out before forbidden ones are searched for: one may contain another whose negation is
    what matters. minutes_may_remove is a permission and is not asked for. Copying the source is no pass.
    """
    rows = cases.join(outputs, "id")
    both = F.concat_ws("\n", "minutes", "reference")
    forbidden = present(masked(both, F.concat("expected_minutes_required", "expected_reference_required")), F.col("forbidden_additions"))
    rows = rows.select(
        "id", missing(F.col("minutes"), F.col("expected_minutes_required")).alias("minutes_missing"), missing(F.col("reference"), F.col("expected_reference_required")).alias("reference_missing"),
        forbidden.alias("forbidden"), (F.length("minutes") < F.length("reference")).alias("shorter"), (F.col("reference") == F.col("source")).alias("copied"),
    )
    return rows.withColumn("passed", (F.size("minutes_missing") == 0) & (F.size("reference_missing") == 0) & (F.size("forbidden") == 0) & F.col("shorter") & ~F.col("copied"))


#: Fixed by the cases' format: how an expected rendering begins that says what to keep instead of being the text.
_INSTRUCTION = "^(参考原文|原样|同时)?保留"


def score_doubtful(cases: DataFrame, outputs: DataFrame) -> DataFrame:
    """id, disposition_ok, items_ok, rounds_ok, rendering_ok, forbidden, passed: adjudication cases against outputs (id, disposition, rendering, doubtful_items, search_rounds).

    A literal expected rendering must be in the output's. Where it says what to keep, the candidate's forms (parted by
    " / ") that the source has must be there. What is missing from an output is not right.
    """
    rows = cases.join(outputs, "id")
    forbidden: Column = F.filter(present(F.col("rendering"), F.col("forbidden_additions")), lambda p: ~F.contains(F.col("source"), p))
    kept = F.filter(F.split("candidate", " / "), lambda c: F.contains(F.col("source"), c))
    right = F.when(F.col("expected_rendering").rlike(_INSTRUCTION), F.forall(kept, lambda c: F.contains(F.col("rendering"), c)) & (F.length("rendering") > 0)).otherwise(F.contains("rendering", "expected_rendering"))
    no = F.lit(False)
    rows = rows.select(
        "id", F.coalesce(F.col("disposition") == F.col("expected_disposition"), no).alias("disposition_ok"), F.coalesce(F.col("doubtful_items") == F.col("expected_doubtful_items"), no).alias("items_ok"),
        F.coalesce(F.col("search_rounds") <= F.coalesce("expected_external_search_rounds", F.lit(1)), no).alias("rounds_ok"), F.coalesce(right, no).alias("rendering_ok"), forbidden.alias("forbidden"),
    )
    return rows.withColumn("passed", F.col("disposition_ok") & F.col("items_ok") & F.col("rounds_ok") & F.col("rendering_ok") & (F.size("forbidden") == 0))


def phrase_hits(texts: DataFrame, phrases: DataFrame, gram: int = 12) -> DataFrame:
    """text_id, phrase_id: which texts (text_id, text) contain which phrases (phrase_id, phrase).

    Texts and phrases meet on pieces of ``gram`` code points by equality, then containment is verified, so that nothing is
    compared with everything. A phrase with a blank inside is met by the piece behind its first one, which a text offers
    for each of its words; one without (short, or in a script without blanks) by its beginning, which a text offers for
    each of its places. An empty phrase is left out.
    """
    word = r"(?s)(?<=[ \n])(?=([^ \n].{%d}))" % (gram - 1)
    inside = F.regexp_extract("phrase", word, 1)
    keyed = phrases.where(F.length("phrase") > 0).select("phrase_id", "phrase", inside.alias("inside"))
    by_word = keyed.where("inside <> ''").select("phrase_id", "phrase", F.col("inside").alias("piece"))
    by_place = keyed.where("inside = ''").select("phrase_id", "phrase", F.substring("phrase", 1, gram).alias("piece"))
    whole = texts.where("text IS NOT NULL")

    def met(offered: Column, wanted: DataFrame) -> DataFrame:
        probes = whole.select("text_id", "text", F.explode(F.array_distinct(offered)).alias("piece"))
        return probes.join(wanted, "piece").where(F.contains(F.col("text"), F.col("phrase"))).select("text_id", "phrase_id")

    found = met(F.regexp_extract_all("text", F.lit(word), F.lit(1)), by_word)
    for row in by_place.select(F.length("piece").alias("n")).distinct().collect():  # at most ``gram`` numbers
        found = found.unionByName(met(_pieces(row["n"]), by_place.where(F.length("piece") == row["n"])))
    return found.distinct()


def _pieces(n: int) -> Column:
    """All pieces of n code points of the column text."""
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("text") - n + 1))
    return F.transform(places, lambda k: F.substring(F.col("text"), k, F.lit(n)))
