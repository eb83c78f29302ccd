"""Names and codes: local lookup, one combined search, and what it takes to resolve an identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def relevant(candidates: DataFrame) -> DataFrame:
    """The candidates whose check would change text; no others are looked up."""
    return candidates.where("changes_text")


def _named(catalog: DataFrame) -> DataFrame:
    """name, n_codes, code: each name of the catalog once; the code is null where the name has none or several."""
    found = catalog.where("name IS NOT NULL").groupBy("name").agg(F.count_distinct("code").alias("n_codes"), F.min("code").alias("least"))
    return found.select("name", "n_codes", F.when(F.col("n_codes") == 1, F.col("least")).alias("code"))


def exact_matches(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """candidate_id, name, code, n_codes, matched_by: catalog entries that have the candidate's surface as their name or code.

    A name with several codes is one row with their number and no code: none of the rivals is preferred. A code matches
    whole ("code") or without its suffix ("bare_code"). Surfaces meet entries once; candidates are joined back to them.
    """
    surfaces = candidates.where("surface IS NOT NULL").select("surface").distinct()
    by_name = surfaces.join(_named(catalog), F.col("surface") == F.col("name")).select("surface", "name", "code", "n_codes", F.lit("name").alias("matched_by"))
    codes = catalog.where("code IS NOT NULL").select("name", "code").distinct()
    spelled = codes.select("*", F.col("code").alias("spelled"), F.lit("code").alias("matched_by")).unionByName(
        codes.where(F.contains("code", F.lit("."))).select("*", F.substring_index("code", ".", 1).alias("spelled"), F.lit("bare_code").alias("matched_by"))
    )
    by_code = surfaces.join(spelled, F.col("surface") == F.col("spelled")).select("surface", "name", "code", F.lit(1).cast("long").alias("n_codes"), "matched_by")
    return candidates.select("candidate_id", "surface").join(by_name.unionByName(by_code), "surface").select("candidate_id", "name", "code", "n_codes", "matched_by")


def _deletions(text: Column, most: int) -> Column:
    """The text and all that is left of it with up to that many characters deleted."""
    found = F.array(text)
    for _ in range(most):
        shorter = F.transform(found, lambda t: F.when(F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t)), lambda k: F.concat(F.substring(t, F.lit(1), k - 1), F.substring(t, k + 1, F.length(t))))).otherwise(F.array().cast("array<string>")))
        found = F.array_distinct(F.concat(found, F.flatten(shorter)))
    return found


def near_matches(candidates: DataFrame, catalog: DataFrame, distance: int = 1) -> DataFrame:
    """candidate_id, name, code, n_codes, distance: catalog names within an edit distance of the surface (not equal to it).

    Two texts within the distance have a form in common that is left when up to so many characters are deleted from each.
    Distinct surfaces and distinct names meet on such forms by equality and are verified; candidates are joined back
    last. A near name proves nothing; one with several codes is one row without a code.
    """
    probes = candidates.where("surface IS NOT NULL").select("surface").distinct().select("surface", F.explode(_deletions(F.col("surface"), distance)).alias("left"))
    index = catalog.where("name IS NOT NULL").select("name").distinct().select("name", F.explode(_deletions(F.col("name"), distance)).alias("left"))
    met = probes.join(index, "left").select("surface", "name").distinct().withColumn("distance", F.levenshtein("surface", "name").cast("long")).where(F.col("distance").between(1, distance))
    return candidates.select("candidate_id", "surface").join(met.join(_named(catalog), "name"), "surface").select("candidate_id", "name", "code", "n_codes", "distance")


def readings(surfaces: DataFrame, char_reading: DataFrame) -> DataFrame:
    """candidate_id, reading: all full readings of a surface, characters without one left as they are.

    char_reading: char, reading (several rows for a character with several). Readings widen a search and confirm nothing.
    """
    known = char_reading.groupBy("char").agg(F.sort_array(F.collect_set("reading")).alias("ways"))
    chars = surfaces.select("candidate_id", F.posexplode(F.split("surface", "(?!^)")).alias("place", "char"))
    rows = chars.join(known, "char", "left").select("candidate_id", "place", F.coalesce("ways", F.array("char")).alias("ways"))
    lists = rows.groupBy("candidate_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "ways"))), lambda x: x["ways"]).alias("ways"))
    joined = F.aggregate("ways", F.array(F.lit("")), lambda done, ways: F.flatten(F.transform(done, lambda d: F.transform(ways, lambda w: F.trim(F.concat(d, F.lit(" "), w))))))
    return lists.select("candidate_id", F.explode(joined).alias("reading"))


def search_plan(candidates: DataFrame, variants: DataFrame, most_variants: int = 4) -> DataFrame:
    """candidate_id, query, round: one combined query per important candidate that is no person: the name, a few variants, the full reading.

    candidates: candidate_id, surface, is_person, changes_text; variants: candidate_id, variant, kind (sound, shape or
    reading). Only names reach the query: persons and meeting text have no column in it. All queries belong to one round.
    """
    wanted = relevant(candidates).where(~F.coalesce("is_person", F.lit(True))).select("candidate_id", "surface")
    close = F.slice(F.array_sort(F.collect_set(F.when(F.col("kind").isin("sound", "shape"), F.col("variant")))), 1, most_variants).alias("close")
    full = F.array_sort(F.collect_set(F.when(F.col("kind") == "reading", F.col("variant")))).alias("full")
    grouped = variants.groupBy("candidate_id").agg(close, full)
    terms = F.array_distinct(F.concat(F.array("surface"), *[F.coalesce(c, F.array().cast("array<string>")) for c in ("close", "full")]))
    return wanted.join(grouped, "candidate_id", "left").select("candidate_id", F.array_join(terms, " OR ").alias("query"), F.lit(1).alias("round"))


def one_round(plan: DataFrame, meetings: DataFrame) -> DataFrame:
    """meeting_id, n_queries, query: the single external round of a meeting, all unresolved names together.

    meetings: candidate_id, meeting_id.
    """
    rows = plan.join(meetings.select("candidate_id", "meeting_id"), "candidate_id")
    grouped = rows.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct("candidate_id", "query"))).alias("all"))
    return grouped.select("meeting_id", F.size("all").cast("long").alias("n_queries"), F.array_join(F.transform("all", lambda x: F.concat(F.lit("("), x["query"], F.lit(")"))), " ").alias("query"))


def surplus_rounds(searches: DataFrame) -> DataFrame:
    """meeting_id, rounds: meetings with more than one external round."""
    return searches.groupBy("meeting_id").agg(F.max("round").alias("rounds")).where("rounds > 1")


def leaks(queries: DataFrame, persons: DataFrame, allowed: DataFrame) -> DataFrame:
    """query_id, term: terms of outgoing queries that are a person's name or are not on the list of what may go out.

    queries: query_id, terms (array); persons: name; allowed: term.
    """
    terms = queries.select("query_id", F.explode("terms").alias("term")).distinct()
    unknown = terms.join(allowed.select("term"), "term", "left_anti")
    named = terms.join(persons.select(F.col("name").alias("term")), "term", "left_semi")
    return unknown.select("query_id", "term").unionByName(named.select("query_id", "term")).distinct()


#: What counts as evidence from the meeting, and which kinds together prove an identity. A near name, a single public
#: match, a business relation or a reading alone does not.
ANCHORS = ("code", "role", "repeated_name", "definition", "self_correction")
PROOFS = (("name", "code", "role"), ("reading", "repeated_name"), ("definition",), ("self_correction",))


def proven_forms(anchors: DataFrame) -> DataFrame:
    """candidate_id, form, code (may be null), precedence: forms for which all kinds of one of the PROOFS are there.

    anchors: candidate_id, kind, form, code, precedence, in_meeting. The kinds in ANCHORS count only from the meeting
    itself; "name" and "reading" are matches of the whole name or its whole reading with a catalog. The precedence is the
    highest one of an anchor that counts.
    """
    counts = F.when(F.col("kind").isin(*ANCHORS), F.coalesce("in_meeting", F.lit(False))).otherwise(F.lit(True))
    kinds = F.collect_set(F.when(counts, F.col("kind"))).alias("kinds")
    found = anchors.where("form IS NOT NULL").groupBy("candidate_id", "form").agg(kinds, F.max("code").alias("code"), F.max(F.when(counts, F.col("precedence"))).alias("precedence"))
    proof = F.lit(False)
    for needed in PROOFS:
        proof = proof | (F.size(F.array_except(F.array(*[F.lit(k) for k in needed]), F.col("kinds"))) == 0)
    return found.where(proof).select("candidate_id", "form", "code", "precedence")


def unanchored(resolutions: DataFrame, anchors: DataFrame) -> DataFrame:
    """candidate_id: identities that were resolved without a proof."""
    return resolutions.where(F.col("disposition") == "resolved_identity").join(proven_forms(anchors), "candidate_id", "left_anti").select("candidate_id")


def resolved(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidate_id, form, code (may be null): the proven form with the highest precedence, where no equal rival remains.

    A correction in the meeting has precedence over a title. Two proven forms with the highest precedence leave the
    candidate unresolved.
    """
    proven = proven_forms(anchors)
    best = proven.groupBy("candidate_id").agg(F.max("precedence").alias("best"))
    top = proven.join(best, "candidate_id").where("precedence <=> best").groupBy("candidate_id").agg(F.count(F.lit(1)).alias("n"), F.min("form").alias("form"), F.max("code").alias("code"))
    return top.where("n = 1").join(candidates.select("candidate_id"), "candidate_id").select("candidate_id", "form", "code")
