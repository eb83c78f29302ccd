"""Queries of decisions, scores, sources and sinks over the driver's tables; they register with those of queries.py.

Stand-ins follow from rows by arithmetic, with faults of every kind; their SQL states the rule by itself.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.operators import decisions, edits, notes, validation
from turnloom.plans.queries import CATALOG, EDITS, TURNS, _catalog, _edits, _turns, _view, query
from turnloom.session import shared_folder
from turnloom.sources import materials, sinks

ROWS = "numbered AS (SELECT meeting_id, turn_no, meeting_id * 1000 + turn_no AS id, text FROM turns)"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# decisions

REPAIRS = """repairs AS (
  SELECT id AS repair_id, text AS source, CASE WHEN id % 5 = 0 THEN 'not there' ELSE substr(text, 1, 4) END AS old_span, CASE WHEN id % 7 = 0 THEN 'else' ELSE 'mended' END AS new_span,
    concat('mended', substr(text, 5), CASE WHEN id % 3 = 0 THEN ' surely' ELSE '' END) AS edited, concat('surely|', substr(text, 6, 3)) AS forbidden
  FROM numbered
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {REPAIRS}, checked AS (
  SELECT repair_id, CASE WHEN NOT contains(source, old_span) THEN 'span not in source' WHEN NOT contains(edited, new_span) THEN 'repair not in result'
    WHEN len(list_filter(string_split(forbidden, '|'), lambda p: contains(edited, p) AND NOT contains(source, p))) > 0 THEN 'forbidden addition' END AS fault FROM repairs
) SELECT * FROM checked WHERE fault IS NOT NULL
""")
def repair_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of what is not there, that are not in the result, or that add what is forbidden."""
    return decisions.repair_violations(_view(spark, sf_dir, "repairs", TURNS, ROWS, REPAIRS).withColumn("forbidden", F.split("forbidden", "[|]")))


CHANGES = "changes AS (SELECT id AS change_id, CASE id % 8 WHEN 0 THEN 'identity' WHEN 1 THEN 'category' WHEN 2 THEN 'action' WHEN 3 THEN 'attribute' WHEN 4 THEN 'scope' WHEN 5 THEN 'strength' WHEN 6 THEN 'grammar' END AS kind FROM numbered)"
EVIDENCE = "evidence AS (SELECT id AS change_id, id % 5 < 2 AS in_meeting FROM numbered WHERE id % 3 <> 0)"


@query(f"WITH {TURNS}, {ROWS}, {CHANGES}, {EVIDENCE} SELECT change_id FROM changes WHERE kind <> 'grammar' AND NOT EXISTS (SELECT 1 FROM evidence e WHERE e.change_id = changes.change_id AND in_meeting)")
def unproven_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of facts without evidence from the meeting."""
    return decisions.unproven_changes(_view(spark, sf_dir, "changes", TURNS, ROWS, CHANGES), _view(spark, sf_dir, "evidence", TURNS, ROWS, EVIDENCE))


FRAGMENTS = """pieces AS (
  SELECT id, concat(substr(text, 1, 5), '|', substr(text, 8, 6), '|5亿元|500亿元') AS fragments, concat(CASE WHEN id % 3 = 0 THEN substr(text, 3) ELSE text END, ' 500亿元', CASE WHEN id % 4 = 0 THEN '' ELSE ' 5亿元' END) AS edited FROM numbered
)"""


@query(f"WITH {TURNS}, {ROWS}, {FRAGMENTS}, found AS (SELECT id, array_to_string(list_filter(string_split(fragments, '|'), lambda p: NOT contains(edited, p)), '|') AS lost FROM pieces) SELECT * FROM found WHERE lost <> ''")
def lost_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off fragments and sides of a conflict that an edit lost."""
    rows = _view(spark, sf_dir, "pieces", TURNS, ROWS, FRAGMENTS).withColumn("fragments", F.split("fragments", "[|]"))
    return decisions.lost_fragments(rows).select("id", F.array_join("lost", "|").alias("lost"))


YEARS = """years AS (
  SELECT id AS decision_id, CASE id % 5 WHEN 0 THEN '一九年' WHEN 1 THEN '八七年全年' WHEN 2 THEN '24年' WHEN 3 THEN '一九个月' ELSE '〇五年' END AS spoken,
    CASE id % 3 WHEN 0 THEN '2019年' WHEN 1 THEN '1987年全年' ELSE '2024年' END AS written, id % 7 <> 0 AS certain FROM numbered
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {YEARS}, read AS (SELECT *, CASE WHEN regexp_matches(spoken, '^[〇一二三四五六七八九0-9][〇一二三四五六七八九0-9]年') THEN translate(substr(spoken, 1, 2), '〇一二三四五六七八九', '0123456789') END AS digits FROM years), checked AS (
  SELECT decision_id, CASE WHEN digits IS NULL THEN 'no two-digit year' WHEN NOT certain THEN 'context leaves a doubt' WHEN NOT (starts_with(written, concat('20', digits, '年')) OR starts_with(written, concat('19', digits, '年'))) THEN 'other digits' END AS fault FROM read
) SELECT * FROM checked WHERE fault IS NOT NULL
""")
def year_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoken years written with other digits or against a doubt."""
    return decisions.year_faults(_view(spark, sf_dir, "years", TURNS, ROWS, YEARS))


METRICS = """metrics AS (
  SELECT id AS decision_id, definition, short, restored, CASE id % 4 WHEN 0 THEN concat(definition, ', ', short) WHEN 1 THEN concat(short, ', ', definition) WHEN 2 THEN concat(text, definition, text, short) ELSE text END AS sentence
  FROM (SELECT id, text, 'profit without single gains' AS definition, 'profgain' AS short, CASE id % 3 WHEN 0 THEN 'profit gains' WHEN 1 THEN 'gain profit' ELSE 'profits' END AS restored FROM numbered) x
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {METRICS}, checked AS (
  SELECT decision_id, CASE WHEN NOT contains(sentence, definition) THEN 'no definition' WHEN NOT contains(substr(sentence, position(definition IN sentence) + length(definition)), short) THEN 'not behind its definition'
    WHEN definition NOT LIKE concat('%', array_to_string(regexp_extract_all(restored, '.'), '%'), '%') THEN 'not of the definition' END AS fault FROM metrics
) SELECT * FROM checked WHERE fault IS NOT NULL
""")
def metric_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics restored without a definition, or with characters that it does not have."""
    return decisions.metric_faults(_view(spark, sf_dir, "metrics", TURNS, ROWS, METRICS))


NUMBERS = """numbers AS (
  SELECT id AS decision_id, concat(turn_no, '.5') AS number, id % 2 = 0 AS unit_missing, CASE WHEN id % 3 = 0 THEN 'preserve_source' ELSE 'genuinely_doubtful' END AS disposition,
    concat(turn_no, '.5', CASE id % 5 WHEN 0 THEN '%' WHEN 1 THEN '个百分点' ELSE '' END, ' ', text) AS edited FROM numbered
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {NUMBERS}, checked AS (
  SELECT decision_id, CASE WHEN unit_missing AND disposition <> 'genuinely_doubtful' THEN 'missing unit is not doubtful' WHEN unit_missing AND NOT regexp_matches(edited, concat('^', replace(number, '.', '[.]'), ' ')) THEN 'unit was supplied'
    WHEN NOT unit_missing AND disposition = 'genuinely_doubtful' THEN 'complete number is doubtful' END AS fault FROM numbers
) SELECT * FROM checked WHERE fault IS NOT NULL
""")
def unit_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers without a unit that got one or are not doubtful, and complete ones that are."""
    return decisions.unit_faults(_view(spark, sf_dir, "numbers", TURNS, ROWS, NUMBERS))


COMPRESSED = """compressed AS (
  SELECT id, concat(substr(text, 1, 12), '|', substr(text, 3, 5), '|not bought') AS required, 'bought|sold' AS forbidden,
    concat(CASE WHEN id % 4 = 0 THEN substr(text, 5) ELSE text END, CASE id % 3 WHEN 0 THEN ' not bought' WHEN 1 THEN ' not bought, bought' ELSE ' sold' END) AS minutes FROM numbered
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {COMPRESSED}, parts AS (
  SELECT id, minutes, list_sort(list_filter(string_split(required, '|'), lambda p: NOT contains(minutes, p))) AS lost, string_split(required, '|') AS r, string_split(forbidden, '|') AS f FROM compressed
), masked AS (SELECT id, lost, list_sort(list_filter(f, lambda p: contains(replace(replace(replace(minutes, r[1], '~'), r[3], '~'), r[2], '~'), p))) AS added FROM parts)
SELECT id, array_to_string(lost, '|') AS lost, array_to_string(added, '|') AS added FROM masked WHERE len(lost) > 0 OR len(added) > 0
""")
def compression_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes that lost a required phrase or gained a forbidden one; "not bought" is not "bought"."""
    rows = _view(spark, sf_dir, "compressed", TURNS, ROWS, COMPRESSED).withColumns({c: F.split(c, "[|]") for c in ("required", "forbidden")})
    return decisions.compression_faults(rows).select("id", F.array_join("lost", "|").alias("lost"), F.array_join("added", "|").alias("added"))


ABBREVIATIONS = "abbreviations AS (SELECT meeting_id, concat('AB', turn_no) AS surface, CASE turn_no % 3 WHEN 0 THEN true WHEN 1 THEN false END AS defined FROM turns)"
REPLACED = "replaced AS (SELECT meeting_id, string_agg(CASE WHEN (meeting_id + turn_no) % 4 = 0 THEN 'monthly users' ELSE concat('AB', turn_no, '.') END, '' ORDER BY turn_no) AS text FROM turns GROUP BY meeting_id)"
DOUBTFUL = "doubtful AS (SELECT meeting_id, concat('AB', turn_no) AS surface FROM turns JOIN (SELECT 0 AS k UNION ALL SELECT 1) x ON k < (meeting_id + turn_no) % 3)"


@query(f"""
WITH {TURNS}, {ABBREVIATIONS}, {REPLACED}, {DOUBTFUL}, checked AS (
  SELECT meeting_id, surface, CASE WHEN NOT contains((SELECT text FROM replaced r WHERE r.meeting_id = a.meeting_id), surface) THEN 'replaced'
    WHEN (SELECT count(*) FROM doubtful d WHERE d.meeting_id = a.meeting_id AND d.surface = a.surface) <> 1 THEN 'not one doubtful item' END AS fault FROM abbreviations a WHERE defined IS NOT TRUE
) SELECT * FROM checked WHERE fault IS NOT NULL
""")
def abbreviation_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviations that nobody defined and that were replaced or not listed once."""
    view = lambda name, part: _view(spark, sf_dir, name, TURNS, part)
    return decisions.abbreviation_faults(view("abbreviations", ABBREVIATIONS), view("replaced", REPLACED), view("doubtful", DOUBTFUL))


DISPOSED = "disposed AS (SELECT id AS candidate_id, CASE id % 4 WHEN 0 THEN 'genuinely_doubtful' WHEN 1 THEN 'normal_copyedit' WHEN 2 THEN 'guessed' END AS disposition, id % 3 AS doubtful_items FROM numbered)"


@query(f"""
WITH {TURNS}, {ROWS}, {DISPOSED}, checked AS (
  SELECT candidate_id, CASE WHEN disposition IS NULL OR disposition = 'guessed' THEN 'unknown disposition' WHEN disposition = 'genuinely_doubtful' AND doubtful_items = 0 OR disposition <> 'genuinely_doubtful' AND doubtful_items > 0 THEN 'doubtful items do not fit' END AS fault FROM disposed
) SELECT * FROM checked WHERE fault IS NOT NULL
""")
def disposition_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown dispositions, and doubtful items that do not fit theirs."""
    return decisions.disposition_faults(_view(spark, sf_dir, "disposed", TURNS, ROWS, DISPOSED))


LOGGED = "logged AS (SELECT meeting_id, turn_no, substr(text, 1, 6) AS old, CASE turn_no % 3 WHEN 0 THEN substr(text, 1, 6) WHEN 1 THEN 'new' END AS new, CASE WHEN turn_no % 2 = 0 THEN 'said again' END AS evidence FROM turns)"


@query(f"WITH {TURNS}, {LOGGED} SELECT meeting_id, 'changes' AS section, turn_no AS ord, concat('- ', old, ' → ', new, CASE WHEN evidence IS NOT NULL THEN concat('（', evidence, '）') ELSE '' END) AS md FROM logged WHERE old <> new")
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the log of visible corrections."""
    return notes.change_items(_view(spark, sf_dir, "logged", TURNS, LOGGED))


# scores

CASES = """cases AS (
  SELECT id, text AS source, CASE id % 3 WHEN 0 THEN 'genuinely_doubtful' ELSE 'normal_copyedit' END AS expected_disposition, CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS expected_doubtful_items, CASE WHEN id % 6 = 0 THEN 2 END AS expected_external_search_rounds,
    CASE WHEN id % 3 = 0 THEN concat(substr(text, 1, 5), ' / never said') ELSE substr(text, 2, 6) END AS candidate, CASE WHEN id % 3 = 0 THEN '保留并列疑' ELSE substr(text, 2, 6) END AS expected_rendering, concat('confirmed|', substr(text, 1, 3)) AS forbidden_additions
  FROM numbered
)"""
OUTPUTS = """outputs AS (
  SELECT id, CASE id % 5 WHEN 0 THEN 'genuinely_doubtful' WHEN 1 THEN 'normal_copyedit' ELSE CASE id % 3 WHEN 0 THEN 'genuinely_doubtful' ELSE 'normal_copyedit' END END AS disposition,
    CASE id % 7 WHEN 0 THEN '' WHEN 1 THEN concat(text, ' confirmed') WHEN 2 THEN 'never said' ELSE text END AS rendering, CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 1 ELSE 0 END AS doubtful_items, CASE WHEN id % 13 <> 0 THEN 1 + id % 4 % 3 END AS search_rounds
  FROM numbered
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {CASES}, {OUTPUTS}, judged AS (
  SELECT id, coalesce(disposition = expected_disposition, false) AS disposition_ok, coalesce(doubtful_items = expected_doubtful_items, false) AS items_ok, coalesce(search_rounds <= coalesce(expected_external_search_rounds, 1), false) AS rounds_ok,
    CASE WHEN expected_disposition = 'genuinely_doubtful' THEN contains(rendering, split_part(candidate, ' / ', 1)) ELSE contains(rendering, expected_rendering) END AS rendering_ok, NOT contains(source, 'confirmed') AND contains(rendering, 'confirmed') AS added
  FROM cases JOIN outputs USING (id)
) SELECT id, disposition_ok, items_ok, rounds_ok, rendering_ok, CASE WHEN added THEN 'confirmed' ELSE '' END AS forbidden, disposition_ok AND items_ok AND rounds_ok AND rendering_ok AND NOT added AS passed FROM judged
""")
def doubtful_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of adjudication cases against outputs that are right, wrong or missing in each way."""
    cases = _view(spark, sf_dir, "cases", TURNS, ROWS, CASES).withColumn("forbidden_additions", F.split("forbidden_additions", "[|]"))
    return validation.score_doubtful(cases, _view(spark, sf_dir, "outputs", TURNS, ROWS, OUTPUTS)).withColumn("forbidden", F.array_join("forbidden", "|"))


DENSITY = "density AS (SELECT id, text AS source, concat(substr(text, 1, 8), '|not bought') AS needed, 'bought|sold' AS forbidden_additions FROM numbered)"
DENSE_OUTPUTS = """dense AS (
  SELECT id, concat(CASE WHEN id % 4 = 0 THEN '' ELSE substr(text, 1, 8) END, ' not bought', CASE WHEN id % 5 = 0 THEN ' sold' ELSE '' END) AS minutes, CASE WHEN id % 7 = 0 THEN text ELSE concat(text, ', not bought', CASE WHEN id % 6 = 0 THEN ', bought' ELSE '' END) END AS reference FROM numbered
)"""


@query(f"""
WITH {TURNS}, {ROWS}, {DENSITY}, {DENSE_OUTPUTS}, parts AS (SELECT *, string_split(needed, '|') AS r, concat(minutes, chr(10), reference) AS both_texts FROM density JOIN dense USING (id)), judged AS (
  SELECT id, array_to_string(list_filter(r, lambda p: NOT contains(minutes, p)), '|') AS minutes_missing, array_to_string(list_filter(r, lambda p: NOT contains(reference, p)), '|') AS reference_missing,
    array_to_string(list_filter(['bought', 'sold'], lambda p: contains(CASE WHEN length(r[1]) >= length(r[2]) THEN replace(replace(both_texts, r[1], '~'), r[2], '~') ELSE replace(replace(both_texts, r[2], '~'), r[1], '~') END, p)), '|') AS forbidden,
    length(minutes) < length(reference) AS shorter, reference = source AS copied FROM parts
) SELECT *, minutes_missing = '' AND reference_missing = '' AND forbidden = '' AND shorter AND NOT copied AS passed FROM judged
""")
def density_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of density cases against outputs with phrases lost and added."""
    cases = _view(spark, sf_dir, "density", TURNS, ROWS, DENSITY).select("id", "source", *[F.split("needed", "[|]").alias(f"expected_{x}_required") for x in ("minutes", "reference")], F.split("forbidden_additions", "[|]").alias("forbidden_additions"))
    scores = validation.score_density(cases, _view(spark, sf_dir, "dense", TURNS, ROWS, DENSE_OUTPUTS))
    return scores.withColumns({c: F.array_join(c, "|") for c in ("minutes_missing", "reference_missing", "forbidden")})


# sources and sinks: written to the shared folder, read by the readers

WHOLE = "whole AS (SELECT meeting_id, string_agg(text, '' ORDER BY turn_no) AS body FROM turns GROUP BY meeting_id)"


@query(f"WITH {TURNS}, {WHOLE} SELECT concat(chr(65279), body, chr(10)) AS written, concat(body, chr(10)) AS body FROM whole")
def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of meetings written as one text file each, with a byte order mark, and read back without it."""
    folder = _folder(spark, "texts")
    _view(spark, sf_dir, "whole", TURNS, WHOLE).select(F.concat(F.lit("﻿"), "body")).write.option("maxRecordsPerFile", 1).text(folder)
    return materials.read_texts(spark, folder).select(F.concat(F.lit("﻿"), "body").alias("written"), "body")


TIMED = "timed AS (SELECT concat('m', meeting_id) AS meeting_id, turn_no, CASE WHEN turn_no % 4 <> 0 THEN speaker END AS speaker, turn_no * 1000 AS start_ms, turn_no * 1000 + length(text) AS end_ms, text FROM turns)"


@query(f"WITH {TURNS}, {TIMED} SELECT * FROM timed")
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recogniser's rows with their timeline, from JSON lines."""
    folder = _folder(spark, "transcripts")
    _view(spark, sf_dir, "timed", TURNS, TIMED).write.json(folder)
    return materials.read_transcripts(spark, folder)


@query(f"WITH {CATALOG} SELECT DISTINCT name, code, 'csv' AS format FROM catalog UNION ALL SELECT DISTINCT name, code, 'parquet' FROM catalog")
def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog from CSV and from Parquet."""
    csv, parquet = _folder(spark, "catalog"), f"{_folder(spark, 'catalog')}.parquet"
    twice = _catalog(spark, sf_dir).unionAll(_catalog(spark, sf_dir))
    twice.write.option("header", True).csv(csv)
    twice.write.parquet(parquet)
    return materials.read_catalog(spark, csv).withColumn("format", F.lit("csv")).unionByName(materials.read_catalog(spark, parquet).withColumn("format", F.lit("parquet")))


RESULTS = "results AS (SELECT text AS query, CAST(1 AS INTEGER) AS round, speaker AS title, concat('http://host/', turn_no) AS url, CASE WHEN turn_no % 2 = 0 THEN text END AS snippet FROM turns)"


@query(f"WITH {TURNS}, {RESULTS} SELECT * FROM results")
def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of searches made outside, from JSON lines."""
    folder = _folder(spark, "results")
    _view(spark, sf_dir, "results", TURNS, RESULTS).write.json(folder)
    return materials.read_search_results(spark, folder)


@query(f"WITH {TURNS}, {ROWS}, {DENSITY} SELECT id, source, needed, 0 AS n_removable, forbidden_additions FROM density")
def case_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density cases from a JSON document; a field that no case has is null."""
    folder = _folder(spark, "cases")
    cases = _view(spark, sf_dir, "density", TURNS, ROWS, DENSITY).select(F.col("id").cast("string"), "source", *[F.split("needed", "[|]").alias(f"expected_{x}_required") for x in ("minutes", "reference")], F.split("forbidden_additions", "[|]").alias("forbidden_additions"))
    cases.select(F.lit("1").alias("schema_version"), F.lit("").alias("description"), F.array(F.struct("*")).alias("cases")).write.option("maxRecordsPerFile", 1).json(folder)
    read = materials.read_density_cases(spark, folder)
    return read.select(F.col("id").cast("long").alias("id"), "source", F.array_join("expected_reference_required", "|").alias("needed"), F.coalesce(F.size("minutes_may_remove"), F.lit(0)).alias("n_removable"), F.array_join("forbidden_additions", "|").alias("forbidden_additions"))


TYPED = "typed AS (SELECT DISTINCT meeting_id, CASE meeting_id % 4 WHEN 0 THEN 'review' WHEN 1 THEN 'company call' WHEN 2 THEN 'unheard of' END AS meeting_type FROM turns)"
TEMPLATES = "templates AS (SELECT 'review' AS meeting_type, '# points' AS template UNION ALL SELECT 'company call', '# questions' UNION ALL SELECT 'expert call', '# views')"


@query(f"WITH {TURNS}, {TYPED}, {TEMPLATES} SELECT meeting_id, meeting_type, template FROM typed LEFT JOIN templates USING (meeting_type)")
def meeting_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The template of each meeting's type; none for an unknown type."""
    return notes.with_templates(_view(spark, sf_dir, "typed", TURNS, TYPED), _view(spark, sf_dir, "templates", TEMPLATES)).select("meeting_id", "meeting_type", "template")


@query(f"""
WITH {TURNS}, {EDITS}, faults AS (SELECT meeting_id, turn_no FROM edits WHERE action = 'delete' AND trim(coalesce(reason, '')) = '')
SELECT meeting_id, turn_no, (SELECT count(*) FROM faults) AS n FROM faults
""")
def process_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The process record as JSON lines, with the number that its summary states."""
    folder, faults = _folder(spark, "process"), edits.unreasoned_deletions(_edits(spark, sf_dir))
    summary = json.loads(sinks.write_process(faults, folder, faults.agg(F.count(F.lit(1)).alias("n"))))
    return spark.read.schema("meeting_id long, turn_no long").json(folder).withColumn("n", F.lit(summary["n"]).cast("long"))


@query(f"WITH {TURNS} SELECT meeting_id, turn_no, text, false AS unasked FROM turns")
def archive_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive that was asked for; one that was not asked for is not there."""
    folder, rows = _folder(spark, "archive"), _turns(spark, sf_dir).select("meeting_id", "turn_no", "text")
    asked, unasked = sinks.export_archive(rows, folder, True), sinks.export_archive(rows, f"{folder}-unasked", False)
    assert asked
    return spark.read.parquet(folder).withColumn("unasked", F.lit(unasked))


@query(f"WITH {TURNS}, {EDITS} SELECT count(*) AS n_faults, count(*) = 0 AS ok FROM edits WHERE action = 'delete' AND trim(coalesce(reason, '')) = ''")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the validator's JSON states."""
    report = json.loads(sinks.validation_json(edits.unreasoned_deletions(_edits(spark, sf_dir)), most=3))
    return spark.range(1).select(F.lit(report["n_faults"]).cast("long").alias("n_faults"), F.lit(report["ok"]).alias("ok"))
