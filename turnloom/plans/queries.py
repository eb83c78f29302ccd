"""Queries over the driver's tables that exercise the meeting operators, each with the same in DuckDB SQL.

The tables hold no meetings, so they stand in for them: a conversation for a meeting, its turns for speaker turns, its
roles for speakers; edits, decisions and anchors follow from the rows by arithmetic, with planted faults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions.text import UNITS, has_han, number_tokens
from turnloom.operators import decisions, edits, entities, notes, turns, validation

CAPACITY = 1500
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


# stand-ins, in Spark and in SQL

TURNS = "turns AS (SELECT conv_id AS meeting_id, turn AS turn_no, role AS speaker, text FROM conversations)"
#: Edits: every 11th turn has none, every 7th is deleted (every 14th without a reason), every 13th is returned twice, every 17th out of place.
EDITS = """edits AS (
  SELECT meeting_id, turn_no, turn_no * 10 + extra - CASE WHEN (meeting_id * 5 + turn_no) % 17 = 0 THEN 25 ELSE 0 END AS position,
    CASE WHEN (meeting_id * 3 + turn_no) % 7 = 0 THEN 'delete' WHEN turn_no % 2 = 0 THEN 'edit' ELSE 'keep' END AS action,
    CASE WHEN turn_no % 2 = 0 AND (meeting_id * 3 + turn_no) % 7 <> 0 THEN concat('[', turn_no, '] ', text) END AS text,
    CASE WHEN (meeting_id * 3 + turn_no) % 7 = 0 AND (meeting_id + turn_no) % 2 = 0 THEN 'small talk' END AS reason
  FROM turns JOIN (SELECT 0 AS extra UNION ALL SELECT 1) x ON extra = 0 OR (meeting_id * 7 + turn_no) % 13 = 0
  WHERE (meeting_id + turn_no * 3) % 11 <> 0
)"""
BODIES = """bodies AS (
  SELECT meeting_id, string_agg(concat(CASE WHEN turn_no = 0 AND meeting_id % 3 = 0 THEN '' ELSE concat('发言人', turn_no % 2 + 2, '：') END, text), '' ORDER BY turn_no) AS body
  FROM turns GROUP BY meeting_id
)"""
CATALOG = "catalog AS (SELECT p_name AS name, concat(CAST(600000 + p_partkey AS VARCHAR), '.SH') AS code FROM part)"
#: Candidates: names of parts as they are, with one letter changed or added, whole codes, or codes without their suffix.
CANDIDATES = """candidates AS (
  SELECT p_partkey AS candidate_id, p_partkey % 50 AS meeting_id,
    CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN concat('x', substr(p_name, 2)) WHEN 2 THEN concat(p_name, 's') WHEN 3 THEN concat(CAST(600000 + p_partkey AS VARCHAR), '.SH') ELSE CAST(600000 + p_partkey AS VARCHAR) END AS surface,
    p_partkey % 9 = 0 AS is_person, p_partkey % 5 <> 0 AS changes_text
  FROM part
)"""


def _spark_sql(sql: str) -> str:
    """A stand-in's DuckDB SQL as Spark's."""
    return sql.replace("VARCHAR", "STRING").replace("string_agg(", "listagg(").replace(", '' ORDER BY turn_no)", ", '') WITHIN GROUP (ORDER BY turn_no)").replace("bool_or", "some")


def _view(spark: SparkSession, sf_dir: str, name: str, *parts: str) -> DataFrame:
    """The stand-in called name, from those it builds on."""
    tables = {t: f"{sf_dir}/{t}.parquet" for t in ("conversations", "part", "documents", "benchmark") if any(f"FROM {t}" in p for p in parts)}
    reads = [f"{t} AS (SELECT * FROM parquet.`{path}`)" for t, path in tables.items()]
    return spark.sql(f"WITH {', '.join([*reads, *map(_spark_sql, parts)])} SELECT * FROM {name}")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "turns", TURNS)


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "edits", TURNS, EDITS)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "candidates", CANDIDATES)


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "catalog", CATALOG)


@query(f"""
WITH {TURNS}, {BODIES}, cut AS (
  SELECT meeting_id, unnest(string_split(regexp_replace(body, '(发言人[0-9]+：)', chr(1) || '\\1', 'g'), chr(1))) AS part,
    generate_subscripts(string_split(regexp_replace(body, '(发言人[0-9]+：)', chr(1) || '\\1', 'g'), chr(1)), 1) AS place FROM bodies
), read AS (
  SELECT meeting_id, place, nullif(regexp_extract(part, '^发言人([0-9]+)：', 1), '') AS speaker,
    trim(regexp_replace(part, '^发言人[0-9]+：', ''), ' ' || chr(9) || chr(10) || chr(13) || '　') AS text FROM cut
)
SELECT meeting_id, row_number() OVER (PARTITION BY meeting_id ORDER BY place) AS turn_no, speaker, text FROM read WHERE speaker IS NOT NULL OR text <> ''
""")
def turn_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit turns read back from bodies with inline labels, some with a preamble, none beginning at speaker 1."""
    return turns.parse_turns(_view(spark, sf_dir, "bodies", TURNS, BODIES))


_PACKED = f"""
WITH RECURSIVE {TURNS}, sized AS (
  SELECT meeting_id, turn_no, CAST(length(coalesce(text, '')) AS BIGINT) AS size, row_number() OVER (PARTITION BY meeting_id ORDER BY turn_no) AS k FROM turns
), packed AS (
  SELECT meeting_id, turn_no, size, k, CAST(1 AS BIGINT) AS pack_no, size AS used FROM sized WHERE k = 1
  UNION ALL
  SELECT s.meeting_id, s.turn_no, s.size, s.k, CASE WHEN p.used + s.size <= {CAPACITY} THEN p.pack_no ELSE p.pack_no + 1 END, CASE WHEN p.used + s.size <= {CAPACITY} THEN p.used + s.size ELSE s.size END
  FROM packed p JOIN sized s ON s.meeting_id = p.meeting_id AND s.k = p.k + 1
)"""


@query(f"{_PACKED} SELECT meeting_id, turn_no, size, pack_no, used FROM packed")
def turn_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear packs of whole turns."""
    return turns.pack_turns(_turns(spark, sf_dir), CAPACITY)


@query(f"{_PACKED} SELECT meeting_id, pack_no, count(*) AS n_turns, min(turn_no) AS first_turn, max(turn_no) AS last_turn, CAST(sum(size) AS BIGINT) AS size FROM packed GROUP BY ALL")
def pack_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each pack holds."""
    return turns.pack_summary(turn_pack(spark, sf_dir))


@query(f"WITH {TURNS} SELECT meeting_id, turn_no, CAST(sum(CASE WHEN speaker = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id ORDER BY turn_no) AS BIGINT) AS qa_no FROM turns")
def qa_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with their answers; the role stands in for the decision who asks."""
    return turns.qa_units(_turns(spark, sf_dir), F.col("speaker") == "user")


@query(f"""
WITH {TURNS}, routes AS (SELECT DISTINCT meeting_id, CASE meeting_id % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'segmented' ELSE 'unclear' END AS route FROM turns)
SELECT meeting_id, CASE WHEN route <> 'unclear' THEN route END AS route FROM routes
""")
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route of each meeting, from decisions."""
    meetings = _turns(spark, sf_dir).select("meeting_id").distinct()
    m = F.col("meeting_id") % 3
    return turns.routed(meetings, meetings.withColumn("route", F.when(m == 0, "direct").when(m == 1, "segmented").otherwise("unclear")))


#: Turns of which every third says the same, and three bodies: whole, with gaps, and with gaps and backwards.
SAID = "said AS (SELECT meeting_id, turn_no, CASE WHEN turn_no % 3 = 1 THEN 'yes' ELSE text END AS text FROM turns)"
SOURCES = """sources AS (
  SELECT meeting_id, source_id, string_agg(CASE WHEN source_id = 0 OR turn_no % 3 <> 0 THEN text ELSE '' END, chr(10) ORDER BY CASE WHEN source_id = 2 THEN -turn_no ELSE turn_no END) AS body
  FROM said, (SELECT 0 AS source_id UNION ALL SELECT 1 UNION ALL SELECT 2) x GROUP BY meeting_id, source_id
)"""


def _said(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    said = _view(spark, sf_dir, "said", TURNS, SAID)
    each = said.select("meeting_id", "turn_no", "text", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("source_id"))
    kept = F.when((F.col("source_id") == 0) | (F.col("turn_no") % 3 != 0), F.col("text")).otherwise("")
    order = F.when(F.col("source_id") == 2, -F.col("turn_no")).otherwise(F.col("turn_no"))
    sources = each.groupBy("meeting_id", "source_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), kept.alias("t")))).alias("all"))
    return said, sources.select("meeting_id", "source_id", F.array_join(F.transform("all", lambda x: x["t"]), "\n").alias("body"))


@query(f"""
WITH RECURSIVE {TURNS}, {SAID}, {SOURCES}, numbered AS (
  SELECT s.meeting_id, s.source_id, s.body, t.text, row_number() OVER (PARTITION BY s.meeting_id, s.source_id ORDER BY t.turn_no) AS k FROM sources s JOIN said t ON t.meeting_id = s.meeting_id
), walk AS (
  SELECT meeting_id, source_id, CAST(0 AS BIGINT) AS k, 1 AS begins, 0 AS found, true AS in_order FROM sources
  UNION ALL
  SELECT w.meeting_id, w.source_id, n.k, CASE WHEN position(n.text IN substr(n.body, w.begins)) > 0 THEN w.begins - 1 + position(n.text IN substr(n.body, w.begins)) + length(n.text) ELSE w.begins END,
    w.found + CASE WHEN position(n.text IN n.body) > 0 THEN 1 ELSE 0 END, w.in_order AND (position(n.text IN substr(n.body, w.begins)) > 0 OR position(n.text IN n.body) = 0)
  FROM walk w JOIN numbered n ON n.meeting_id = w.meeting_id AND n.source_id = w.source_id AND n.k = w.k + 1
)
SELECT meeting_id, source_id, max(found) / max(k) AS coverage, bool_and(in_order) AS in_order FROM walk GROUP BY ALL
""")
def body_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage and order of three candidate bodies, some turns of which say the same."""
    said, sources = _said(spark, sf_dir)
    return turns.body_metrics(sources, said)


@query(f"WITH {TURNS}, {SAID}, {SOURCES} SELECT meeting_id, source_id, body FROM sources WHERE source_id = meeting_id % 4")
def chosen_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body that was chosen for each meeting; every fourth choice names none that is there."""
    _, sources = _said(spark, sf_dir)
    choices = sources.select("meeting_id", (F.col("meeting_id") % 4).cast("int").alias("source_id")).distinct()
    return turns.chosen_body(sources, choices).select("meeting_id", "source_id", "body")


WHOLE = "whole AS (SELECT meeting_id, string_agg(text, '' ORDER BY turn_no) AS body FROM turns GROUP BY meeting_id)"
CUTS = "cuts AS (SELECT meeting_id, CAST(coalesce(sum(length(text)) OVER (PARTITION BY meeting_id ORDER BY turn_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) + turn_no % 2 AS begins FROM turns)"


@query(f"""
WITH {TURNS}, {WHOLE}, {CUTS}, every_cut AS (
  SELECT meeting_id, 0 AS begins FROM whole UNION SELECT meeting_id, begins FROM cuts JOIN whole USING (meeting_id) WHERE begins > 0 AND begins < length(body)
), ends AS (SELECT *, lead(begins) OVER (PARTITION BY meeting_id ORDER BY begins) AS until, row_number() OVER (PARTITION BY meeting_id ORDER BY begins) AS turn_no FROM every_cut)
SELECT meeting_id, turn_no, substr(body, begins + 1, coalesce(until, length(body)) - begins) AS text FROM ends JOIN whole USING (meeting_id)
""")
def anonymous_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without labels cut where decisions say, some of them a character late."""
    return turns.anonymous_turns(_view(spark, sf_dir, "whole", TURNS, WHOLE), _view(spark, sf_dir, "cuts", TURNS, CUTS)).select("meeting_id", "turn_no", "text")


@query(f"{_PACKED} SELECT meeting_id, turn_no, size, pack_no, used FROM packed WHERE meeting_id % 3 = 1")
def long_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs of those meetings only that were routed to the long material's workflow."""
    rows = _turns(spark, sf_dir)
    return turns.long_packs(rows, routes(spark, sf_dir), CAPACITY)


@query(f"WITH {TURNS}, {EDITS} SELECT meeting_id, turn_no FROM turns t WHERE NOT EXISTS (SELECT 1 FROM edits e WHERE e.meeting_id = t.meeting_id AND e.turn_no = t.turn_no)")
def coverage_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source turns without an edit."""
    return edits.missing_turns(_turns(spark, sf_dir), _edits(spark, sf_dir))


@query(f"WITH {TURNS}, {EDITS} SELECT meeting_id, turn_no, count(*) AS n FROM edits GROUP BY ALL HAVING count(*) > 1")
def repeated_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that came back twice."""
    return edits.repeated_edits(_edits(spark, sf_dir))


@query(f"""
WITH {TURNS}, {EDITS}, ordered AS (SELECT meeting_id, position, turn_no, lag(turn_no) OVER (PARTITION BY meeting_id ORDER BY position) AS turn_before FROM edits)
SELECT meeting_id, position, turn_no, turn_before FROM ordered WHERE turn_no <= turn_before
""")
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits out of order."""
    return edits.order_violations(_edits(spark, sf_dir))


@query(f"WITH {TURNS}, {EDITS} SELECT meeting_id, turn_no FROM edits WHERE action = 'delete' AND trim(coalesce(reason, '')) = ''")
def deletion_without_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted turns without a reason."""
    return edits.unreasoned_deletions(_edits(spark, sf_dir))


_ASSEMBLED = f"""
WITH {TURNS}, {EDITS}, once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id, turn_no ORDER BY position) AS k FROM edits) WHERE k = 1),
lines AS (
  SELECT t.meeting_id, t.turn_no, concat(CASE WHEN t.speaker IS NOT NULL THEN concat(t.speaker, ': ') ELSE '' END, coalesce(e.text, t.text, '')) AS line
  FROM turns t JOIN once e ON e.meeting_id = t.meeting_id AND e.turn_no = t.turn_no WHERE e.action <> 'delete'
), assembled AS (SELECT meeting_id, count(*) AS n_turns, string_agg(line, chr(10) ORDER BY turn_no) AS text FROM lines GROUP BY meeting_id)"""


@query(f"{_ASSEMBLED} SELECT * FROM assembled")
def assembled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited turns joined in source order."""
    return edits.assembled(_turns(spark, sf_dir), _edits(spark, sf_dir))


@query(f"{_ASSEMBLED} SELECT meeting_id, n_turns, replace(replace(text, 'an', 'AN'), 'a', concat('A', meeting_id % 3)) AS text FROM assembled")
def assembled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled text in which names are written one way throughout, the longer ones first."""
    rows = _turns(spark, sf_dir)
    names = rows.select("meeting_id").distinct().select("meeting_id", F.inline(F.array(F.struct(F.lit("a").alias("surface"), F.concat(F.lit("A"), F.col("meeting_id") % 3).alias("form")), F.struct(F.lit("an").alias("surface"), F.lit("AN").alias("form")))))
    return edits.assembled(rows, _edits(spark, sf_dir), names)


@query(f"""
WITH {TURNS}, {EDITS}, ordered AS (SELECT turn_no, lag(turn_no) OVER (PARTITION BY meeting_id ORDER BY position) AS turn_before FROM edits), c AS (
  SELECT (SELECT count(*) FROM turns) AS n_turns, (SELECT count(*) FROM edits) AS n_edits,
    (SELECT count(*) FROM turns t WHERE NOT EXISTS (SELECT 1 FROM edits e WHERE e.meeting_id = t.meeting_id AND e.turn_no = t.turn_no)) AS n_missing,
    (SELECT count(*) FROM edits e WHERE NOT EXISTS (SELECT 1 FROM turns t WHERE e.meeting_id = t.meeting_id AND e.turn_no = t.turn_no)) AS n_unknown,
    (SELECT count(*) FROM (SELECT 1 FROM edits GROUP BY meeting_id, turn_no HAVING count(*) > 1)) AS n_repeated,
    (SELECT count(*) FROM ordered WHERE turn_no <= turn_before) AS n_out_of_order, (SELECT count(*) FROM edits WHERE action = 'delete' AND trim(coalesce(reason, '')) = '') AS n_unreasoned
)
SELECT *, n_missing + n_unknown + n_repeated + n_out_of_order + n_unreasoned = 0 AS ok FROM c
""")
def assembly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All faults of what came back, in one row."""
    return edits.assembly_summary(_turns(spark, sf_dir), _edits(spark, sf_dir))


@query(f"""{_ASSEMBLED}
SELECT meeting_id, CAST(CASE WHEN meeting_id % 4 = 0 THEN 3 ELSE 2 END AS BIGINT) AS n_sections,
  concat('## 会议纪要', chr(10), chr(10), n_turns, ' turns', chr(10), chr(10), '## 参考原文', chr(10), chr(10), text, chr(10),
    CASE WHEN meeting_id % 4 = 0 THEN concat(chr(10), '## 存疑与待确认', chr(10), chr(10), '- meeting ', meeting_id, chr(10)) ELSE '' END) AS md
FROM assembled
""")
def render_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with their conditional sections."""
    text = assembled_text(spark, sf_dir)
    part = lambda df, section, md: df.select("meeting_id", F.lit(section).alias("section"), F.lit(0).cast("long").alias("ord"), md.alias("md"))
    candidates = text.where("meeting_id % 4 = 0").select("meeting_id", F.lit(0).alias("turn_no"), F.concat(F.lit("meeting "), F.col("meeting_id")).alias("surface"), F.lit("genuinely_doubtful").alias("disposition"), F.lit(None).cast("array<string>").alias("options"))
    parts = part(text, "minutes", F.concat(F.col("n_turns").cast("string"), F.lit(" turns"))).unionByName(part(text, "reference", F.col("text"))).unionByName(notes.doubtful_items(candidates))
    return notes.rendered(parts)


_NAMED = "named AS (SELECT name, count(DISTINCT code) AS n_codes, CASE WHEN count(DISTINCT code) = 1 THEN min(code) END AS code FROM catalog GROUP BY name)"


@query(f"""
WITH {CATALOG}, {CANDIDATES}, {_NAMED}
SELECT candidate_id, name, code, n_codes, 'name' AS matched_by FROM candidates JOIN named ON surface = name
UNION ALL SELECT candidate_id, name, code, 1, 'code' FROM candidates JOIN catalog ON surface = code
UNION ALL SELECT candidate_id, name, code, 1, 'bare_code' FROM candidates JOIN catalog ON surface = split_part(code, '.', 1)
""")
def symbol_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, whole codes and codes without their suffix found in the catalog."""
    return entities.exact_matches(_candidates(spark, sf_dir), _catalog(spark, sf_dir))


@query(f"""
WITH {CATALOG}, {CANDIDATES}, {_NAMED}, pairs AS (SELECT surface, name FROM (SELECT DISTINCT surface FROM candidates) s, named WHERE levenshtein(surface, name) = 1)
SELECT candidate_id, name, code, n_codes, CAST(1 AS BIGINT) AS distance FROM candidates JOIN pairs USING (surface) JOIN named USING (name)
""")
def symbol_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog names one edit away."""
    return entities.near_matches(_candidates(spark, sf_dir), _catalog(spark, sf_dir))


#: Variants: two to six by sound, one by shape, one reading; a kind that is not searched for.
VARIANTS = """variants AS (
  SELECT candidate_id, concat('s', k, substr(surface, 1, 2 + k)) AS variant, 'sound' AS kind FROM candidates, (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) x WHERE k <= 2 + candidate_id % 4
  UNION ALL SELECT candidate_id, concat('h', substr(surface, 1, 3)), 'shape' FROM candidates WHERE candidate_id % 3 <> 0
  UNION ALL SELECT candidate_id, concat('r ', surface), 'reading' FROM candidates WHERE candidate_id % 4 <> 0
  UNION ALL SELECT candidate_id, surface, 'other' FROM candidates
)"""


@query(f"""
WITH {CANDIDATES}, {VARIANTS}, close AS (
  SELECT candidate_id, variant FROM (SELECT DISTINCT candidate_id, variant FROM variants WHERE kind IN ('sound', 'shape')) QUALIFY row_number() OVER (PARTITION BY candidate_id ORDER BY variant) <= 4
), terms AS (
  SELECT candidate_id, surface AS term, 0 AS part FROM candidates UNION ALL SELECT candidate_id, variant, 1 FROM close UNION ALL SELECT DISTINCT candidate_id, variant, 2 FROM variants WHERE kind = 'reading'
)
SELECT candidate_id, string_agg(term, ' OR ' ORDER BY part, term) AS query, CAST(1 AS INTEGER) AS round FROM terms JOIN candidates USING (candidate_id) WHERE changes_text AND NOT is_person GROUP BY candidate_id
""")
def search_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One combined query per name that is no person's."""
    return entities.search_plan(_candidates(spark, sf_dir), _view(spark, sf_dir, "variants", CANDIDATES, VARIANTS))


READINGS = "ways AS (SELECT 'a' AS char, 'ei' AS reading UNION ALL SELECT 'a', 'ah' UNION ALL SELECT 'e', 'ee' UNION ALL SELECT 'l', 'el' UNION ALL SELECT 'l', 'le' UNION ALL SELECT 'l', 'el')"


@query(f"""
WITH {CANDIDATES}, {READINGS}, known AS (SELECT DISTINCT char, reading FROM ways), chars AS (SELECT candidate_id, substr(surface, 1, 1) AS a, substr(surface, 2, 1) AS b, substr(surface, 3, 1) AS c FROM candidates)
SELECT candidate_id, concat(coalesce(x.reading, a), ' ', coalesce(y.reading, b), ' ', coalesce(z.reading, c)) AS reading
FROM chars LEFT JOIN known x ON x.char = a LEFT JOIN known y ON y.char = b LEFT JOIN known z ON z.char = c
""")
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings of each name's first three characters."""
    found = _candidates(spark, sf_dir).select("candidate_id", F.substring("surface", 1, 3).alias("surface"))
    return entities.readings(found, _view(spark, sf_dir, "ways", READINGS))


OUTGOING = "outgoing AS (SELECT candidate_id AS query_id, concat(surface, '|', CASE WHEN candidate_id % 6 = 0 THEN 'a whole sentence' ELSE surface END, '|', candidate_id % 10) AS terms FROM candidates)"


@query(f"""
WITH {CANDIDATES}, {OUTGOING}, sent AS (SELECT DISTINCT query_id, unnest(string_split(terms, '|')) AS term FROM outgoing)
SELECT query_id, term FROM sent WHERE term IN (SELECT surface FROM candidates WHERE is_person) OR term NOT IN (SELECT surface FROM candidates WHERE NOT is_person)
""")
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of outgoing queries that are persons' names or not on the list."""
    found = _candidates(spark, sf_dir)
    outgoing = _view(spark, sf_dir, "outgoing", CANDIDATES, OUTGOING).select("query_id", F.split("terms", "[|]").alias("terms"))
    return entities.leaks(outgoing, found.where("is_person").select(F.col("surface").alias("name")), found.where("NOT is_person").select(F.col("surface").alias("term")))


SEARCHES = "searches AS (SELECT meeting_id, 1 + (turn_no + meeting_id) % 3 % 2 AS round FROM turns WHERE turn_no % 3 = 0)"


@query(f"WITH {TURNS}, {SEARCHES} SELECT meeting_id, max(round) AS rounds FROM searches GROUP BY meeting_id HAVING max(round) > 1")
def surplus_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meetings with more than one external round."""
    return entities.surplus_rounds(_view(spark, sf_dir, "searches", TURNS, SEARCHES))


@query(f"""
WITH {CANDIDATES}, plan AS (SELECT candidate_id, meeting_id, surface AS query FROM candidates WHERE changes_text AND NOT is_person)
SELECT meeting_id, count(*) AS n_queries, string_agg(concat('(', query, ')'), ' ' ORDER BY candidate_id) AS query FROM plan GROUP BY meeting_id
""")
def one_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All unresolved names of a meeting in one external round."""
    found = _candidates(spark, sf_dir)
    none = found.select("candidate_id", F.lit("").alias("variant"), F.lit("sound").alias("kind")).where("false")
    return entities.one_round(entities.search_plan(found, none), found)


#: Anchors of all kinds, single and together, some not from the meeting, with rivals of equal precedence.
ANCHORS = """anchors AS (
  SELECT candidate_id, 'self_correction' AS kind, concat('form ', candidate_id % 7) AS form, CASE WHEN candidate_id % 4 = 0 THEN concat(candidate_id, '.SH') END AS code, 3 AS precedence, candidate_id % 10 <> 0 AS in_meeting FROM candidates WHERE candidate_id % 2 = 0
  UNION ALL SELECT candidate_id, kind, concat('form ', candidate_id % 5), CASE WHEN kind = 'code' THEN concat(candidate_id, '.SZ') END, CASE WHEN candidate_id % 12 = 0 THEN 3 ELSE 1 END, candidate_id % 11 <> 0
    FROM candidates, (SELECT 'name' AS kind UNION ALL SELECT 'code' UNION ALL SELECT 'role') x WHERE kind <> 'code' OR candidate_id % 3 = 0
  UNION ALL SELECT candidate_id, kind, concat('read ', candidate_id % 3), NULL, 1, candidate_id % 8 <> 1 FROM candidates, (SELECT 'reading' AS kind UNION ALL SELECT 'repeated_name') x WHERE kind = 'reading' OR candidate_id % 4 = 1
  UNION ALL SELECT candidate_id, 'near_name', 'a near name', NULL, 9, true FROM candidates WHERE candidate_id % 4 = 0
)"""
_PROVEN = """proven AS (
  SELECT candidate_id, form, max(code) AS code, max(CASE WHEN in_meeting OR kind IN ('name', 'reading', 'near_name') THEN precedence END) AS precedence FROM anchors GROUP BY candidate_id, form
  HAVING bool_or(kind = 'name') AND bool_or(kind = 'code' AND in_meeting) AND bool_or(kind = 'role' AND in_meeting) OR bool_or(kind = 'reading') AND bool_or(kind = 'repeated_name' AND in_meeting)
    OR bool_or(kind IN ('definition', 'self_correction') AND in_meeting)
)"""


@query(f"""
WITH {CANDIDATES}, {ANCHORS}, {_PROVEN}, ranked AS (SELECT *, max(precedence) OVER (PARTITION BY candidate_id) AS best FROM proven)
SELECT candidate_id, min(form) AS form, max(code) AS code FROM ranked WHERE precedence = best GROUP BY candidate_id HAVING count(*) = 1
""")
def identity_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities by the proven form with the highest precedence, where no rival remains; a near name is no anchor."""
    return entities.resolved(_view(spark, sf_dir, "anchors", CANDIDATES, ANCHORS), _candidates(spark, sf_dir))


@query(f"WITH {CANDIDATES}, {ANCHORS}, {_PROVEN} SELECT candidate_id FROM candidates WHERE candidate_id % 5 <> 0 AND candidate_id NOT IN (SELECT candidate_id FROM proven)")
def identity_unanchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved identities without a proof; every fifth one was not resolved."""
    disposition = F.when(F.col("candidate_id") % 5 == 0, "genuinely_doubtful").otherwise("resolved_identity")
    return entities.unanchored(_candidates(spark, sf_dir).select("candidate_id", disposition.alias("disposition")), _view(spark, sf_dir, "anchors", CANDIDATES, ANCHORS))


@query("SELECT d.doc_id AS text_id, b.item_id AS phrase_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def phrase_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain which benchmark texts, by pieces that meet on equality."""
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return validation.phrase_hits(documents.select(F.col("doc_id").alias("text_id"), "text"), benchmark.select(F.col("item_id").alias("phrase_id"), F.col("text").alias("phrase")))


PAIRS = "pairs AS (SELECT meeting_id, turn_no, concat(text, ' 10 ', turn_no, ' 3.5%') AS source, concat(text, ' ', meeting_id % 7, '.5% ', turn_no, CASE WHEN turn_no % 3 = 0 THEN ' 88' ELSE '' END) AS edited FROM turns)"


def _only_in(a: str, b: str, pattern: str) -> str:
    """DuckDB SQL for a list of what a pattern finds in a and not in b, sorted, as text."""
    return f"array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all({a}, '{pattern}'), lambda x: NOT list_contains(regexp_extract_all({b}, '{pattern}'), x)))), ' ')"


_NUMBER = "[0-9]+(?:\\.[0-9]+)?%?"


@query(f"WITH {TURNS}, {PAIRS}, found AS (SELECT meeting_id, turn_no, {_only_in('edited', 'source', _NUMBER)} AS added FROM pairs) SELECT * FROM found WHERE added <> ''")
def numeric_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that an edit adds."""
    return decisions.number_additions(_view(spark, sf_dir, "pairs", TURNS, PAIRS)).select("meeting_id", "turn_no", F.array_join("added", " ").alias("added"))


MEASURED = """measured AS (
  SELECT meeting_id, turn_no, concat(turn_no, '个点和7.9亿元, 6万台') AS source,
    concat(turn_no, CASE meeting_id % 3 WHEN 0 THEN '个点' WHEN 1 THEN '个百分点' ELSE '%' END, '和7.9亿', CASE WHEN turn_no % 2 = 0 THEN '元' ELSE '美元' END, ', 6万台') AS edited
  FROM turns
)"""


@query(f"WITH {TURNS}, {MEASURED}, found AS (SELECT meeting_id, turn_no, {_only_in('edited', 'source', f'[0-9]+(?:[.][0-9]+)?(?:{UNITS})?')} AS added FROM measured) SELECT * FROM found WHERE added <> ''")
def unit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers whose unit an edit changed."""
    return decisions.quantity_changes(_view(spark, sf_dir, "measured", TURNS, MEASURED)).select("meeting_id", "turn_no", F.array_join("added", " ").alias("added"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)?%?'), ' ') AS numbers FROM documents WHERE text IS NOT NULL")
def numeric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of each text as written."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL").select("doc_id", F.array_join(number_tokens(F.col("text")), " ").alias("numbers"))


@query("""
WITH files AS (
  SELECT doc_id, encode(concat(text, CASE WHEN doc_id % 3 = 0 THEN '会' ELSE '' END)) || CASE WHEN doc_id % 4 = 0 THEN '\\xE4\\xBC'::BLOB ELSE ''::BLOB END AS content FROM documents WHERE text IS NOT NULL
), read AS (SELECT doc_id, TRY(decode(content)) AS text FROM files)
SELECT doc_id, text IS NOT NULL AS valid_utf8, coalesce(regexp_matches(text, '\\p{Han}'), false) AS has_cjk FROM read
""")
def utf8_cjk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid UTF-8 and Han characters, of texts with a Han character added to every third and a cut one to every fourth."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL")
    text = F.concat("text", F.when(F.col("doc_id") % 3 == 0, "会").otherwise("")).cast("binary")
    content = F.concat(text, F.when(F.col("doc_id") % 4 == 0, F.unhex(F.lit("E4BC"))).otherwise(F.unhex(F.lit(""))))
    return validation.utf8_check(rows.select(F.col("doc_id").alias("path"), content.alias("content"))).select(F.col("path").alias("doc_id"), "valid_utf8", "has_cjk")


@query("SELECT doc_id, contains(text, '会') AS has_han FROM documents WHERE text IS NOT NULL")
def han_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts have a Han character."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL").select("doc_id", has_han(F.col("text")).alias("has_han"))


MINUTES = "notes AS (SELECT meeting_id, text AS reference, CASE meeting_id % 4 WHEN 0 THEN text WHEN 1 THEN concat(text, '.') WHEN 2 THEN substr(text, 2) END AS minutes FROM assembled)"


@query(f"{_ASSEMBLED}, {MINUTES} SELECT meeting_id FROM notes WHERE minutes IS NULL OR length(minutes) > length(reference)")
def minutes_too_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes whose minutes are longer than the reference text, or are not there; equal length is allowed."""
    text, m = assembled_text(spark, sf_dir), F.col("meeting_id") % 4
    minutes = F.when(m == 0, F.col("text")).when(m == 1, F.concat("text", F.lit("."))).when(m == 2, F.expr("substr(text, 2)"))
    return decisions.longer_minutes(text.select("meeting_id", minutes.alias("minutes"), F.col("text").alias("reference"))).select("meeting_id")


@query(f"WITH {TURNS} SELECT meeting_id, turn_no FROM turns WHERE turn_no % 4 <> 0")
def identity_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that were copied unchanged."""
    rows = _turns(spark, sf_dir).withColumns({"source": F.col("text"), "edited": F.when(F.col("turn_no") % 4 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text"))})
    return decisions.identity_copies(rows).select("meeting_id", "turn_no")


GIVEN = "given AS (SELECT meeting_id, turn_no, CASE (meeting_id + turn_no) % 6 WHEN 0 THEN 'someone' WHEN 1 THEN NULL ELSE speaker END AS speaker FROM turns WHERE turn_no % 5 <> 4)"


@query(f"WITH {TURNS}, {GIVEN} SELECT meeting_id, turn_no, t.speaker, g.speaker AS edited_speaker FROM turns t JOIN given g USING (meeting_id, turn_no) WHERE t.speaker IS DISTINCT FROM g.speaker")
def speaker_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that were given to another speaker, or to none; deleted ones don't count."""
    return decisions.speaker_changes(_turns(spark, sf_dir), _view(spark, sf_dir, "given", TURNS, GIVEN))


#: Notes of up to six headings in an order that depends on the meeting, some unknown, some twice, some in a code fence.
NOTES = """drafts AS (
  SELECT meeting_id, concat(
    CASE WHEN meeting_id % 3 <> 0 THEN concat('## 参考原文', chr(10), 'y', chr(10)) ELSE '' END, CASE WHEN meeting_id % 5 <> 0 THEN concat('## 会议纪要 ', chr(10), 'x', chr(10)) ELSE '' END,
    CASE WHEN meeting_id % 2 = 0 THEN concat('## summary', chr(10), '### 会议纪要', chr(10)) ELSE '' END, CASE WHEN meeting_id % 7 = 0 THEN concat('## 会议纪要', chr(10)) ELSE '' END,
    CASE WHEN meeting_id % 4 = 0 THEN concat('```', chr(10), '## in a fence', chr(10), '```', chr(10)) ELSE '' END, '## 存疑与待确认', chr(10)) AS md
  FROM (SELECT DISTINCT meeting_id FROM turns) m
)"""


@query(f"""
WITH {TURNS}, {NOTES}, ranks AS (SELECT unnest(['会议纪要', '参考原文', '存疑与待确认', '重要信息修改记录']) AS heading, unnest([1, 2, 3, 4]) AS rank), titles AS (
  SELECT meeting_id, unnest(regexp_extract_all(md, '(?m)^## +(.+?) *$', 1)) AS heading, generate_subscripts(regexp_extract_all(md, '(?m)^## +(.+?) *$', 1), 1) AS place FROM drafts
), found AS (SELECT t.*, r.rank FROM titles t LEFT JOIN ranks r USING (heading) WHERE heading <> 'in a fence')
SELECT meeting_id, 'missing' AS fault, r.heading FROM drafts, ranks r WHERE rank <= 2 AND NOT EXISTS (SELECT 1 FROM found f WHERE f.meeting_id = drafts.meeting_id AND f.heading = r.heading)
UNION ALL SELECT DISTINCT meeting_id, 'unknown', heading FROM found WHERE rank IS NULL
UNION ALL SELECT meeting_id, 'repeated', heading FROM found GROUP BY meeting_id, heading HAVING count(*) > 1
UNION ALL SELECT meeting_id, 'misplaced', heading FROM (SELECT *, lag(rank) OVER (PARTITION BY meeting_id ORDER BY place) AS before FROM found WHERE rank IS NOT NULL) WHERE rank < before
""")
def note_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, unknown, repeated and misplaced headings of notes."""
    return validation.structure_faults(_view(spark, sf_dir, "drafts", TURNS, NOTES))
