"""Readers of materials: text, Markdown, DOCX, transcripts, catalogs, search results and evaluation cases."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.session import map_arrow

TRANSCRIPT = "meeting_id string, turn_no bigint, speaker string, start_ms bigint, end_ms bigint, text string"
CATALOG = "name string, code string"
SEARCH_RESULTS = "query string, round int, title string, url string, snippet string"
TEMPLATES = "meeting_type string, template string"
_DOUBTFUL = "id: string, source: string, candidate: string, evidence: string, identity_evidence: string, expected_disposition: string, expected_rendering: string, expected_doubtful_items: int, expected_external_search_rounds: int, forbidden_additions: array<string>"
_DENSITY = "id: string, source: string, expected_minutes_required: array<string>, expected_reference_required: array<string>, minutes_may_remove: array<string>, forbidden_additions: array<string>"
#: Fixed by the format: the namespaces of a DOCX body.
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_FALLBACK = "{http://schemas.openxmlformats.org/markup-compatibility/2006}Fallback"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, body: one row per text or Markdown file, a byte order mark taken off."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("body"))
    return rows


def docx_text(content: bytes) -> str | None:
    """The paragraphs of a DOCX file, one per line; None if it is not one. Tabs and breaks inside a paragraph are kept.

    A paragraph inside another one (of a text box) is a line of its own behind it; alternatives for old readers, which
    repeat a text box, are left out.
    """
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    shown = {f"{_WORD}tab": "\t", f"{_WORD}br": "\n", f"{_WORD}cr": "\n"}
    lines: list[list[str]] = []
    todo: list[tuple[ElementTree.Element, int]] = [(root, -1)]
    while todo:
        e, line = todo.pop()
        if e.tag == _FALLBACK:
            continue
        if e.tag == f"{_WORD}p":
            line = len(lines)
            lines.append([])
        elif line >= 0:
            lines[line].append(e.text or "" if e.tag == f"{_WORD}t" else shown.get(e.tag, ""))
        todo += [(child, line) for child in reversed(e)]
    return "\n".join(map("".join, lines))


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """path, body: one row per DOCX file; body is null where a file cannot be read."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = pa.schema([("path", pa.string()), ("body", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([docx_text(x.as_py()) for x in batch.column(1)], pa.string())], schema=schema)

    return map_arrow(files, run, "path string, body string")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """TRANSCRIPT rows from JSON lines: what a recogniser made of a recording, in one pass, with its timeline."""
    return spark.read.schema(TRANSCRIPT).json(path)


def models_present(folder: str, names: tuple[str, ...]) -> dict[str, bool]:
    """Whether each model has a folder with files in a local cache; a check before a run, nothing is loaded."""
    return {name: any(p.is_file() for p in Path(folder, name).rglob("*")) for name in names}


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """name, code: a catalog of securities from CSV with a header, or from Parquet. Codes stay text."""
    rows = spark.read.parquet(path) if re.search(r"\.parquet/?$", path) else spark.read.schema(CATALOG).option("header", True).csv(path)
    return rows.select("name", "code").distinct()


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """SEARCH_RESULTS rows from JSON lines; searches are made outside."""
    return spark.read.schema(SEARCH_RESULTS).json(path)


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """meeting_type, template: formats of meeting types, one Markdown file each, named after the type."""
    rows = read_texts(spark, path)
    return rows.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("meeting_type"), F.col("body").alias("template"))


def read_doubtful_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases of repair, identity and uncertainty; fields that a case does not have are null."""
    return _cases(spark, path, _DOUBTFUL)


def read_density_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases of information density; fields that a case does not have are null."""
    return _cases(spark, path, _DENSITY)


def _cases(spark: SparkSession, path: str, case: str) -> DataFrame:
    schema = f"schema_version string, description string, cases array<struct<{case}>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select("schema_version", F.inline("cases"))
