"""Writers: notes, process records, archives and validator results. Only write_notes makes the deliverable."""

from __future__ import annotations

import json
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame


def write_notes(notes: DataFrame, folder: str) -> int:
    """Writes one Markdown file per meeting (meeting_id, md) from the driver, row by row; returns how many.

    Names are the ids with all but letters, digits, "_", "-" and "~" percent-encoded, so no two ids share a file; an id
    that comes twice is an error.
    """
    Path(folder).mkdir(parents=True, exist_ok=True)
    n, written = 0, set()
    for row in notes.select("meeting_id", "md").toLocalIterator():
        name = quote(str(row["meeting_id"]), safe="").replace(".", "%2E")
        with Path(folder, f"{name}.md").open("x" if name in written else "w", encoding="utf-8") as f:
            f.write(row["md"])
        written.add(name)
        n += 1
    return n


def write_process(details: DataFrame, folder: str, summary: DataFrame) -> str:
    """Writes the details as JSON lines and returns the one-row summary as compact JSON for standard output."""
    details.write.mode("overwrite").json(folder)
    return json.dumps(summary.first().asDict(), ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def export_archive(notes: DataFrame, folder: str, requested: bool) -> bool:
    """Writes notes as Parquet, but only if the user has asked for it; returns whether it did."""
    if requested:
        notes.write.mode("overwrite").parquet(folder)
    return requested


def validation_json(faults: DataFrame, most: int = 1000) -> str:
    """Faults as a JSON document: how many there are, and the first ones."""
    rows = [r.asDict(recursive=True) for r in faults.limit(most).collect()]
    return json.dumps({"ok": not rows, "n_faults": faults.count() if len(rows) == most else len(rows), "faults": rows}, ensure_ascii=False)
