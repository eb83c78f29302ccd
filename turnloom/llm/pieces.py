"""SentencePiece encoding and decoding over a table of distinct chunks.

In the model no piece has a white-space marker after another character, so a merge never crosses from a word into the
marker of the next one: a text can be cut before each run of markers, and each marked word segmented by itself. A task
keeps a table with one entry for each distinct marked word it has met, holding its ids and its decoded surface; only
new words go to the library, once. The ids of a text are then joined back by position from the table.

The table lives in the worker, not in a shuffle: positions outnumber distinct words by far (eight to one in 25 MB of text),
and joining them across the cluster would move several times the corpus (figures in the README). Its size is bounded by ``table_bytes``; a full table starts anew, which
costs time but changes no result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.shared import portions
from turnloom.session import map_arrow

MARKER = "▁"
_MARKED_WORD = re.compile(r" *[^ ]+| +")


class ChunkTable:
    """Encodes and decodes whole texts with the library's results, segmenting each distinct marked word once."""

    #: What an entry takes besides its strings' characters.
    ENTRY_BYTES = 220

    def __init__(self, model: str, table_bytes: int = 160 << 20):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.end = self.library.eos_id()
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.separable = not any(MARKER in piece.lstrip(MARKER) for piece in pieces) and self._keeps_spaces()
        self.shown = [f"\n{i}" if piece.startswith(MARKER) else f" {i}" for i, piece in enumerate(pieces)]
        self.ids: dict[str, str] = {}  # decimal ids of a chunk, joined by a space
        self.odd: dict[str, str] = {}  # decoded surfaces that are not the chunk itself
        self.room = self.table_bytes = table_bytes

    def _keeps_spaces(self) -> bool:
        """Whether the library puts one marker in front of a text and keeps every space, which cutting relies on."""
        return all(self.library.decode(self.library.encode(x)) == x for x in ("a", "a b", "  a  b ", " a", "a   "))

    def _fill(self, chunks: set[str]) -> None:
        """Adds the chunks that are not there yet; all begin with a space."""
        new = [c for c in chunks if c not in self.ids]
        need = 2 * sum(map(len, new)) + self.ENTRY_BYTES * len(new)
        if need > self.room:
            self.ids, self.odd, self.room = {}, {}, self.table_bytes
            new = list(chunks)
            need = 2 * sum(map(len, new)) + self.ENTRY_BYTES * len(new)
        self.room -= need
        marked_once = [c for c in new if len(c) > 1 and c[1] != " "]
        for k in range(0, len(marked_once), 20_000):
            self._fill_at_once(marked_once[k : k + 20_000])
        for chunk in new:
            if chunk not in self.ids:
                self._fill_one(chunk)

    def _fill_at_once(self, chunks: list[str]) -> None:
        """Segments chunks with one marker each in one call; does nothing if they cannot be told apart in the result."""
        text = "".join(chunks)[1:]
        ids = self.library.encode(text)
        parts = "".join(map(self.shown.__getitem__, ids)).split("\n")
        if not parts[0] and len(parts) == len(chunks) + 1 and self.library.decode(ids) == text:
            self.ids.update(zip(chunks, parts[1:], strict=True))

    def _fill_one(self, chunk: str) -> None:
        """The marker that the library puts in front stands for the chunk's first space; of a lone space it makes nothing."""
        ids = self.library.encode(chunk[1:]) or [self.library.piece_to_id(MARKER)]
        self.ids[chunk] = " ".join(map(str, ids))
        if len(chunk) > 1 and (surface := " " + self.library.decode(ids)) != chunk:
            self.odd[chunk] = surface

    def _by_library(self, text: str) -> tuple[str, str]:
        ids = [*self.library.encode(text), self.end]
        return " ".join(map(str, ids)), self.library.decode(ids)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text, its decimal ids with the end id, joined by one space, and the decoded text."""
        cut = [_MARKED_WORD.findall(" " + text) if text and self.separable and MARKER not in text else None for text in texts]
        self._fill(set().union(*(c for c in cut if c)))
        end = str(self.end)
        for text, chunks in zip(texts, cut, strict=True):
            if chunks is None:
                yield self._by_library(text)
                continue
            ids = list(map(self.ids.__getitem__, chunks))
            ids.append(end)
            odd = self.odd and not self.odd.keys().isdisjoint(chunks)
            yield " ".join(ids), "".join(self.odd.get(c, c) for c in chunks)[1:] if odd else text


@lru_cache(maxsize=1)
def table(model: str) -> ChunkTable:
    """One table for all tasks of a worker."""
    return ChunkTable(model)


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, decoded; with digests: doc_id, n_tokens, ids_sha256, decoded_sha256.

    model: a SentencePiece file, at the same place on every executor. ids end with the model's end id.

    Defined results: a null or empty text has the end id only and decodes to the empty text; null ids and repeated rows
    stay; texts are never cut; an empty table gives no rows; other columns are not read.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64())] + ([("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digests else [("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    schema = pa.schema(fields)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = table(model)
        for batch in batches:
            counts, first, second = [], [], []
            for ids, decoded in (x for portion in portions(batch.column(1)) for x in chunks.encode(portion)):
                counts.append(ids.count(" ") + 1)
                first.append(sha(ids) if digests else list(map(int, ids.split(" "))))
                second.append(sha(decoded) if digests else decoded)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(first, schema.field(2).type), pa.array(second, pa.string())], schema=schema)

    kinds = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, kinds)


def decode(tokens: DataFrame, model: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ids: doc_id, decoded, by the library's decode(ids).

    Defined results: null and empty ids decode to the empty text; null document ids and repeated rows stay; an empty
    table gives no rows; other columns, whatever their names, are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = table(model).library
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([library.decode(ids.as_py() or []) for ids in batch.column(1)], pa.string())], schema=schema)

    return map_arrow(tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")), run, "doc_id long, decoded string")
