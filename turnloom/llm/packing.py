"""Packing of tokenized documents into training sequences by Karmarkar-Karp multiway differencing.

A document is cut at multiples of the window; those full pieces are sequences of their own. What is left over (less
than a window) is cut into pieces of at most ``piece`` ids, which go to a pool. Each pool holds a bounded number of
pieces, and its last piece is cut so that the windows of the pool are just not full. Karmarkar-Karp differencing then
spreads the pool over its windows: a partial partition is a vector of window sums; the two partial partitions with
the largest imbalance are merged so that the fullest windows of one meet the emptiest of the other. The result is
near-equal windows. If one exceeds the capacity, the window count rises by one and the pool is spread again.

Everything happens in one pass over a partition, without a shuffle: pools never span partitions, so a hot source or
large groups of copies make no task larger, and a lost task gives the same sequences when it runs again.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.shared import portions
from turnloom.session import map_arrow

#: Ids by which the windows of a pool fall short of full on average, so that differencing need not be perfect.
SLACK = 2

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
_IDS = pa.schema([*_ARROW, ("ids", pa.list_(pa.int32()))])


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones are themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids as the tokenizers library gives them for a byte-level BPE file, in one thread.

    The pre-tokenizer never joins a character to white space behind it, so a text can be cut before each run of white
    space and each distinct chunk encoded once; a bounded table keeps the ids of chunks. Chunks go through tiktoken
    with the ranks of the same file. A text with the string of an added token (which the library takes for that token)
    goes through the library itself, one with uncommon white space through tiktoken whole. Ranks stand for the file's
    merges only if those are in the order of their ids; for a file where they are not, all texts go through the library.
    """

    #: Fixed by the byte-level pre-tokenizer: how it splits a text.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    CHUNK = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
    WHITE = ("", " ", "\n", "\t", "\r")
    UNCOMMON = re.compile(r"[^\S \n\t\r]")
    #: What an entry of the table takes besides its strings.
    ENTRY_BYTES = 180

    def __init__(self, path: str, table_bytes: int = 128 << 20):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        self.exact = Tokenizer.from_file(path)
        self.added = [t["content"] for t in spec["added_tokens"]]
        byte = _byte_of_symbol()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.added}
        self.fast = tiktoken.Encoding("byte-level", pat_str=self.SPLIT, mergeable_ranks=ranks, special_tokens={})
        merged = [ranks.get(bytes(byte[c] for c in ("".join(m) if isinstance(m, list) else m.replace(" ", "", 1))), -1) for m in spec["model"]["merges"]]
        self.in_order = all(a < b for a, b in zip([-1, *merged], merged, strict=False))
        self.spaced = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.spaced[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.table: dict[str, bytes] = {}
        self.room = self.table_bytes = table_bytes

    def _fill(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.table]
        if (need := 5 * sum(map(len, new)) + self.ENTRY_BYTES * len(new)) > self.room:
            self.table, self.room = {}, self.table_bytes
            new = list(chunks)
            need = 5 * sum(map(len, new)) + self.ENTRY_BYTES * len(new)
        self.room -= need
        spaced_once = [c for c in new if c[0] == " " and c[1:2] not in self.WHITE]
        for k in range(0, len(spaced_once), 20_000):
            self._fill_at_once(spaced_once[k : k + 20_000])
        for chunk in new:
            if chunk not in self.table:
                self.table[chunk] = array("I", self.fast.encode_ordinary(chunk)).tobytes()

    def _fill_at_once(self, chunks: list[str]) -> None:
        """Encodes chunks with one space in front each in one call; the ids of tokens that begin with a space tell them apart."""
        ids = np.array(self.fast.encode_ordinary("".join(chunks)), dtype=np.uint32)
        first = np.flatnonzero(self.spaced[ids])
        if len(first) == len(chunks):
            data, cuts = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
            self.table.update((c, data[a:b]) for c, a, b in zip(chunks, cuts, cuts[1:], strict=False))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit integers."""
        whole = [not self.in_order or any(token in text for token in self.added) or self.UNCOMMON.search(text) is not None for text in texts]
        cut = [None if odd else self.CHUNK.findall(text) for text, odd in zip(texts, whole, strict=True)]
        self._fill(set().union(*(c for c in cut if c)))
        return [self._whole(text) if c is None else np.frombuffer(b"".join(map(self.table.__getitem__, c)), dtype=np.uint32) for text, c in zip(texts, cut, strict=True)]

    def _whole(self, text: str) -> np.ndarray:
        if not self.in_order or any(token in text for token in self.added):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder, with its table, for all tasks of a worker."""
    return Encoder(path)


def spread(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size, by largest differencing of partial partitions into that many windows.

    A node of the merge tree keeps, for each of its windows, which window of either child went into it; going down
    the tree from the last node gives each size its window. Ties go to the node that was made first.
    """
    if windows <= 1 or len(sizes) <= 1:
        return np.zeros(len(sizes), dtype=np.int64)
    children: list[tuple[int, int, np.ndarray, np.ndarray] | None] = [None] * len(sizes)
    heap: list[tuple[int, int, np.ndarray]] = []
    for k, size in enumerate(sizes):
        sums = np.zeros(windows, dtype=np.int64)
        sums[0] = size
        heap.append((-size, k, sums))
    heapq.heapify(heap)
    opposed = np.arange(windows - 1, -1, -1)
    while len(heap) > 1:
        _, a, most = heapq.heappop(heap)
        _, b, next_most = heapq.heappop(heap)
        merged = most + next_most[::-1]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        merged -= merged[-1]
        children.append((a, b, order, opposed[order]))
        heapq.heappush(heap, (-int(merged[0]), len(children) - 1, merged))
    window = np.zeros(len(sizes), dtype=np.int64)
    todo = [(len(children) - 1, np.arange(windows))]
    while todo:
        k, label = todo.pop()
        node = children[k]
        if node is None:
            window[k] = label[0]
            continue
        a, b, of_a, of_b = node
        for child, where in ((a, of_a), (b, of_b)):
            below = np.empty(windows, dtype=np.int64)
            below[where] = label
            todo.append((child, below))
    return window


def balanced(sizes: list[int], capacity: int) -> np.ndarray:
    """The window of each size; the window count starts at the least possible one and rises until none exceeds the capacity."""
    windows = -(-sum(sizes) // capacity)
    while True:
        window = spread(sizes, windows)
        if not sizes or np.bincount(window, weights=sizes).max() <= capacity:
            return window
        windows += 1


class _Packer:
    """Packs the documents of one partition in their order."""

    def __init__(self, base: int, window: int, piece: int, pool: int, with_ids: bool):
        self.next_id, self.window, self.piece, self.pool, self.with_ids = base, window, piece, pool, with_ids
        self.pending: list[tuple] = []  # doc_id, start, ids, ids of the document
        self.pending_ids = 0
        self.out: list[tuple] = []

    def _emit(self, piece: tuple, sequence: int, offset: int) -> None:
        doc_id, start, ids, total = piece
        row = (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset)
        self.out.append((*row, ids.astype(np.int32)) if self.with_ids else row)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, full = len(ids), len(ids) // self.window * self.window
        for start in range(0, full, self.window):
            self._emit((doc_id, start, ids[start : start + self.window], total), self.next_id, 0)
            self.next_id += 1
        for start in range(full, total, self.piece):
            part = ids[start : start + self.piece]
            self.pending.append((doc_id, start, part, total))
            self.pending_ids += len(part)
        if len(self.pending) >= self.pool:
            self.flush()

    def flush(self, last: bool = False) -> None:
        """Spreads the pool. All but the last pool end with a cut that leaves each window SLACK ids short of full."""
        pieces, rest = self.pending, []
        target = self.pending_ids // (self.window - SLACK) * (self.window - SLACK)
        if not last and target:
            pieces, room = [], target
            for piece in self.pending:
                doc_id, start, ids, total = piece
                if room >= len(ids):
                    pieces.append(piece)
                elif room:
                    pieces.append((doc_id, start, ids[:room], total))
                    rest.append((doc_id, start + room, ids[room:], total))
                else:
                    rest.append(piece)
                room -= min(room, len(ids))
        window = balanced([len(p[2]) for p in pieces], self.window)
        used = int(window.max()) + 1 if len(pieces) else 0
        offset = [0] * used
        for piece, w in zip(pieces, window.tolist(), strict=True):
            self._emit(piece, self.next_id + w, offset[w])
            offset[w] += len(piece[2])
        self.next_id += used
        self.pending, self.pending_ids = rest, sum(len(p[2]) for p in rest)

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        schema = _IDS if self.with_ids else _ARROW
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def pack(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, piece: int = 256, pool: int = 512, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids on request).

    vocabulary: a tokenizers file, at the same place on every executor. Each document is its ids followed by end_id.

    Defined results: a null text counts as empty and is one piece with end_id only; a null id stays null and its
    document is packed like any other; repeated rows are documents of their own; very long texts become full windows
    plus one remainder; an empty table gives no rows; other columns, whatever their names, are not read. Sequence ids
    are unique; they are numbered within each partition of the input and have gaps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        packer = _Packer(TaskContext.get().partitionId() << 40, window, piece, pool, with_ids)
        for batch in batches:
            ids = (x for portion in portions(batch.column(1)) for x in encode(portion))
            for doc_id, of_text in zip(batch.column(0).to_pylist(), ids, strict=True):
                packer.add(doc_id, np.append(of_text, np.uint32(end_id)))
                if len(packer.out) >= 20_000:
                    yield packer.take()
            yield packer.take()
        if packer.pending:
            packer.flush(last=True)
        yield packer.take()

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, SCHEMA + (", ids array<int>" if with_ids else ""))
