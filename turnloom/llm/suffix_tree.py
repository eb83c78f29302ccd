"""Language-model scoring with a probabilistic suffix tree over words.

The root is the distribution of single tokens. A state is a context of one or more preceding words; it is kept if its
next-token distribution diverges from that of its longest kept suffix by more than the state costs: the training
tokens' log-likelihood must gain more than half the logarithm of the context's count per probability it stores. A
token is scored in the state of the longest kept context that precedes it.

Smoothing: the root takes a discount off each known token's count and gives it to the one unknown symbol. A state takes
a discount off the counts that it stores and gives the rest of its mass to all other tokens, in proportion to its
suffix state. So every distribution sums to one over the known tokens and the unknown symbol.

Scale: a token, a context or a stored probability is held by every worker if it occurs at least LEAST_COUNT times and at
least a fixed part of the square root of the number of training tokens. So there is no cap: the tree grows with the
corpus, and is at most SPREAD times that square root in each of its tables (30 GB of text, 5e9 tokens: 4.5 million
rows of 16 bytes; a table above MOST_BYTES raises an error). All other tokens are joined to the corpus counts by a
shuffle on the token; each of them occurs less often than that in all documents, held-out ones included, so none of
them makes a task large. Texts are split into tokens twice: to count them, and to store them as numbers for all that follows. Contexts are coded by their place in the level above and their last token, at any depth.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.shared import LOWER_ASCII, slices, stored
from turnloom.session import map_arrow

#: Depth of the tree, discount of stored counts, and what makes a token or probability frequent: LEAST_COUNT, and one
#: part in SPREAD of the square root of all training tokens; a context must occur CONTEXT times as often as that.
DEPTH, DISCOUNT, LEAST_COUNT, SPREAD, CONTEXT = 3, 0.5, 4, 64, 4
#: Tokens of more bytes than this are held by a hash. Tables of more bytes than that are not sent to workers.
LONGEST, MOST_BYTES = 64, 2 << 30
#: The end token; no word is empty.
END = ""


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 7, is 2. A null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def _tokens(text: pa.Scalar) -> list[bytes]:
    return (text.as_py() or "").encode().translate(LOWER_ASCII).split()


def _key(token: bytes) -> bytes:
    """What a token is held by: itself, or a hash with a space in front, which no token has."""
    return token if len(token) <= LONGEST else b" " + hashlib.sha1(token).digest()


def count_tokens(texts: DataFrame) -> DataFrame:
    """token, n, every: how often each token occurs in the column text of rows to learn from, and in all; one end token per row included.

    texts: text, learn (boolean).
    """
    schema = pa.schema([("token", pa.string()), ("n", pa.int64()), ("every", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 0, 16 << 20)):
            counts: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
            for text, learn in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = counts[bool(learn)]
                own.update(_tokens(text))
                own[END.encode()] += 1
            every = counts[0] + counts[1]
            yield pa.record_batch([pa.array([t.decode() for t in every], pa.string()), pa.array([counts[1][t] for t in every], pa.int64()), pa.array(every.values(), pa.int64())], schema=schema)

    return map_arrow(texts.select("text", "learn"), run, "token string, n long, every long").groupBy("token").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))


@dataclass
class Level:
    """The contexts of one depth. A context is coded by its place in the level above and its last token; entries by place and token."""

    contexts: np.ndarray  # sorted codes of all that are frequent enough; those kept are marked
    kept: np.ndarray
    log_rest: np.ndarray  # by place: log10 of what a token without an entry gets of its suffix's probability
    entries: np.ndarray  # sorted: place of the context * number of frequent tokens + token
    log_entry: np.ndarray


def _place(ordered: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Where each code is in a sorted array; -1 if it isn't."""
    if not len(ordered):
        return np.full(len(codes), -1)
    at = np.searchsorted(ordered, codes)
    at[at == len(ordered)] = 0
    return np.where(ordered[at] == codes, at, -1)


@dataclass
class Tree:
    """The model: the frequent tokens with their root probabilities, and a level for each depth."""

    total: int  # training tokens
    distinct: int
    discount: float
    keys: list[bytes]  # of the frequent tokens
    counts: np.ndarray  # 0 for those that only held-out texts have
    levels: list[Level] = field(default_factory=list)

    def __post_init__(self):
        self.end = self.keys.index(END.encode()) if END.encode() in self.keys else -1
        root = np.maximum(self.counts - self.discount, 1e-300) / max(self.total, 1)
        self.log_root = np.where(self.counts > 0, np.log10(root), self.log_unknown) if len(self.keys) else np.zeros(0)

    @property
    def log_unknown(self) -> float:
        return float(np.log10(self.discount * self.distinct / self.total)) if self.total else 0.0

    def places(self, ids: np.ndarray, ends: np.ndarray, candidates: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """For each depth, the place of the context that precedes each token; -1 where that is none of the level.

        candidates: codes of one more level.
        """
        h, first = len(self.keys), np.zeros(len(ids), dtype=bool)
        first[np.concatenate([[0], ends[:-1]])[: len(ends)]] = True
        place = np.where(first, -1, 0)  # the empty context, which every first token lacks one token to extend
        before = np.concatenate([[-1], ids[:-1]])
        before[first] = -1
        for contexts in [*(level.contexts for level in self.levels), *([] if candidates is None else [candidates])]:
            code = np.where((place >= 0) & (before >= 0), place * h + before, -1)
            here = _place(contexts, code)
            yield here
            # one longer: what preceded the token before, and that token
            place = np.concatenate([[-1], here[:-1]])
            place[first] = -1

    def log_score(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 probability of each token, without the root's part for tokens that aren't frequent."""
        score = np.where(ids >= 0, self.log_root[ids] if len(self.log_root) else 0.0, 0.0)
        for level, place in zip(self.levels, self.places(ids, ends), strict=True):
            here = np.flatnonzero((place >= 0) & (level.kept[place] if len(level.kept) else False))
            entry = np.where(ids[here] >= 0, _place(level.entries, place[here] * len(self.keys) + ids[here]), -1)
            score[here] += level.log_rest[place[here]]
            score[here[entry >= 0]] = level.log_entry[entry[entry >= 0]]
        return score


class _Index(dict):
    """The ids of frequent tokens; -1 for others."""

    def __missing__(self, token: bytes) -> int:
        return self.get(_key(token), -1) if len(token) > LONGEST else -1


def encode(texts: DataFrame, tree: Tree) -> DataFrame:
    """row, doc_id, learn, ids (of all tokens with the end; -1: not frequent), rare (those tokens, how often) for each of the texts (doc_id, text, learn)."""
    keys = texts.sparkSession.sparkContext.broadcast((tree.keys, tree.end))
    rare = pa.list_(pa.struct([("token", pa.string()), ("times", pa.int32())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("learn", pa.bool_()), ("ids", pa.list_(pa.int32())), ("rare", rare)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = keys.value
        index, row = _Index((k, i) for i, k in enumerate(tokens)), TaskContext.get().partitionId() << 40
        for batch in (part for whole in batches for part in slices(whole, 1)):
            ids, ends, others = array("i"), [0], []
            for text in batch.column(1):
                own = _tokens(text)
                found = list(map(index.__getitem__, own))
                seen = Counter(w for w, i in zip(own, found, strict=True) if i < 0)
                if end < 0:
                    seen[END.encode()] += 1
                others.append([{"token": t.decode(), "times": c} for t, c in seen.items()])
                found.append(end)
                ids.extend(found)
                ends.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, dtype=np.int32)))
            yield pa.record_batch([pa.array(np.arange(row, row + batch.num_rows), pa.int64()), batch.column(0), batch.column(2), lists, pa.array(others, rare)], schema=schema)
            row += batch.num_rows

    return map_arrow(texts.select("doc_id", "text", "learn"), run, "row long, doc_id long, learn boolean, ids array<int>, rare array<struct<token string, times int>>")


def _portions(batch: pa.RecordBatch, lists: int, tokens: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices of about as many tokens, with the ids of each and where each row's end."""
    ends = batch.column(lists).offsets.to_numpy().astype(np.int64)
    values = batch.column(lists).values.to_numpy()
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + tokens, side="right")) - 1)
        yield batch.slice(start, stop - start), values[ends[start] : ends[stop]].astype(np.int64), ends[start + 1 : stop + 1] - ends[start]
        start = stop


def _next_counts(training: DataFrame, tree: Tree, candidates: np.ndarray, least: int) -> list:
    """Rows (place of the context * number of tokens + token, n): how often frequent tokens follow the candidates, if at least ``least`` times."""
    shared = training.sparkSession.sparkContext.broadcast((tree, candidates))
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])
    h = len(tree.keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, contexts = shared.value
        for _, ids, ends in (part for batch in batches for part in _portions(batch, 0, 1 << 20)):
            *_, place = model.places(ids, ends, contexts)
            codes, n = np.unique((place * h + ids)[(place >= 0) & (ids >= 0)], return_counts=True)
            yield pa.record_batch([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], schema=schema)

    counts = map_arrow(training.select("ids"), run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least).collect()


def learn(texts: DataFrame, *, depth: int = DEPTH) -> tuple[Tree, DataFrame, DataFrame]:
    """The tree of the texts (doc_id, text, learn) to learn from, and stored: all token counts (token, n, every), and the texts as of encode()."""
    counts = stored(count_tokens(texts), "token-counts")
    row = counts.where("n > 0").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum((F.col("n") == 1).cast("long")).alias("once"), F.sum((F.col("n") == 2).cast("long")).alias("twice")).first()
    total = row["total"] or 0
    discount = min(0.95, max(0.05, row["once"] / (row["once"] + 2 * row["twice"]))) if row["once"] else DISCOUNT
    least = max(LEAST_COUNT, ceil(sqrt(total) / SPREAD))
    of_context_least = max(LEAST_COUNT, ceil(CONTEXT * sqrt(total) / SPREAD))
    key = F.when(F.octet_length("token") <= LONGEST, F.col("token").cast("binary")).otherwise(F.concat(F.lit(" ").cast("binary"), F.unhex(F.sha1("token"))))
    rows = sorted((bytes(r["key"]), r["n"]) for r in counts.where(F.col("every") >= least).select(key.alias("key"), "n").collect())
    _fits(rows)
    tree = Tree(total, row["distinct"], discount, [k for k, _ in rows], np.array([n for _, n in rows], dtype=np.float64))
    encoded = stored(encode(texts, tree), "token-ids")
    h, training = len(tree.keys), encoded.where("learn")
    candidates = np.flatnonzero((tree.counts >= of_context_least) & (np.arange(h) != tree.end)).astype(np.int64)
    words, of_context = candidates[:, None], tree.counts[candidates]
    for _ in range(depth):
        if not len(candidates):
            break
        if len(candidates) * h >= 1 << 63:
            raise OverflowError("contexts can't be coded in 63 bits; raise LEAST_COUNT")
        rows = _next_counts(training, tree, candidates, least)
        _fits(rows)
        codes = np.array([r["code"] for r in rows], dtype=np.int64)
        n = np.array([r["n"] for r in rows], dtype=np.float64)[np.argsort(codes)]
        codes.sort()
        place, token = codes // h, codes % h
        tree.levels.append(_kept(tree, candidates, words, of_context, place, token, n))
        # contexts one longer: the code of one that is followed often enough by a word is that of the two together
        longer = (n >= of_context_least) & (token != tree.end)
        candidates, of_context = codes[longer], n[longer]
        words = np.concatenate([words[place[longer]], token[longer][:, None]], axis=1)
    return tree, counts, encoded


def _fits(rows: list) -> None:
    if 16 * len(rows) > MOST_BYTES:
        raise MemoryError(f"a table of the tree has {len(rows)} rows, more than workers should hold; raise LEAST_COUNT")


def _kept(tree: Tree, candidates: np.ndarray, words: np.ndarray, of_context: np.ndarray, place: np.ndarray, token: np.ndarray, n: np.ndarray) -> Level:
    """The level of the candidates, those kept that pass the divergence test, with what they store."""
    many = len(candidates)
    # the probability of each stored token in the context's longest kept suffix, scored as the last of a text of its own
    suffixes = np.concatenate([words[place, 1:], token[:, None]], axis=1)
    length = suffixes.shape[1]
    below = 10 ** tree.log_score(suffixes.reshape(-1), np.arange(1, len(token) + 1) * length).reshape(-1, length)[:, -1] if len(token) else np.zeros(0)
    own = (n - DISCOUNT) / of_context[place]
    stored_mass, stored_below = np.bincount(place, own, many), np.bincount(place, below, many)
    rest, rest_below = np.maximum(1 - stored_mass, 1e-12), np.maximum(1 - stored_below, 1e-12)
    entries = np.bincount(place, minlength=many)
    gain = np.bincount(place, n * np.log(own / below), many) + np.maximum(of_context - np.bincount(place, n, many), 0) * np.log(rest / rest_below)
    kept = (gain > 0.5 * np.log(np.maximum(of_context, 2)) * entries) & (entries > 0)
    chosen = kept[place]
    return Level(candidates, kept, np.log10(rest / rest_below), place[chosen] * len(tree.keys) + token[chosen], np.log10(own[chosen]))


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all documents that aren't held out. base_score is that of single tokens with one added to
    each count; score is the tree's log10 probability of the document.

    Defined results: a null or empty text is its end token only; a document with a null id is used for training;
    repeated rows are counted and returned as often as they occur; without any training document every token is unknown
    and has probability one; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tree, counts, encoded = learn(rows.withColumn("learn", ~held_out()), depth=depth)
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    log_total = float(np.log10(tree.total + tree.distinct + 1))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("tree", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        log_count = np.append(np.log10(model.counts + 1), 0.0)  # the last: tokens that aren't frequent, for now
        known = np.append(model.counts > 0, False).astype(np.int64)
        for part, ids, ends in (part for batch in batches for part in _portions(batch, 2)):
            begins = np.concatenate([[0], ends[:-1]])
            sums = [np.add.reduceat(x, begins) for x in (known[ids], log_count[ids], model.log_score(ids, ends))]
            yield pa.record_batch([part.column(0), part.column(1), pa.array(np.diff(ends, prepend=0), pa.int64()), *(pa.array(x, f.type) for x, f in zip(sums, list(schema)[3:], strict=True))], schema=schema)

    found = map_arrow(encoded.select("row", "doc_id", "ids"), run, "row long, doc_id long, n_tokens long, known long, base double, tree double")
    total = float(max(tree.total, 1))
    root = F.when(F.col("n") > 0, F.log10((F.col("n") - tree.discount) / total)).otherwise(F.lit(tree.log_unknown))
    others = encoded.select("row", F.inline("rare")).join(counts.select("token", "n"), "token", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("rare_base"),
        F.sum(F.col("times") * root).alias("rare_tree"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return found.join(others, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("known") + zero("rare_known")).alias("n_known"), F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base") - F.col("n_tokens") * log_total).alias("base_score"), (F.col("tree") + zero("rare_tree")).alias("score"),
    )
