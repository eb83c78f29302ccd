"""SimHash near-duplicate groups by one-wildcard segment variants.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one bit of either their low or their
high half. So a fingerprint is cut into only two segments, and of each segment the 32 variants with one bit struck out
are indexed: fingerprints that are near share a variant. Variants are joined on equality and the candidates verified.
Only distinct fingerprints take part; copies meet in one row before anything is joined.

A variant that very many distinct fingerprints share (one dense cluster) is not joined with itself. There, each
fingerprint is sent to all values that lie one or two bits of the rest away, and linked to one fingerprint that lies
within one bit of such a value: fingerprints three bits apart have a value in between, one bit from one and two bits
from the other. That finds the same groups with a number of rows in proportion to the cluster.

Groups are the connected components of the links, by alternating large-star and small-star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.shared import LOWER_ASCII, stored
from turnloom.session import map_arrow

BITS, SEGMENT, NEAR = 64, 32, 3
#: Distinct fingerprints that share a variant from which on they are linked through values in between.
DENSE = 2048


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text as a signed integer: words in lower case (A-Z), shingles joined by a space, XXH64.

    A text with fewer words than a shingle has one shingle, one without words the fingerprint 0.
    """
    import xxhash

    tokens = text.encode().translate(LOWER_ASCII).split()
    if not tokens:
        return 0
    count, digest = max(1, len(tokens) - shingle + 1), xxhash.xxh64_intdigest
    return majority(np.array([digest(b" ".join(tokens[i : i + shingle]), seed) for i in range(count)], dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed integer; 0 without hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 50_000):
        part = hashes[k : k + 50_000].astype(hashes.dtype.newbyteorder("<"), copy=False)
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, text_hash (null for a null text), fp (the fingerprint as a signed long) for each row. Null texts count as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py() or "", shingle, seed) for t in batch.column(2)], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), found], schema=schema)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text")), run, "doc_id long, text_hash long, fp long")


def text_hash(text_col: str) -> Column:
    return F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col))


def _variants(fps: DataFrame) -> DataFrame:
    """key, fp: 64 rows per fingerprint; the key holds the struck bit and its segment without that bit."""
    bit = F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit")
    segment = "CASE WHEN bit < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END"
    return fps.select("fp", bit).select(F.expr(f"shiftleft(bigint(bit), 32) | (({segment}) & ~shiftleft(1L, bit % 32))").alias("key"), "fp")


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.expr(f"{a} ^ {b}"))


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """a, b (a > b): links between distinct fingerprints that have the same connected components as all links.

    fps: one column fp of distinct values.
    """
    many = F.count(F.lit(1)).over(Window.partitionBy("key"))
    members = stored(_variants(fps).withColumn("n", many).where("n > 1"), "members")

    few = members.where(F.col("n") <= dense)
    left, right = few.select("key", F.col("fp").alias("a")), few.select(F.col("key").alias("other_key"), F.col("fp").alias("b"))
    # two that agree in a whole segment meet in its 32 variants; only the first one counts
    segment = "CASE WHEN shiftrightunsigned(key, 32) < 32 THEN (a ^ b) & 4294967295L ELSE shiftrightunsigned(a ^ b, 32) END"
    struck = "int(shiftrightunsigned(key, 32)) % 32"
    once = F.expr(f"({segment}) = shiftleft(1L, {struck}) OR (({segment}) = 0 AND {struck} = 0)")
    pairs = left.join(right, (F.col("key") == F.col("other_key")) & (F.col("a") > F.col("b")) & (_differ("a", "b") <= NEAR) & once).select("a", "b")
    return pairs.unionByName(_dense_links(members.where(F.col("n") > dense))).distinct()


def _dense_links(members: DataFrame) -> DataFrame:
    """Links within variants that many share, whose members differ in the other segment and the struck bit only."""

    def masks(free: list[int], most: int) -> list[int]:
        found = [sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(free, k)]
        return [m - (1 << 64) if m >> 63 else m for m in found]

    low = F.shiftrightunsigned("key", 32) < 32
    struck = F.expr("shiftleft(1L, int(shiftrightunsigned(key, 32)))")  # bit numbers count through both segments
    of_high, of_low = (F.array(*[F.lit(m).cast("long") for m in masks(free, 2)]) for free in (list(range(32, 64)), list(range(32))))
    with_struck = lambda rest: F.concat(rest, F.transform(F.filter(rest, lambda m: F.bit_count(m) <= 1), lambda m: m.bitwiseXOR(struck)))
    spread = members.select("key", "fp", F.explode(F.when(low, with_struck(of_high)).otherwise(with_struck(of_low))).alias("mask")).select("key", "fp", F.expr("fp ^ mask").alias("value"), (F.bit_count("mask") <= 1).alias("close"))
    centre = spread.where("close").groupBy("key", "value").agg(F.min("fp").alias("centre"))
    met = spread.join(centre, ["key", "value"]).where("fp <> centre")
    return met.select(F.greatest("fp", "centre").alias("a"), F.least("fp", "centre").alias("b"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: for each node of the edges (a, b), the smallest node that it is connected to.

    Each round is written to the shared folder; it ends when a round changes nothing.
    """
    stars = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("centre")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.where("b > a").join(least, F.col("a") == F.col("centre")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy(F.col("a").alias("centre")).agg(F.min("b").alias("least"))
        small = large.join(lowest, F.col("a") == F.col("centre")).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        stars = stored(small.unionByName(lowest.select(F.col("centre").alias("a"), F.col("least").alias("b"))).where("a <> b").distinct(), "stars")
        row = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int, dense: int) -> DataFrame:
    """doc_id, text_hash, fp, root (the smallest fingerprint of the component), component_id for each row."""
    found = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed), "fingerprints")
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    rooted = components(links(distinct.select("fp"), dense))
    classes = distinct.join(rooted, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = stored(classes.join(ids, "root").select(F.col("fp").alias("class_fp"), "root", "component_id"), "classes")
    return found.join(classes, F.col("fp") == F.col("class_fp")).select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, dense: int = DENSE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Fingerprints link at three or fewer differing bits.

    Defined results: null and empty texts and texts without words have fingerprint 0 and are linked like any other;
    a null id stays null, and a component without any id has component_id null; repeated rows give repeated rows; whole
    texts count; an empty table gives no rows; other columns are not read.
    """
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _grouped(docs, id_col, text_col, shingle, seed, dense).select("doc_id", shown, "component_id")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, dense: int = DENSE) -> DataFrame:
    """The documents with one of each group left, all columns as they were.

    The one that stays is that with the group's smallest id (of several with that id, the one with the smallest text
    hash); a group without any id keeps the one with the smallest text hash. Rows that repeat id and text count once.
    """
    return first_of_each(docs, _grouped(docs, id_col, text_col, shingle, seed, dense), id_col=id_col, text_col=text_col)


def first_of_each(docs: DataFrame, grouped: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first document of each group, as one_of_each chooses it; grouped: doc_id, text_hash, root for each row of docs.

    Rows are chosen by two keys, of id and text and of the text. Those that go are struck out by an anti-join, which moves
    no text while their keys are few enough for Spark to broadcast; rows that repeat id and text are merged apart from it.
    """
    keys = ["_key_of_row", "_key_of_text"]
    while {k.lower() for k in keys} & {c.lower() for c in docs.columns}:
        keys = [k + "_" for k in keys]

    def keyed(doc_id: Column, of_text: Column) -> list[Column]:
        return [F.xxhash64(F.lit(1), doc_id.isNull(), doc_id, of_text.isNull(), of_text).alias(keys[0]), F.coalesce(of_text, F.lit(0)).alias(keys[1])]

    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")).alias("first")
    rows = stored(grouped.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times")), "distinct-rows")
    kept = stored(rows.groupBy("root").agg(first).select(*keyed(F.col("first.doc_id"), F.col("first.text_hash"))), "kept")
    of_rows = rows.select(*keyed(F.col("doc_id"), F.col("text_hash")), "times")
    gone = stored(of_rows.join(kept, keys, "left_anti").select(*keys), "gone")
    repeated = stored(of_rows.where("times > 1").join(kept, keys, "left_semi").select(*keys), "repeated")
    marked = docs.select("*", *keyed(F.col(id_col).cast("long"), text_hash(text_col)))
    single = marked.join(gone.unionByName(repeated), keys, "left_anti")
    if not repeated.head(1):
        return single.drop(*keys)
    return single.unionByName(marked.join(repeated, keys, "left_semi").dropDuplicates(keys)).drop(*keys)
