"""Near copies: SimHash candidates and, beyond its radius, shared rare shingles, all verified by exact Jaccard similarity.

Two texts are linked if the sets of their five-word shingles have a similarity of at least 4/5. Groups are the connected
components. Texts with equal sets are one node.

SimHash (simhash.links, fingerprints of the shingle sets) brings the closest nodes together. At a similarity of 0.8 two
fingerprints of 64 bits differ in some ten bits, which no deletion variants reach, so candidates beyond its radius come
from prefixes: two sets of that similarity share a shingle among the first n - ceil(4n/5) + 1 of each, in any order that
all texts agree on. Shingles that many of a sample of texts have come last in that order.

Of shingles that the prefixes of exactly the same nodes have, such as those of a passage that goes from text to text, only
the first in that order counts: for any two of these nodes, no other of them can be the first shingle that they share.

Groups are not expanded into all their pairs. Nodes that share a prefix shingle are first compared with one of them, whose
prefix has the shingle earliest: the most central one. What that links is one component. Only nodes outside of the
component of their shingle's centre are then compared with the others there, and only where the places of the shingle
leave enough of both sets to reach the similarity and the parities of the sets do not rule it out: a shingle flips one
bit, so two sets differ by at least as many shingles as their parities differ by bits (large sets have a second, wider
parity: one with far fewer bits than the set has shingles says little). A pair that is similar meets all
that at the first shingle it shares, so no link between components is lost. Texts of a family that are nearly similar
are still compared pair by pair: a very large family of such texts costs the square of its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.shared import LOWER_ASCII, discard, slices, stored, stored_at
from turnloom.llm.simhash import components, first_of_each, links, text_hash
from turnloom.session import importable, map_arrow

SHINGLE = 5
#: Texts in the sample, and in how many of them a shingle must be to come last; both only bear on cost.
SAMPLE, COMMON = 1 << 14, 4
#: Nodes that share a shingle are dealt to one task more for each so many texts of the sample that have it.
DEALT = 64
#: Pairs that are verified in one piece, about.
PAIRS = 512
#: Bits that mark the texts to verify; others that share a bit are hashed once more for nothing.
MARKED = 1 << 26
#: Longs that hold the parity of a set, and from how many shingles on a set has a second one of how many; all only bear on cost.
PARITY, LARGE, WIDE = 16, 1 << 11, 64
#: Odd multipliers, one for each place of a word in a shingle.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MOST_WORDS, _MOST_NODES = 1 << 15, 1 << 16
#: Bytes of text that are hashed at a time.
_PORTION = 1 << 19


def _hashed(text: str, known: dict[bytes, int]) -> np.ndarray:
    """The hashes of a text's distinct shingles, sorted: words in lower case (A-Z); fewer than five words are one shingle."""
    import xxhash

    if len(known) > _MOST_WORDS:
        known.clear()
    ids = []
    for word in text.encode().translate(LOWER_ASCII).split():
        h = known.get(word)
        if h is None:
            h = known[word] = xxhash.xxh64_intdigest(word, 42)
        ids.append(h)
    if not ids:
        return np.zeros(0, dtype=np.int64)
    words = np.array(ids, dtype=np.uint64)
    size = min(SHINGLE, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        mixed += words[k : k + count] * _PLACES[k]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique((mixed ^ (mixed >> np.uint64(31))).view(np.int64))


def _arrays(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, sets)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *sets]), pa.int64()))


def sets(rows: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """node, shingles: the shingle set of each row (key, text); wanted: bits by key modulo their number, rows without one are left out."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value, {}
        for batch in batches:
            if bits is not None:
                at = batch.column(0).to_numpy() & (8 * len(bits) - 1)
                batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for part in slices(batch, 1, _PORTION):
                own = [_hashed(t.as_py() or "", known) for t in part.column(1)]
                yield pa.record_batch([pa.array(map(_node, own), pa.int64()), _arrays(own)], schema=schema)

    return map_arrow(rows.select("key", "text"), run, "node long, shingles array<long>")


def _bits(keys: DataFrame) -> np.ndarray:
    """A bit for each column value modulo MARKED: of one size whatever the corpus."""
    at = F.pmod("key", F.lit(MARKED)) + 1
    rows = keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    bits = np.zeros(MARKED // 8, dtype=np.uint8)
    for r in rows:
        at_byte = (r["bucket"] - 1) * len(r["bits"])
        bits[at_byte : at_byte + len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bits


def _common(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of which a sample of texts has many, sorted by in how many, then by hash; and in how many."""
    share = SAMPLE / max(rows.count(), 1)
    sample = rows.where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else rows
    counts = sets(sample.dropDuplicates(["key"])).select(F.explode("shingles").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") >= COMMON).toArrow()
    shingles, many = found.column("h").to_numpy(), found.column("n").to_numpy()
    order = np.lexsort((shingles, many))
    return shingles[order], many[order]


def _fingerprints(sets_of: list[np.ndarray]) -> np.ndarray:
    """The SimHash of each set: the bits that over half of its hashes have; 0 for an empty set."""
    sizes = np.array([len(x) for x in sets_of])
    found = np.zeros(len(sets_of), dtype=np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        bits = np.unpackbits(np.concatenate(sets_of).astype("<i8", copy=False).view(np.uint8), bitorder="little").reshape(-1, 64)
        ones = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(sizes[filled])[:-1]]), axis=0, dtype=np.int32)
        found[filled] = np.packbits(2 * ones > sizes[filled, None], axis=1, bitorder="little").view("<i8").reshape(-1)
    return found


def _parity(shingles: np.ndarray, longs: int) -> np.ndarray:
    """A bit for each value of a set's hashes modulo the number of bits: whether an odd number of hashes has it."""
    counts = np.bincount(shingles & (64 * longs - 1), minlength=64 * longs)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def _node(shingles: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(shingles.tobytes(), 7) - (1 << 63)


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash (null for a null text), node (of the shingle set), fp (its SimHash), n (its size), prefix, salts, parity, wide for each row.

    Of copies within a task, only one has a prefix and a parity (else null), and a wide parity if it is large; salts is over how many parts each of its shingles is dealt.
    """
    common, counts = _common(docs.where(F.col(text_col).isNotNull()).select(text_hash(text_col).alias("key"), F.col(text_col).alias("text")))
    ordered = np.argsort(common, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((common[ordered], ordered, 1 + counts[ordered] // DEALT))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    schema = pa.schema([*((name, pa.int64()) for name in ("doc_id", "text_hash", "node", "fp", "n")), ("prefix", pa.list_(pa.int64())), ("salts", pa.list_(pa.int64())), *((name, pa.list_(pa.int64())) for name in ("parity", "wide"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (frequent, rank, parts), known, seen = shared.value, {}, set()
        for batch in (part for whole in batches for part in slices(whole, 2, _PORTION)):
            sets_of = [_hashed(t.as_py() or "", known) for t in batch.column(2)]
            nodes, prefixes, salts, new = [_node(own) for own in sets_of], [], [], []
            for own, node in zip(sets_of, nodes, strict=True):
                parted = np.ones(len(own), dtype=np.int64)
                if node in seen:
                    own, parted = own[:0], parted[:0]
                elif len(frequent) and len(own):
                    place = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                    last = frequent[place] == own
                    order = rank[place[last]].argsort()
                    parted = np.concatenate([parted[~last], parts[place[last]][order]])
                    own = np.concatenate([own[~last], own[last][order]])
                new.append(node not in seen)
                if len(seen) >= _MOST_NODES:
                    seen.clear()
                seen.add(node)
                many = len(own) - (4 * len(own) + 4) // 5 + 1 if len(own) else 0
                prefixes.append(own[:many])
                salts.append(parted[:many])
            parity = pa.array([_parity(own, PARITY) if first else None for own, first in zip(sets_of, new, strict=True)], pa.list_(pa.int64()))
            wide = pa.array([_parity(own, WIDE) if first and len(own) >= LARGE else None for own, first in zip(sets_of, new, strict=True)], pa.list_(pa.int64()))
            columns = [pa.array(nodes, pa.int64()), pa.array(_fingerprints(sets_of), pa.int64()), pa.array([len(x) for x in sets_of], pa.int64()), _arrays(prefixes), _arrays(salts), parity, wide]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], schema=schema)

    return map_arrow(rows, run, "doc_id long, text_hash long, node long, fp long, n long, prefix array<long>, salts array<long>, parity array<long>, wide array<long>")


def members(found: DataFrame) -> DataFrame:
    """h, salt, salts, node, n, at, centre, centre_n, centre_at, stored: nodes by the prefix shingles that several of them have.

    at is the place of h in the prefix, salt the part of salts that the node is dealt to, the centre the node that has h
    earliest. Of shingles that exactly the same nodes have, only the first in the order of all prefixes is there. Sets of
    nodes are told apart by their number and 128 bits of hashes.
    """
    places = found.select("node", F.col("n").cast("int").alias("n"), F.posexplode(F.arrays_zip("prefix", "salts")).alias("at", "of"))
    places = places.select("of.prefix", "node", "n", "at", F.col("of.salts").cast("int").alias("salts")).withColumnRenamed("prefix", "h").withColumn("salt", F.pmod("node", "salts").cast("int"))
    dealt = places.repartition("h", "salt").dropDuplicates(["h", "salt", "node"])
    many = F.count(F.lit(1)).over(Window.partitionBy("h", "salt"))
    dealt, path = stored_at(dealt.withColumn("many", many).where("many > 1 OR salts > 1").drop("many"), "prefix-shingles")
    own = [F.count(F.lit(1)).alias("many"), F.bit_xor("node").alias("nodes"), F.bit_xor(F.xxhash64("node")).alias("hashes")]
    of = dealt.groupBy("h").agg(*own, F.max("salts").alias("salts"), F.min(F.struct("at", "node", "n")).alias("centre"), F.min(F.struct("node", "at")).alias("least")).where("many > 1")
    first = of.groupBy("many", "nodes", "hashes").agg(F.min(F.struct("least.at", "h", "salts", "centre")).alias("first"))
    centres = first.select(F.col("first.h").alias("of_h"), F.explode(F.sequence(F.lit(0), F.col("first.salts") - 1)).alias("of_salt"), F.col("first.centre").alias("of"))
    centre = [F.col("of.node").alias("centre"), F.col("of.n").alias("centre_n"), F.col("of.at").alias("centre_at")]
    shared = stored(dealt.join(centres.hint("merge"), F.expr("h = of_h AND salt = of_salt")).select("h", "salt", "salts", "node", "n", "at", *centre), "shared-shingles")
    discard(found.sparkSession, path)
    return shared


def central_pairs(shared: DataFrame) -> DataFrame:
    """a, b, cell: each node with the centres (b) of its prefix shingles, as far as they may be similar."""
    enough = "9 * (n - at) >= 4 * (n + centre_n) AND 9 * (centre_n - centre_at) >= 4 * (n + centre_n)"
    met = shared.where(f"node <> centre AND {enough}")
    return met.select(F.col("node").alias("a"), F.col("centre").alias("b"), F.col("centre").alias("cell")).distinct()


def other_pairs(shared: DataFrame, nodes: DataFrame, rooted: DataFrame) -> DataFrame:
    """a, b (a > b), cell (a centre): pairs that share a prefix shingle and are in different components (node, root), as far as they may be similar.

    nodes has the parities. One of a pair is outside of the component of the shingle's centre; if both are, they meet once.
    A pair whose first shared shingle stands at some place in each set has at most what is left from there in common.
    """
    of = rooted.select(F.col("node").alias("of_node"), F.col("root").alias("of_root"))
    known = nodes.join(of, F.col("node") == F.col("of_node"), "left").select(F.col("node").alias("known"), F.coalesce("of_root", "node").alias("part_of"), "parity", "wide")
    placed = shared.join(known.hint("merge"), F.col("node") == F.col("known")).join(of, F.col("centre") == F.col("of_node"), "left").withColumn("odd", F.col("part_of") != F.coalesce("of_root", "centre"))
    placed = stored(placed.select("h", "salt", "salts", "node", "n", "at", "centre", "part_of", "odd", "parity", "wide"), "placed")
    odd = placed.where("odd").select(F.col("h").alias("of_h"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("of_salt"), F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("at").alias("x_at"), F.col("part_of").alias("x_part"), F.col("parity").alias("x_parity"), F.col("wide").alias("x_wide"))
    enough = "9 * (n - at) >= 4 * (n + x_n) AND 9 * (x_n - x_at) >= 4 * (n + x_n)"
    differ = " + ".join(f"bit_count(parity[{k}] ^ x_parity[{k}])" for k in range(PARITY))
    of_large = "coalesce(9 * aggregate(zip_with(wide, x_wide, (a, b) -> bit_count(a ^ b)), 0, (sum, bits) -> sum + bits) <= n + x_n, true)"
    once = "part_of <> x_part AND (NOT odd OR node > x)"
    met = placed.join(odd.hint("merge"), F.expr(f"h = of_h AND salt = of_salt AND {once} AND {enough} AND 9 * ({differ}) <= n + x_n AND {of_large}"))
    return met.groupBy(F.greatest("node", "x").alias("a"), F.least("node", "x").alias("b")).agg(F.min("centre").alias("cell"))


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """a, b, cell: nodes (node, fp) with equal fingerprints or such as SimHash links, by one node of each fingerprint."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    equal = nodes.join(first, "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    of = lambda side: first.select(F.col("fp").alias(f"{side}_fp"), F.col("first").alias(side))
    near = links(first.select("fp")).select(F.col("a").alias("a_fp"), F.col("b").alias("b_fp"))
    return equal.unionByName(near.join(of("a"), "a_fp").join(of("b"), "b_fp").select("a", "b")).withColumn("cell", F.col("b"))


def _lists(table: pa.Table) -> dict[int, np.ndarray]:
    lists = table.column("hashes").combine_chunks()
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return {key: values[ends[k] : ends[k + 1]] for k, key in enumerate(table.column("key").to_pylist())}


def _within_reach(pairs: pa.Table, prefixes: pa.Table) -> pa.Table:
    """The pairs whose sets can have a similarity of 4/5, by what their prefixes share and the larger rest of the two."""
    own, sizes = _lists(prefixes), dict(zip(prefixes.column("key").to_pylist(), prefixes.column("n").to_pylist(), strict=True))
    keep, none = [], np.zeros(0, dtype=np.int64)
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        x, y, m, n = own.get(a, none), own.get(b, none), sizes.get(a, 0), sizes.get(b, 0)
        shared = len(np.intersect1d(x, y, assume_unique=True))
        keep.append(9 * (shared + max(m - len(x), n - len(y))) >= 4 * (m + n) and 5 * min(m, n) >= 4 * max(m, n))
    return pairs.filter(pa.array(keep, pa.bool_()))


def _similar(pairs: pa.Table, sets_of: pa.Table) -> pa.Table:
    """The pairs whose sets have a similarity of at least 4/5."""
    own, keep = _lists(sets_of), []
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        keep.append(9 * len(np.intersect1d(own[a], own[b], assume_unique=True)) >= 4 * (len(own[a]) + len(own[b])))
    return pairs.filter(pa.array(keep, pa.bool_()))


def _in_cells(pairs: DataFrame, items: DataFrame, check: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """The pairs (a, b, cell, part) that pass a check of items (key, hashes, ...), each item moved once to each part that needs it."""
    needed = pairs.select(F.col("cell").alias("of_cell"), F.col("part").alias("of_part"), F.explode(F.array("a", "b")).alias("key")).distinct()
    needed = needed.join(items.dropDuplicates(["key"]), "key")
    importable(pairs.sparkSession)
    return pairs.groupBy("cell", "part").cogroup(needed.groupBy("of_cell", "of_part")).applyInArrow(check, "a long, b long, cell long, part int")


def similar(pairs: DataFrame, found: DataFrame, nodes: DataFrame, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets have a similarity of at least 4/5, stored; found: as of features(), nodes: as of each().

    Pairs meet what is needed of their nodes in cells: it moves once to each cell with pairs of its node, not once for each
    pair. Cells with many pairs are dealt to parts of about PAIRS pairs, so that a task never holds more than the sets of
    one part. Prefixes, a fifth of the sets, rule most pairs out; only what is left is compared by whole sets.
    """
    parts = pairs.groupBy("cell").agg((1 + F.floor(F.count(F.lit(1)) / PAIRS)).cast("int").alias("parts")).where("parts > 1")
    dealt = pairs.join(parts, "cell", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("a"), F.col("parts")), F.lit(0)).cast("int"))
    dealt = stored(dealt.select("a", "b", "cell", "part"), "dealt-pairs")
    either = lambda of: of.select(F.col("a").alias("node")).unionByName(of.select(F.col("b").alias("node"))).distinct()
    prefixes = found.where(F.size("prefix") > 0).join(either(dealt), "node", "left_semi").select(F.col("node").alias("key"), "n", F.col("prefix").alias("hashes"))
    likely = stored(_in_cells(dealt, prefixes, _within_reach), "likely-pairs")
    one = stored(nodes.join(either(likely), "node", "left_semi").select(F.xxhash64("first.doc_id", "first.text_hash").alias("key")), "to-verify")
    texts = docs.select(F.xxhash64(F.col(id_col).cast("long"), text_hash(text_col)).alias("key"), F.col(text_col).alias("text"))
    whole, path = stored_at(sets(texts, _bits(one)).withColumnsRenamed({"node": "key", "shingles": "hashes"}), "shingle-sets")
    wanted = whole.join(either(likely).withColumnRenamed("node", "key"), "key", "left_semi")
    kept = stored(_in_cells(likely, wanted, _similar).select("a", "b").distinct(), "links")
    discard(pairs.sparkSession, path)
    return kept


def each(found: DataFrame) -> DataFrame:
    """node, fp, parity, wide, first (its first row: without, doc_id, text_hash) for each node."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")).alias("first")
    return found.groupBy("node").agg(F.min("fp").alias("fp"), *(F.any_value(name, F.lit(True)).alias(name) for name in ("parity", "wide")), first)


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, root: the group of each row."""
    options = {"id_col": id_col, "text_col": text_col}
    found = stored(features(docs, **options), "features")
    shared = members(found)
    nodes = stored(each(found), "nodes")
    both = simhash_pairs(nodes.select("node", "fp")).unionByName(central_pairs(shared))
    first = stored(both.groupBy(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(F.min("cell").alias("cell")), "first-pairs")
    linked = similar(first, found, nodes, docs, **options)
    rooted = components(linked)
    others = stored(other_pairs(shared, nodes, rooted).join(first, ["a", "b"], "left_anti"), "other-pairs")
    if others.head(1):  # components of the links found so far and of those that are new
        stars = rooted.select(F.col("node").alias("a"), F.col("root").alias("b"))
        rooted = components(stars.unionByName(similar(others, found, nodes, docs, **options)))
    return found.join(rooted.select(F.col("node").alias("of_node"), F.col("root").alias("of_root")), F.col("node") == F.col("of_node"), "left").select("doc_id", "text_hash", F.coalesce("of_root", "node").alias("root"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each group of near copies left, all columns as they were.

    The one that stays is chosen as simhash.first_of_each does. Null and empty texts and texts without words have the
    empty set and are one group; a text with fewer than five words is similar to those with the same words only. Rows
    that repeat id and text count once; an empty table gives no rows.
    """
    return first_of_each(docs, groups(docs, id_col=id_col, text_col=text_col), id_col=id_col, text_col=text_col)
