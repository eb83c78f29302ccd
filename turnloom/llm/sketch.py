"""Document fingerprints as threshold-scaled sketches.

A sketch holds every shingle hash below a fixed fraction of the hash range. The fraction is the same for all texts, so
sketches merge by union, and a part of a document can be found in a much longer one: the share of one sketch's hashes
that the other has estimates containment.

A text with fewer than LEAST hashes below that fraction keeps its LEAST smallest ones (or all it has) instead: its
threshold is higher. A sketch's threshold follows from its hashes: none has been left out of a sketch with fewer than
LEAST, and otherwise it is the fraction's or the largest hash kept, whichever is higher. Two sketches are compared below
the lower of their thresholds, where both are complete.

All expressions are row-local SQL functions. Only the text of the next document moves: documents are dealt by ranges
of their id, with the first of each range copied into the range before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.shared import words

#: Words of a shingle; the fraction, one in so many; the least hashes of a sketch.
SHINGLE, ONE_IN, LEAST = 5, 8, 64
#: Bytes of text that a range of ids holds, about, and at most so many ranges.
RANGE_BYTES, MOST_RANGES = 4 << 20, 1 << 16


def sketch(text: Column, shingle: int = SHINGLE, one_in: int = ONE_IN) -> Column:
    """Sorted distinct 64-bit hashes of the text's shingles below 1/one_in of the hash range; for short texts, the smallest LEAST.

    A text with fewer words than a shingle has one shingle of all its words; a null text or one without words an empty
    sketch. For several sketches at a time, sketches() evaluates each step once.
    """
    return _let(words(text), lambda w: _let(_hashes(w, shingle), lambda h: _let(_below(h, one_in), lambda b: _kept(h, b))))


def sketches(df: DataFrame, texts: dict[str, str], shingle: int = SHINGLE, one_in: int = ONE_IN) -> DataFrame:
    """df with the sketches of text columns, {name of the new column: name of the text column}; a column with a new name is replaced."""
    taken = {c.lower() for c in df.columns} | {n.lower() for n in texts}

    def free(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        return name

    steps = {name: tuple(free(f"{name}__{x}") for x in ("words", "hashes", "below")) for name in texts}
    df = df.withColumns({w: words(F.col(texts[name])) for name, (w, _, _) in steps.items()})
    df = df.withColumns({h: _hashes(F.col(w), shingle) for w, h, _ in steps.values()})
    df = df.withColumns({b: _below(F.col(h), one_in) for _, h, b in steps.values()})
    df = df.withColumns({name: _kept(F.col(h), F.col(b)) for name, (_, h, b) in steps.items()})
    return df.drop(*[c for names in steps.values() for c in names])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is evaluated once, not wherever body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _hashes(tokens: Column, shingle: int) -> Column:
    count = F.size(tokens)
    rolled = F.transform(F.sequence(F.lit(0), count - shingle), lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(shingle)]))
    return F.when(count >= shingle, rolled).when(count > 0, F.array(F.xxhash64(F.array_join(tokens, " ")))).otherwise(F.array().cast("array<bigint>"))


def _limit(one_in: int) -> int:
    """Where the fraction ends. Hashes are signed; it counts from the lower end of their range."""
    if one_in < 2:
        raise ValueError("the fraction is one in two or fewer")
    return -(1 << 63) + (1 << 64) // one_in


def _below(hashes: Column, one_in: int) -> Column:
    return F.array_distinct(F.filter(hashes, lambda h: h < F.lit(_limit(one_in))))


def _kept(hashes: Column, below: Column) -> Column:
    return F.when(F.size(below) >= LEAST, F.sort_array(below)).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, LEAST))


def threshold(hashes: Column, one_in: int = ONE_IN) -> Column:
    """The largest value up to which a sketch has every hash of its text."""
    return F.when(F.size(hashes) < LEAST, F.lit((1 << 63) - 1)).otherwise(F.greatest(F.lit(_limit(one_in) - 1), F.get(hashes, F.size(hashes) - 1)))


def _up_to(hashes: Column, limit: Column) -> Column:
    return F.filter(hashes, lambda h: h <= limit)


def _compared(a: Column, b: Column, one_in: int, measure: Callable[[Column, Column, Column], Column]) -> Column:
    """measure of two sketches below both thresholds, and of the number of hashes they share there."""

    def below(x: Column) -> Column:
        lower = F.least(threshold(x["a"], one_in), threshold(x["b"], one_in))
        return _let(lower, lambda limit: F.struct(_up_to(x["a"], limit).alias("a"), _up_to(x["b"], limit).alias("b")))

    def counts(x: Column) -> Column:
        return F.struct(F.size(x["a"]).alias("a"), F.size(x["b"]).alias("b"), F.size(F.array_intersect(x["a"], x["b"])).alias("both"))

    return _let(F.struct(a.alias("a"), b.alias("b")), lambda both: _let(below(both), lambda x: _let(counts(x), lambda n: measure(n["a"], n["b"], n["both"]))))


def resemblance(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """Estimated share of the two texts' shingles that both have (1.0 for two empty sketches)."""
    return _compared(a, b, one_in, lambda a, b, both: F.when(a + b == 0, F.lit(1.0)).otherwise(both / (a + b - both)))


def containment(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """Estimated share of a's shingles that b has: 1.0 for an empty a, null where a has no hash that could tell."""
    return _let(a, lambda x: F.when(F.size(x) == 0, F.lit(1.0)).otherwise(_compared(x, b, one_in, lambda a, b, both: F.when(a > 0, both / a))))


def merged(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """The sketch of what two sketches stand for together."""
    union = _let(F.struct(a.alias("a"), b.alias("b")), lambda x: _let(F.least(threshold(x["a"], one_in), threshold(x["b"], one_in)), lambda limit: _up_to(F.array_union(x["a"], x["b"]), limit)))
    return _let(union, lambda u: _kept(u, _below(u, one_in)))


def shown(hashes: Column) -> Column:
    """A sketch as a string: 16 hex digits per hash."""
    return F.lower(F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _dealt(docs: DataFrame, id_col: str, text_col: str, ranges: int | None) -> DataFrame:
    """doc_id, text, hash, to, guest: the rows dealt by ranges of id and text hash; guests are the first rows of the range behind."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    size = rows.agg(F.count("doc_id").alias("known"), F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    ranges = ranges or min(MOST_RANGES, 1 + (size["bytes"] or 0) // RANGE_BYTES)
    of_null = (size["n"] - size["known"]) * ranges // max(size["n"], 1)  # ranges of rows without an id, besides the first
    steps = [k / ranges for k in range(1, ranges)]
    bounds = sorted(int(b) for b in rows.approxQuantile("doc_id", steps, 0.2 / ranges) or []) if steps and size["known"] else []
    rows = rows.withColumn("to", _range_of(F.col("doc_id"), F.col("hash"), bounds, of_null))
    firsts = {r["to"]: r["first"] for r in rows.groupBy("to").agg(F.min(F.struct("doc_id", "hash")).alias("first")).collect()}
    order, last = sorted(firsts), of_null + len(bounds) + 1
    # by number of the range: the id and hash of its first row, and the range before (before the first comes the last)
    first_id = _numbers([firsts[r]["doc_id"] if r in firsts else None for r in range(last)])
    first_hash = _numbers([firsts[r]["hash"] if r in firsts else None for r in range(last)])
    before = dict(zip(order, [*order[-1:], *order[:-1]], strict=True))
    range_before = _numbers([before.get(r) for r in range(last)])
    is_first = F.col("doc_id").eqNullSafe(F.get(first_id, F.col("to"))) & (F.col("hash") == F.get(first_hash, F.col("to")))
    own = F.struct(F.col("to"), F.lit(0).alias("guest"))
    copy = F.struct(F.get(range_before, F.col("to")).cast("int").alias("to"), F.lit(1).alias("guest"))
    places = F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))).alias("place")
    return rows.select("doc_id", "text", "hash", places).select("doc_id", "text", "hash", "place.to", "place.guest")


def _numbers(values: list[int | None]) -> Column:
    """An array literal that stays one expression however many values there are."""
    return F.split(F.lit(",".join("" if v is None else str(v) for v in values)), ",").try_cast("array<bigint>")


def _range_of(doc_id: Column, of_text: Column, bounds: list[int], of_null: int) -> Column:
    """The number of a row's range: by its id, and where an id is a bound several times over, or null, by the text's hash as well."""

    def part(parts: Column) -> Column:
        """Which of so many equal parts of the hash range."""
        return F.least(F.floor((of_text / F.lit(2.0**64) + 0.5) * parts), parts - 1).cast("int")

    below = _bounds_below(doc_id, bounds)
    same = _bounds_below(doc_id, bounds, equal=True) - below
    found = below + F.when(same > 1, part(same)).otherwise(0) + of_null
    return F.when(doc_id.isNull(), part(F.lit(of_null + 1)) if of_null else F.lit(0)).otherwise(found if bounds else F.lit(of_null))


def _bounds_below(value: Column, bounds: list[int], equal: bool = False) -> Column:
    """How many of the sorted bounds lie below the value (or are equal to it), by binary search; 0 for null."""
    if not bounds:
        return F.lit(0)
    table, n = _numbers(bounds), len(bounds)
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    lies = (lambda bound: bound <= value) if equal else (lambda bound: bound < value)
    return F.aggregate(halves, F.lit(0), lambda found, step: F.when((found + step <= n) & lies(F.get(table, found + step - 1)), found + step).otherwise(found))


def _in_order() -> Window:
    return Window.partitionBy("to").orderBy("guest", F.col("doc_id").asc_nulls_first(), "hash")


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """doc_id, text, next_text, where the next document is that with the next larger id (after the last, the first).

    Null texts become empty. Rows with the same id follow each other in the order of a hash of their texts; a null id
    comes before all others. An only document is its own next one.

    One pass over the ids finds the bounds of ranges (by default of RANGE_BYTES each; only bounds and the first id of each
    range come to the driver), then each text moves once. Very many rows with one id are split by their hash.
    """
    rows = _dealt(docs, id_col, text_col, ranges).withColumn("next_text", F.lead("text").over(_in_order()))
    return rows.where("guest = 0").select("doc_id", "text", "next_text")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter of code points replaced by the first as many (or all) of the following text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def compare_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, one_in: int = ONE_IN) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and its likeness to that and to the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the
    containments contained_in_edited and contained_in_next.

    Defined results: null texts count as empty, and two texts without words are alike (1.0); a containment that no hash
    can tell is null; null ids and ties as in with_next; repeated rows give repeated rows; an empty table gives no rows; other columns are not read.
    """
    rows = _dealt(docs, id_col, text_col, None).withColumn("next_text", F.lead("text").over(_in_order()))
    rows = rows.withColumn("edited", edited(F.col("text"), F.coalesce("next_text", F.lit(""))))
    rows = sketches(rows, {"own": "text", "changed": "edited"}, shingle, one_in)
    rows = rows.select("doc_id", "hash", "to", "guest", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "own", "changed")
    rows = rows.withColumn("following", F.lead("own").over(_in_order())).where("guest = 0")
    own, changed, following = F.col("own"), F.col("changed"), F.col("following")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", shown(own).alias("fingerprint"), shown(changed).alias("edited_fingerprint"),
        resemblance(own, changed, one_in).alias("near_edited"), resemblance(own, following, one_in).alias("near_next"),
        containment(own, changed, one_in).alias("contained_in_edited"), containment(own, following, one_in).alias("contained_in_next"),
    )
