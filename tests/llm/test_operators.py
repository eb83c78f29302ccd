"""The training-data operators against brute force on small material with nulls, ties, repeats and clashing columns."""

import base64
import hashlib
import math
import random
import re
import time
import unicodedata
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from turnloom.llm import chat_format, html_text, line_dedup, near_copies, packing, pieces, quality_rules, queries, simhash, sketch, suffix_tree, warc  # noqa: E402

WHITE = " \t\n\x0b\x0c\r"
BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with columns whose names clash with those of results."""
    rng = random.Random(7)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "the", "of", "ε", "##", "x\x85y", "|"]
    rows = [(None, "no id"), (None, "no id"), (None, None), (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two"), (5, "one two"), (5, "one two"), (5, "other text with this id"), (6, "é" * 50_000), (7, "a b c " * 3000), (-3, "a\n\nb\nc\na\nb\nc\nd")]
    rows += [(100 + k, "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "  "]) for _ in range(rng.randint(0, 260)))) for k in range(60)]
    rows += [(200 + k, rows[20][1].replace("alpha", "beta", k % 3)) for k in range(20)]
    return spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], "doc_id long, text string, n_chars long, words string, fingerprint string, key int")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def by_sql(spark, df, sql, **tables):
    c = duckdb.connect()
    for name, table in tables.items():
        pdf = table.toPandas()
        c.register(name, pdf)
    cursor = c.execute(sql)
    columns = [x[0] for x in cursor.description]
    return got(df, *columns), sorted(cursor.fetchall(), key=str)


# quality rules


def measures(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(docs, plain):
    judged = quality_rules.judged(docs)
    assert judged.columns == [*docs.columns, "verdict"]
    found = got(judged, "doc_id", *[f"verdict.{m}" for m in quality_rules.MEASURES[:5]], "verdict.base_failed")
    expected = [(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, m in ((i, measures(t)) for i, t in plain)]
    assert found == sorted(expected, key=str)
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns and got(kept, "doc_id") == got(judged.where("verdict.kept"), "doc_id")
    assert quality_rules.judged(docs.limit(0)).count() == 0


def brute_fit(patterns, rounds=quality_rules.ROUNDS):
    many = len(patterns[0][0])
    prior, good, bad = quality_rules.START_PRIOR, [quality_rules.START_GOOD] * many, [quality_rules.START_BAD] * many
    bounded = lambda p: max(quality_rules.LEAST, min(quality_rules.MOST, p))
    for _ in range(rounds):
        expected = []
        for votes, n in patterns:
            a, b = prior, 1 - prior
            for v, g, w in zip(votes, good, bad, strict=True):
                a *= g if v == 1 else 1 - g if v == -1 else 1
                b *= 1 - w if v == 1 else w if v == -1 else 1
            expected.append(n * a / (a + b))
        old = (prior, *good, *bad)
        s = quality_rules.SMOOTHING
        share = lambda j, vote, weights, start: bounded((sum(x for x, (v, _) in zip(weights, patterns, strict=True) if v[j] == vote) + s * start) / (sum(x for x, (v, _) in zip(weights, patterns, strict=True) if v[j]) + s))
        rest = [n - e for e, (_, n) in zip(expected, patterns, strict=True)]
        prior = bounded(sum(expected) / sum(n for _, n in patterns))
        good = [share(j, 1, expected, quality_rules.START_GOOD) for j in range(many)]
        bad = [max(share(j, -1, rest, quality_rules.START_BAD), 1 - good[j]) for j in range(many)]
        if max(abs(x - y) for x, y in zip(old, (prior, *good, *bad), strict=True)) < quality_rules.SETTLED:
            break
    return prior, good, bad


def test_quality_fit(spark):
    patterns = [([1, 1, 0], 900), ([1, -1, -1], 30), ([-1, -1, -1], 60), ([0, 1, -1], 10), ([1, 1, -1], 5)]
    fit = quality_rules.fit(spark.createDataFrame(patterns, "votes array<int>, n long"), 3)
    prior, good, bad = brute_fit(patterns)
    assert np.allclose([fit.prior, *fit.good, *fit.bad], [prior, *good, *bad])
    posterior = [r[0] for r in spark.createDataFrame(patterns, "votes array<int>, n long").select(fit.posterior(F.col("votes"))).collect()]
    assert posterior[0] > 0.9 > 0.1 > posterior[2]


def test_quality_verdicts_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]

    def votes(text):
        n, chars, symbols, dup, repeat = measures(text)
        lines = sum(bool(words(x)) for x in text.split("\n"))
        letters, capitals = sum(c.isalpha() and not unicodedata.category(c).startswith("N") for c in text), sum(unicodedata.category(c) == "Lu" for c in text)
        rules = [
            (n >= 80, n < 50), (3 * n <= chars <= 9 * n, chars < 2 * n or chars > 14 * n), (50 * symbols <= n, 10 * symbols > n), (10 * dup <= lines, 10 * dup > 3 * lines),
            (10 * repeat <= n, 10 * repeat > 3 * n), (100 * letters >= 92 * chars, 100 * letters < 88 * chars), (10 * capitals <= 2 * letters, 10 * capitals > 5 * letters),
        ]
        return tuple(1 if good else -1 if bad else 0 for good, bad in rules), n < 50 or 100 * repeat > 50 * n

    cast = {i: votes(t) for i, t in plain}
    prior, good, bad = brute_fit([(list(v), n) for v, n in Counter(v for v, _ in cast.values()).items()])
    expected = []
    for i, (v, failed) in cast.items():
        a, b = prior, 1 - prior
        for x, g, w in zip(v, good, bad, strict=True):
            a, b = a * (g if x == 1 else 1 - g if x == -1 else 1), b * (1 - w if x == 1 else w if x == -1 else 1)
        expected.append((i, v, round(a / (a + b), 6), not failed and a / (a + b) >= quality_rules.THRESHOLD))
    found = [(r["doc_id"], tuple(r["votes"]), round(r["posterior"], 6), r["kept"]) for r in quality_rules.judged(docs).select("doc_id", "verdict.votes", "verdict.posterior", "verdict.kept").collect()]
    assert sorted(found) == sorted(expected)


def test_quality_keeps_clean(spark, sf):
    judged = quality_rules.judged(spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id"))
    clean = judged.where("quality = 1 AND NOT verdict.base_failed")
    junk = judged.where("quality = 0")
    assert clean.where("NOT verdict.kept").count() == 0
    assert junk.where("verdict.kept").count() <= 0.5 * junk.count()


# chat


def test_chat_collapse(spark):
    turn = lambda c, *texts: [(c, k, "user" if k % 2 == 0 else "assistant", t, 9) for k, t in enumerate(texts)]
    rows = turn(1, "a", "b") + turn(2, "a", "b", "c") + turn(3, "a", "b", "c") + turn(4, "a") + turn(5, "b") + turn(6, "ab") + turn(7, "a", "") + [(8, None, None, None, 9), (8, None, None, None, 9), (None, 0, "user", "b", 9)]
    df = spark.createDataFrame([(c, None if t is None else t * 5 + 3, r, x, p) for c, t, r, x, p in rows], "conv_id long, turn long, role string, text string, position int")
    found = got(chat_format.render(df))
    keep = {2: "abc", 5: "b", 6: "ab", 7: "a"}
    assert [r[0] for r in found] == [2, 5, 6, 7, 8]
    assert found[0] == (2, 0, 3, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n") and keep
    assert found[-1] == (8, 0, 1, "<|im_start|>unknown\n<|im_end|>\n")
    assert chat_format.render(df.limit(0)).count() == 0


def test_chat_ties_and_long_texts_as_in_sql(spark):
    rng = random.Random(8)
    rows = [(c, rng.randint(0, 3), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", None, "", "é" * 30_000, "<|im_end|>"])) for c in range(30) for _ in range(6)]
    rows += [(100 + k, 0, "user", "same") for k in range(50)] + [(200, None, "user", "x"), (200, None, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found, expected = by_sql(spark, chat_format.render(df), chat_format.sql(), conversations=df)
    assert found == expected and len(found) < len({r[0] for r in rows})


def test_chat_blocks(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.choice("abc") for _ in range(40)]
    rows = [(c, k, "user", t) for c, n in enumerate((40, 7, 13, 40, 1)) for k, t in enumerate(base[:n])] + [(9, k, "user", t) for k, t in enumerate(["z", *base])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(chat_format, "BLOCK", 4)
    found = got(chat_format.render(df), "conv_id", "part", "n_turns")
    assert found == sorted([(0, p, 4) for p in range(10)] + [(9, p, 4) for p in range(10)] + [(9, 10, 1)], key=str)


# packing


def sequences(rows):
    by = {}
    for doc, start, length, crc, total, seq, offset in rows:
        by.setdefault(seq, []).append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return by


def test_packing_is_whole(docs, plain):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    rows = [tuple(r) for r in packing.pack(docs, BYTE_BPE).collect()]
    by = sequences(rows)
    expected = Counter()
    for i, t in plain:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        expected[i, len(ids)] += len(ids)
    assert Counter({k: v for k, v in expected.items()}) == sum((Counter({(r[0], r[4]): r[2]}) for r in rows), Counter())
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in plain if i not in (None, 5)}
    for doc, start, length, crc, total, _, _ in rows:
        if doc in ids:
            assert total == len(ids[doc]) and crc == zlib.crc32(ids[doc][start : start + length].tobytes())
    used = sum(r[2] for r in rows)
    assert len(by) * 1024 <= used * 1.1 + 1024 * docs.rdd.getNumPartitions()
    assert packing.pack(docs.limit(0), BYTE_BPE).count() == 0


def test_differencing():
    rng = random.Random(5)
    for _ in range(50):
        sizes = [rng.randint(1, 256) for _ in range(rng.randint(1, 300))]
        window = packing.balanced(sizes, 1024)
        sums = np.bincount(window, weights=sizes)
        assert len(window) == len(sizes) and sums.max() <= 1024 and sums.sum() == sum(sizes)
        if len(sizes) > 60:
            assert sums.max() - sums.min() <= 64
    assert sorted(packing.spread([8, 7, 6, 5, 4], 2).tolist()) in ([0, 0, 0, 1, 1], [0, 0, 1, 1, 1])
    assert packing.balanced([1000, 1000, 100], 1024).max() == 2  # two windows would do for the sum, not for the pieces


def test_encoder_of_merges_out_of_order(tmp_path):
    import json

    from tokenizers import Tokenizer

    spec = json.loads(open(BYTE_BPE, encoding="utf-8").read())
    merges = spec["model"]["merges"]
    merges[:200] = merges[199::-1]
    path = str(tmp_path / "other.json")
    open(path, "w", encoding="utf-8").write(json.dumps(spec))
    encode, library = packing.Encoder(path), Tokenizer.from_file(path)
    texts = ["the other there is in an anthem", "then  again\n\nthey"]
    assert not encode.in_order and packing.encoder(BYTE_BPE).in_order
    assert [x.tolist() for x in encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    library, encode, rng = Tokenizer.from_file(BYTE_BPE), packing.encoder(BYTE_BPE), random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "é", "😀", "'s", "9", ".", "<|endoftext|>", "​", "会"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


# SimHash


def brute_fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 3:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash(docs, plain):
    fps = {(i, t): brute_fingerprint(t) for i, t in plain}
    root = groups(set(fps.values()))
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    expected = sorted(((i, f"{fps[i, t]:016x}", least.get(root[fps[i, t]])) for i, t in plain), key=str)
    assert got(simhash.near_duplicates(docs)) == expected
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and one.count() == len(set(root.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("dense", [0, 3, 2048])
def test_links_in_dense_clusters(spark, dense):
    rng = random.Random(11)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for centre in list(fps)[:4]:
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(40)}
    fps |= {0, 7, 1 << 63, (1 << 63) | 3, (1 << 64) - 1}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(df, dense)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in ((r["a"], r["b"]) for r in edges.collect()))
    expected = {}
    for f, r in groups(fps).items():
        expected.setdefault(r, set()).add(signed(f))
    found = {}
    for r in simhash.components(edges).collect():
        found.setdefault(r["root"], {r["root"]}).add(r["node"])
    assert sorted(map(sorted, found.values())) == sorted(sorted(x) for x in expected.values() if len(x) > 1)


# near copies by Jaccard similarity


def shingles(text):
    own = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def jaccard_survivors(rows):
    """The ids that stay, by comparing all pairs of (id, text)."""
    found, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if root[a] != root[b] and 5 * len(found[a] & found[b]) >= 4 * len(found[a] | found[b]):
                root = [root[b] if r == root[a] else r for r in root]
    order = lambda k: (rows[k][0] is None, rows[k][0] or 0)
    return {rows[min((k for k in range(len(rows)) if root[k] == r), key=order)][0] for r in set(root)}


@pytest.mark.parametrize("common", [8, 2])
def test_near_copies(spark, docs, plain, monkeypatch, common):
    monkeypatch.setattr(near_copies, "COMMON", common)
    rng = random.Random(11)
    rows = list(plain)
    for k in range(40):  # copies with a few words changed, on both sides of the limit
        text = [rng.choice("abcdefghijklmnopqrst") * rng.randint(1, 4) for _ in range(rng.randint(5, 200))]
        rows.append((1000 + 10 * k, " ".join(text)))
        for c in range(1, 5):
            copy = list(text)
            for at in rng.sample(range(len(copy)), min(len(copy), rng.randint(1, 1 + len(copy) // 30))):
                copy[at] = "changed"
            rows.append((1000 + 10 * k + c, " ".join(copy)))

    expected = jaccard_survivors(rows)
    far = 0
    for a, b in combinations(range(len(plain), len(rows)), 2):
        x, y = shingles(rows[a][1]), shingles(rows[b][1])
        far += 5 * len(x & y) >= 4 * len(x | y) and (simhash.fingerprint(rows[a][1], 5) ^ simhash.fingerprint(rows[b][1], 5)).bit_count() > simhash.NEAR
    assert far > 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in near_copies.one_of_each(df).collect()} == expected
    if common == 8:
        assert near_copies.one_of_each(docs).columns == docs.columns and near_copies.one_of_each(docs.limit(0)).count() == 0


def test_near_copies_of_one_family(spark, monkeypatch):
    """Many texts of one origin: more than one part per shingle, chains beyond the similarity of their ends, and pairs dealt to tasks."""
    monkeypatch.setattr(near_copies, "DEALT", 8)
    monkeypatch.setattr(near_copies, "PAIRS", 16)
    rng = random.Random(12)
    base = [f"w{k}" for k in range(140)]
    rows = []
    for k in range(150):
        copy = list(base)
        for at in rng.sample(range(140), rng.randint(0, 5)):
            copy[at] = f"x{rng.random()}"
        rows.append((k, " ".join(copy)))
    chain = [f"c{k}" for k in range(90)]
    for k in range(40):
        chain[2 * k] = f"y{k}"
        rows.append((1000 + k, " ".join(chain)))
    got_pairs = near_copies.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {}
    for r in got_pairs.collect():
        found.setdefault(r["root"], []).append(r["doc_id"])
    assert {min(x) for x in found.values()} == jaccard_survivors(rows)


@pytest.mark.parametrize("large", [near_copies.LARGE, 64])
def test_near_copies_of_shared_passages(spark, monkeypatch, large):
    """Texts made of the same passages: a shingle counts once for its set of texts, unlike texts are ruled out unmet, similar ones are not."""
    monkeypatch.setattr(near_copies, "LARGE", large)
    rng = random.Random(13)
    passages = [[f"p{k}w{w}" for w in range(30)] for k in range(20)]
    rows = []
    for k in range(60):
        text = [w for p in rng.sample(passages, 6) for w in p]
        rows.append((2 * k, " ".join(text)))
        for at in rng.sample(range(len(text)), rng.randint(1, 6)):
            text[at] = f"x{k}"
        rows.append((2 * k + 1, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_copies.features(df)
    assert all((r["wide"] is not None) == (r["n"] >= large) for r in found.collect())
    shared = near_copies.members(found).localCheckpoint()
    having = {}
    for r in shared.collect():
        having.setdefault(r["h"], set()).add(r["node"])
    assert len({frozenset(x) for x in having.values()}) == len(having) and min(map(len, having.values())) > 1

    unlinked = spark.createDataFrame([], "node long, root long")
    met = {(r["a"], r["b"]) for r in near_copies.other_pairs(shared, near_copies.each(found), unlinked).collect()}
    node = {r["doc_id"]: r["node"] for r in found.collect()}
    seen = 0
    for (i, x), (j, y) in combinations(rows, 2):
        x, y = shingles(x), shingles(y)
        pair = max(node[i], node[j]), min(node[i], node[j])
        if 5 * len(x & y) >= 4 * len(x | y):
            seen += 1
            assert pair in met
        elif 2 * len(x & y) < len(x | y):
            assert pair not in met
    assert seen > 20
    assert {r["doc_id"] for r in near_copies.one_of_each(df).collect()} == jaccard_survivors(rows)


# sketches


def brute_sketch(text):
    def rolled(tokens):
        h = 42
        for t in tokens:
            h = xxhash.xxh64_intdigest(t.encode(), h)
        return h - (1 << 64) if h >> 63 else h

    w = words(text)
    every = {rolled(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {rolled([" ".join(w)])} if w else set()
    below = sorted(h for h in every if h < -(1 << 63) + (1 << 64) // sketch.ONE_IN)
    kept = below if len(below) >= sketch.LEAST else sorted(every)[: sketch.LEAST]
    limit = (1 << 63) - 1 if len(kept) < sketch.LEAST else max(-(1 << 63) + (1 << 64) // sketch.ONE_IN - 1, kept[-1])
    return kept, limit, every


def brute_likeness(a, b):
    limit = min(a[1], b[1])
    x, y = ({h for h in s[0] if h <= limit} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_sketch(docs, plain):
    key = lambda r: (r[0] is not None, r[0] or 0)
    found = {r["doc_id"]: r for r in sketch.compare_edits(docs).collect()}
    order = [r for r in sorted(((i, t or "") for i, t in plain), key=key)]
    unique = Counter(i for i, _ in order)
    shown = lambda s: "".join(f"{h & (1 << 64) - 1:016x}" for h in s[0])
    errors = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)]
        if unique[i] > 1 or unique[following[0]] > 1:
            continue
        q = len(t) // 4
        changed = t[: len(t) - q] + following[1][:q]
        r, own, other, next_own = found[i], brute_sketch(t), brute_sketch(changed), brute_sketch(following[1])
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == shown(own) and r["edited_fingerprint"] == shown(other)
        assert abs(r["near_edited"] - brute_likeness(own, other)) < 1e-12 and abs(r["near_next"] - brute_likeness(own, next_own)) < 1e-12
        errors.append(abs(r["near_edited"] - (len(own[2] & other[2]) / len(own[2] | other[2]) if own[2] | other[2] else 1.0)))
    assert len(errors) > 50 and np.mean(errors) < 0.03
    assert sketch.compare_edits(docs).count() == len(plain) and sketch.compare_edits(docs.limit(0)).count() == 0


def test_sketch_estimates(spark):
    rng = random.Random(2)
    w = [f"w{rng.randint(0, 10**6)}" for _ in range(8000)]
    df = spark.createDataFrame([(" ".join(w), " ".join(w[:2000]), " ".join(w[4000:] + ["z"] * 5))], "a string, b string, c string")
    a, b, c = (sketch.sketch(F.col(x)) for x in "abc")
    row = df.select(sketch.containment(b, a).alias("whole"), sketch.containment(a, b).alias("quarter"), sketch.resemblance(a, c).alias("half"), (sketch.merged(b, c) == sketch.sketch(F.concat_ws(" ", "b", "c"))).alias("merged"), F.size(a).alias("n")).first()
    assert row["whole"] == 1.0 and abs(row["quarter"] - 0.25) < 0.05 and abs(row["half"] - 0.5) < 0.06 and abs(row["n"] - 1000) < 150
    with pytest.raises(ValueError):
        sketch.sketch(F.col("a"), one_in=1)


def test_short_passages_are_never_found_missing(spark):
    rng = random.Random(3)
    w = [f"w{rng.randint(0, 10**6)}" for _ in range(1000)]
    rows = [(" ".join(w), " ".join(w[k * 5 : k * 5 + 8]), " ".join(f"x{rng.random()}" for _ in range(8))) for k in range(190)]
    df = spark.createDataFrame(rows, "long string, part string, other string").withColumns({"word": F.lit("x"), "own": F.lit(1), "own__below": F.lit(2), "OWN__words": F.lit(3)})
    made = sketch.sketches(df, {"own": "long", "p": "part", "q": "other"})
    assert {"own__below", "OWN__words", "word"} <= set(made.columns) and made.where("own__below <> 2").count() == 0
    found = made.select(sketch.containment(F.col("p"), F.col("own")).alias("inside"), sketch.containment(F.col("q"), F.col("own")).alias("apart"), sketch.resemblance(F.col("p"), F.col("p")).alias("self")).collect()
    assert {r["inside"] for r in found} == {None, 1.0} and {r["apart"] for r in found} == {None, 0.0} and {r["self"] for r in found} == {1.0}


def test_next_with_one_id_for_many(spark):
    rng = random.Random(4)
    rows = [(7, f"seven {k}") for k in range(60)] + [(None, f"none {k}") for k in range(40)] + [(k, f"t{k}") for k in range(20)] + [((1 << 63) - 1, "last"), (-(1 << 63), "first")]
    rng.shuffle(rows)
    found = sketch.with_next(spark.createDataFrame(rows, "doc_id long, text string"), ranges=12).collect()
    after = {r["text"]: r["next_text"] for r in found}
    assert len(found) == len(rows) == len(after) == len(set(after.values()))
    at, order = "first", []
    for _ in rows:
        order.append(at)
        at = after[at]
    place = {t: k for k, t in enumerate(order)}
    ids = [i for i, t in sorted(rows, key=lambda r: place[r[1]])]
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and ids[len(known) :] == [None] * 40


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_next_over_ranges(spark, ranges):
    df = spark.createDataFrame([(k * k, f"t{k}") for k in range(40)], "doc_id long, text string")
    assert got(sketch.with_next(df, ranges=ranges)) == sorted([(k * k, f"t{k}", f"t{(k + 1) % 40}") for k in range(40)], key=str)


# language model


def test_scores(docs, plain):
    tokens = [(i, [w.decode() for w in (t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()] + [""]) for i, t in plain]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 5)) for i, ws in tokens), key=str)
    found = suffix_tree.score(docs)
    assert sorted(((*r[:5], round(r[5], 5)) for r in (tuple(x) for x in found.collect())), key=str) == expected
    assert all(r["score"] < 0 for r in found.collect()) and suffix_tree.score(docs.limit(0)).count() == 0


class BruteTree:
    """The tree of the docstring, in dictionaries."""

    def __init__(self, training, others, depth):
        n, every = Counter(w for ws in training for w in ws), Counter(w for ws in training + others for w in ws)
        self.n, self.total = n, sum(n.values())
        once, twice = sum(c == 1 for c in n.values()), sum(c == 2 for c in n.values())
        self.discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else suffix_tree.DISCOUNT
        least = max(suffix_tree.LEAST_COUNT, math.ceil(math.sqrt(self.total) / suffix_tree.SPREAD))
        of_context = max(suffix_tree.LEAST_COUNT, math.ceil(suffix_tree.CONTEXT * math.sqrt(self.total) / suffix_tree.SPREAD))
        frequent = {w for w, c in every.items() if c >= least}
        self.kept, self.candidates = {}, 0
        contexts = {(w,): n[w] for w in frequent if n[w] >= of_context and w}
        for d in range(1, depth + 1):
            self.candidates += len(contexts)
            follow = {c: Counter() for c in contexts}
            for ws in training:
                for k in range(d, len(ws)):
                    if tuple(ws[k - d : k]) in follow and ws[k] in frequent:
                        follow[tuple(ws[k - d : k])][ws[k]] += 1
            follow = {c: {w: m for w, m in f.items() if m >= least} for c, f in follow.items()}
            level = {}
            for c, f in follow.items():
                below = {w: self.probability(c[1:], w) for w in f}
                own = {w: (m - suffix_tree.DISCOUNT) / contexts[c] for w, m in f.items()}
                rest, rest_below = max(1 - sum(own.values()), 1e-12), max(1 - sum(below.values()), 1e-12)
                gain = sum(m * math.log(own[w] / below[w]) for w, m in f.items()) + (contexts[c] - sum(f.values())) * math.log(rest / rest_below)
                if f and gain > 0.5 * math.log(max(contexts[c], 2)) * len(f):
                    level[c] = (own, rest / rest_below)
            self.kept.update(level)
            contexts = {(*c, w): m for c, f in follow.items() for w, m in f.items() if m >= of_context and w}

    def probability(self, context, word):
        for k in range(len(context)):
            if context[k:] in self.kept:
                own, rest = self.kept[context[k:]]
                return own[word] if word in own else rest * self.probability(context[k + 1 :], word)
        return (self.n[word] - self.discount) / self.total if self.n[word] else self.discount * len(self.n) / self.total


@pytest.mark.parametrize("depth", [3, 4])
def test_scores_equal_brute_force(spark, sf, depth):
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(spark.createDataFrame([(100_000 + k, "one two three four five six " * 9 + "-" * 80 + " x" * (k % 5), "", "", 0) for k in range(30)], "doc_id long, text string, lang string, source string, n_chars long"))
    rows = [(r["doc_id"], re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode().translate(suffix_tree.LOWER_ASCII))) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, [w.decode() for w in ws] + [""]) for i, ws in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tree = BruteTree([ws for i, ws in rows if not held(i)], [ws for i, ws in rows if held(i)], depth)
    expected = {i: sum(math.log10(tree.probability(tuple(ws[max(0, k - depth) : k]), w)) for k, w in enumerate(ws)) for i, ws in rows}
    found = {r["doc_id"]: r["score"] for r in suffix_tree.score(docs, depth=depth).collect()}
    assert found.keys() == expected.keys() and all(abs(found[i] - expected[i]) < 1e-6 * max(1, abs(expected[i])) for i in found)
    assert any(len(c) == depth for c in tree.kept) and len(tree.kept) > 100


def test_tree_is_a_distribution_and_beats_the_base(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tree, counts, _ = suffix_tree.learn(docs.select("doc_id", "text", (~suffix_tree.held_out()).alias("learn")))
    everything = {r["token"]: r["n"] for r in counts.collect()}
    root = sum((n - tree.discount) / tree.total for n in everything.values() if n) + 10**tree.log_unknown
    assert abs(root - 1) < 1e-9
    h = len(tree.keys)
    rare = sum((n - tree.discount) / tree.total for t, n in everything.items() if n and suffix_tree._key(t.encode()) not in set(tree.keys)) + 10**tree.log_unknown
    known = np.flatnonzero(tree.counts > 0)
    words = [(int(c),) for c in tree.levels[0].contexts]
    for depth, level in enumerate(tree.levels, 1):
        if depth > 1:
            words = [(*words[c // h], c % h) for c in level.contexts.tolist()]
        for k in np.flatnonzero(level.kept)[:: max(1, int(level.kept.sum()) // 20)].tolist():
            ids = np.array([[*words[k], w] for w in known]).reshape(-1)
            each = 10 ** tree.log_score(ids, np.arange(1, len(known) + 1) * (depth + 1)).reshape(len(known), depth + 1)[:, -1]
            other = 10 ** tree.log_score(np.array([*words[k], -1]), np.array([depth + 1]))[-1]
            assert abs(each.sum() + other * rare - 1) < 1e-6
    unseen = suffix_tree.score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert tree.levels[0].kept.any() and unseen[0] > unseen[1]


# pieces


def test_pieces(docs, plain):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = []
    for i, t in plain:
        ids = [*library.encode(t or ""), library.eos_id()]
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got(pieces.encode(docs, PIECES, digests=True)) == sorted(expected, key=str)
    assert pieces.encode(docs.limit(0), PIECES).count() == 0
    encoded = pieces.encode(docs, PIECES)
    assert pieces.decode(encoded.limit(0), PIECES).count() == 0 and got(pieces.decode(encoded.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("array<int>").alias("ids"), F.lit(1).alias("decoded")).limit(1), PIECES)) == [(None, "")]
    assert got(pieces.decode(encoded, PIECES)) == got(encoded, "doc_id", "decoded")


def test_pieces_of_odd_texts():
    import sentencepiece

    library, table, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.ChunkTable(PIECES, table_bytes=20_000), random.Random(4)
    parts = ["a", "b", " ", "  ", "   ", "\n", "▁", "é", "ﬁ", "　", "\x00", "the", "\t", "😀", "</s>", "<0x0A>", " ", "会"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 10))) for _ in range(6000)]
    found = [x for k in range(0, len(texts), 100) for x in table.encode(texts[k : k + 100])]
    for text, (ids, decoded) in zip(texts, found, strict=True):
        whole = [*library.encode(text), library.eos_id()]
        assert ids == " ".join(map(str, whole)) and decoded == library.decode(whole), repr(text)


# lines


def test_line_dedup(docs, plain):
    seen, expected = set(), []
    order = lambda r: (r[0] is not None, r[0] or 0)
    ids = Counter(i for i, _ in plain)
    for i, t in sorted(plain, key=order):
        lines = [(k, x.strip(WHITE)) for k, x in enumerate((t or "").split("\n")) if x.strip(WHITE)]
        gone, new = set(), []
        for a in range(len(lines) - 2):
            window = tuple(x for _, x in lines[a : a + 3])
            if window in seen:
                gone |= {k for k, _ in lines[a : a + 3]}
            seen.add(window)
        if ids[i] == 1:
            new = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone) if gone else t
            expected.append((i, new, len(gone)))
    found = [r for r in got(line_dedup.without_repeats(docs, count="gone"), "doc_id", "text", "gone") if ids[r[0]] == 1]
    assert found == sorted(expected, key=str) and any(r[2] for r in found)
    assert line_dedup.without_repeats(docs).columns == docs.columns and line_dedup.without_repeats(docs.limit(0)).count() == 0


def test_line_dedup_of_short_texts(spark):
    import corpus_pipeline

    rows = [(1, "one line"), (2, " one line\n"), (3, "a\n\nb"), (4, "a\nb"), (5, "a b"), (6, "a\nb\nc"), (7, "x\na\nb\nc"), (8, None), (9, ""), (10, "\n"), (11, "a"), (12, "b\na"), (None, "b\na")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars long")
    expected = dict(rows) | {2: "", 4: "", 7: "x", 12: ""}
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, df, "").collect()}
    assert {i: " ".join((t or "").split()) for i, (t, _) in found.items()} == {i: " ".join((t or "").split()) for i, t in expected.items()}
    assert all(n == (None if t is None else len(t)) for t, n in found.values())
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(df).collect()} == dict(rows) | {7: "x"}


# WARC


def test_warc_round_trip(spark):
    html = ["x", None, "", "x", "é" * 100_000, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9000, "é" * 100_000, "last"]
    rows = [(k, "http://a/ b\r\nX: y" if k % 2 else None, h, 1) for k, h in enumerate(html)] + [(None, "u", "x", 1), (None, "u", "alone", 1), (7, "again", "last", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int").repartition(3)
    first, expected = {}, []
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h, _ in rows:
        data, least = (h or "").encode(), first.get(h or "")
        revisit = least is not None and least != i
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", least if revisit else None, True))
    assert got(warc.round_trip(df)) == sorted(expected, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_references_and_members(spark, tmp_path):
    import gzip

    rows = [(k, f"http://h/{k}", "same " * 5 if k % 2 else f"own {k}") for k in range(40)] + [(1, "http://h/1", "same " * 5)] * 3 + [(41, "u", "é" * 200_000), (41, "u", "é" * 200_000)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"), archive_bytes=2000)
    files = [p.read_bytes() for p in (tmp_path / "a").glob("part-*")]
    assert len(files) > 3
    for data in files:
        assert gzip.decompress(data) == b"".join(warc._unpacked(memoryview(data), 64)) == b"".join(warc._unpacked(memoryview(data)))
    read = warc.read(spark, str(tmp_path / "a"), resolve=True).collect()
    payload = {r["record_id"]: bytes(r["payload"]) for r in read if r["record_type"] == "response"}
    revisits = [r for r in read if r["record_type"] == "revisit"]
    assert len(revisits) == 19 and all(r["refers_to"] in payload and bytes(r["payload"]) == payload[r["refers_to"]] == b"same " * 5 for r in revisits)
    assert len(read) == len(rows) and all(r["complete"] for r in read)
    assert Counter(bytes(r["payload"]) for r in read) == Counter(h.encode() for _, _, h in rows)


def test_warc_bad_records(spark, tmp_path):
    good = lambda k: warc._header([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:{k}>"), ("Content-Length", "5")]) + b"WARC/" + warc.END
    short = warc._header([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:short>"), ("Content-Length", "99999")]) + b"abc\r\n\r\n"
    odd = warc._header([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:odd>"), ("WARC-Segment-Number", "x"), ("Content-Length", "1")]) + b"a" + warc.END
    unread = b"WARC/1.1\r\nWARC-Record-ID: <urn:none>\r\nContent-Length: many\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(good(1) + unread + good(2) + b"noise\r\n" + good(3) + odd + short + good(4))
    (tmp_path / "big.warc").write_bytes(b"".join(warc._header([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:big{k}>"), ("Content-Length", str(3 << 20))]) + b"x" * (3 << 20) + warc.END for k in range(12)))
    found = {r["record_id"]: r["complete"] for r in warc.read(spark, str(tmp_path)).collect()}
    assert {k: v for k, v in found.items() if "big" not in k} == {"<urn:1>": True, "<urn:none>": False, "<urn:2>": True, "": False, "<urn:3>": True, "<urn:odd>": False, "<urn:short>": False, "<urn:4>": True}
    assert sum(v for k, v in found.items() if "big" in k) == 12


def test_warc_faults(spark, tmp_path):
    def part(number, block, total=None, name="<urn:a>"):
        fields = [("WARC-Type", "response" if number == 1 else "continuation"), ("WARC-Record-ID", name if number == 1 else f"<urn:{number}>"), ("WARC-Segment-Number", str(number))]
        fields += [("WARC-Segment-Origin-ID", name)] * (number > 1) + [("WARC-Segment-Total-Length", str(total))] * (total is not None)
        return warc._header([*fields, ("Content-Length", str(len(block)))]) + block + warc.END

    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"hello world", 4)
    cut = lambda k: (block[:k], block[k:])
    a, b = cut(30)
    (tmp_path / "1.warc").write_bytes(part(2, b, len(block)) + part(1, a) + part(1, a, name="<urn:gap>") + part(1, a, name="<urn:long>") + part(2, b, 5, name="<urn:long>"))
    (tmp_path / "2.warc").write_bytes(part(2, b, len(block)) + b"garbage")
    found = {r["record_id"]: r for r in warc.read(spark, str(tmp_path)).collect()}
    assert bytes(found["<urn:a>"]["payload"]) == b"hello world" and found["<urn:a>"]["complete"]
    assert not found["<urn:gap>"]["complete"] and not found["<urn:long>"]["complete"] and found["<urn:gap>"]["payload"] is None
    assert warc.dechunked(b"5;x=y\r\nhello\r\n0\r\nTrailer: 1\r\n\r\n") == b"hello" and warc.dechunked(b"5\r\nhel") is None and warc.dechunked(b"zz\r\n") is None


# HTML


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a<p>b <b>c</b>\n d<br>e", "a\n\nb c d\ne"),
        ("<ul><li>one<li>two<ul><li>x</ul><li>three</ul>after", "- one\n- two\n  - x\n- three\n\nafter"),
        ("<ol start=3><li>a</li><li><p>b</p></li></ol>", "3. a\n\n4. b"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>total of all cells</table>done", "Name       Qty\napple pie  3\ntotal of all cells\n\ndone"),
        ("<div hidden>x</div><p style='display: none'>y</p>z<script>a<b</script>&amp;&copy<noscript>n</noscript>", "z&©"),
        ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"),
        ("<table><td>a<table><td>in</table><td>b</table>", "a   b\n\nin"),
        ("<head><title>t</title></head><body>x", "x"),
        ("text < 3 and <3", "text < 3 and <3"),
        ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
        ("<div>a</div><div>b</div><h1>T</h1>x<!-- y", "a\nb\n\nT\n\nx"),
        ("<dl><dt>t<dd>d<dt>u</dl><select><option>o</select><textarea>v &lt;</textarea>", "t\n  d\nu\n\no v <"),
        ("", ""),
        ("<div>" * 3000 + "deep", "deep"),
        ("<table><tr><td rowspan=2>aa<td>b<tr><td>c</table>","aa  b\n    c"),
        ("<table>x<tr><td>y</table>","x\n\ny"),
        ("<table><b>x<tr><td>y</table>z","x\n\ny\n\nz"),
        ("<math><mi>x</mi><mo>+</mo><annotation>no</annotation></math>","x+"),
        ("<svg><title>t</title><text>hi</text><g>no</g><foreignObject><p>yes</p></foreignObject></svg>","hi\n\nyes"),
        ("<object data=x>fall<b>back</b></object>","fallback"),
        ("<details><summary>s</summary>body</details>z","s\nz"),
        ("<details open><summary>s</summary>body</details>z","s\nbody\nz"),
        ("<div style='visibility:hidden'>no<span style='visibility:visible'>yes</span></div>","yes"),
        ("<style>.x{display:none} #y{visibility:hidden} p.z{display:none!important}</style><p class='a x'>1<p id=y>2<p class=z style='display:block'>3<div class=z>4</div>","4"),
        ("<p><b hidden>x<p>y</b>z","z"),
        ("<p><b hidden>x</p><p>y</b>z</p>","z"),
        ("<select><option>a<option selected>b<option>c</select>","b"),
        ("<p>a<table><tr><td>b</table>c</p>d","a\n\nb\n\nc\n\nd"),
        ("<p>1<b>2<i>3</b>4</i>5</p>","12345"),
        ("<table><tr><td>a<td>b</tr>foo<tr><td>c</table>","foo\n\na  b\nc"),
        ("<ul><li>a<div><li>b</div><li>c</ul>","- a\n- b\n- c"),
        ("&#99999999999999;&#0065;&#x41;&#xD800;","�AA�"),
        ("<ol><li value=7>a<li>b</ol>","7. a\n8. b"),
        ("<button>a<button>b","a b"),
        ("<a href=x>1<a>2</a>","12"),
        ("<plaintext>a<b>","a<b>"),
        ("<textarea>\n a</textarea>"," a"),
        ("<svg><![CDATA[x]]></svg><svg><text><![CDATA[<y>]]></text></svg>","<y>"),
        ("<ruby>a<rp>(<rt>b<rp>)</ruby>","ab"),
        ("<a x='1'y=\"2\"z=3/>q</a></>w</p>e<? php>","qw\n\ne"),
        ("<table><caption>cap</caption><col><tr><td>1</table>","cap\n1"),
        ("<table><tr><td>a</td><select><option>o</table>b","o\n\na\n\nb"),
        ("<template>x</template><dialog>y</dialog><dialog open>z</dialog>","z"),
        ("<table><tr><td>a</td></tr></table></div></span></td>b","a\n\nb"),
    ],
)
def test_html(html, text):
    assert html_text.text_of(html) == text


MANY = 10_000
HOSTILE = {
    "open tag": "<a" * 100_000, "long name": "<" + "a" * 200_000, "attributes": "<a " + "x='" * 50_000, "comments": "<!--" * 50_000, "sections": "<svg><![CDATA[" * 20_000, "references": "&#" * 50_000 + "&amp" * 50_000 + "&#" + "9" * 20_000 + ";",
    "nested tables": "<table><tr><td>x" * MANY, "nested cells": "<table><tr><td>x<td>" * MANY, "nested lists": "<ul><li>x" * MANY, "empty items": "<ol><li>" * MANY, "quotes": "<blockquote>x" * MANY, "spans": "<span>" * MANY + "</div>" * MANY,
    "formatting": "".join(f"<i id={k}>" for k in range(MANY)) + "<a></a></b>" * MANY, "misnested": "<b hidden><div>" * MANY + "</b>x" * MANY, "foreign": "<svg>" * MANY + "</x></math>" * MANY, "selects": "<select><option>x" * MANY,
    "row spans": "<table>" + "<tr><td rowspan=65534 colspan=1000>x" * MANY, "wide rows": "<table><tr>" + "<td>x" * MANY + "<tr><td colspan=999>y<td>z" * MANY, "fostered": "<table>" + "x<b>y" * MANY,
    "styles": "<style>" + "".join(f".a{k}{{display:none}}" for k in range(MANY)) + "</style>" + "<p class='a1 a2'>x" * MANY, "braces": "<style>" + "{" * 50_000, "scripts": "<script>" * MANY, "items in blocks": "<ul><li>" + "<div>" * MANY + "<li>" * MANY,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_html_takes_time_in_proportion(name):
    """Some 200 KB of hostile markup each. A slow machine takes about a second; what grows with the square takes minutes."""
    began = time.process_time()
    html_text.text_of(HOSTILE[name])
    assert time.process_time() - began < 8


def independent_words(html):
    """The words that an event parser finds outside of what is not shown."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        unseen, found = 0, []

        def handle_starttag(self, tag, attributes):
            self.unseen += tag in ("script", "style", "title")
            if tag not in ("b", "a", "i", "em", "span"):
                self.found.append(" ")

        def handle_endtag(self, tag):
            self.unseen -= tag in ("script", "style", "title")
            if tag not in ("b", "a", "i", "em", "span"):
                self.found.append(" ")

        def handle_data(self, data):
            if not self.unseen:
                self.found.append(data)

    reader = Reader(convert_charrefs=True)
    reader.found = []
    reader.feed(html)
    reader.close()
    return Counter("".join(reader.found).split())


def test_html_equals_an_independent_parser(spark, sf):
    odd = [(None, None, None), (-1, "", ""), (-2, "u", "<p>a"), (-2, "u", "<p>a")]
    pages = spark.read.parquet(f"{sf}/pages.parquet").unionByName(spark.createDataFrame(odd, "page_id long, url string, html string")).withColumns({"n_chars": F.lit("x"), "text": F.lit("clash"), "n_lines": F.lit(0)})
    found = html_text.extract(pages).collect()
    assert html_text.extract(pages).columns == ["page_id", "n_chars", "n_lines", "text"] and html_text.extract(pages.limit(0)).count() == 0
    text = {r["page_id"]: r["text"] for r in found}
    assert len(found) == pages.count() and text[None] == text[-1] == "" and sum(r["page_id"] == -2 and r["text"] == "a" for r in found) == 2
    assert all(r["n_chars"] == len(r["text"]) and r["n_lines"] == (r["text"].count("\n") + 1 if r["text"] else 0) for r in found)
    for r in pages.where("page_id >= 0").collect():
        expected = independent_words(r["html"])
        del expected["-"]
        assert Counter(w for w in text[r["page_id"]].split() if w != "-") == expected


# intermediate tables


def test_intermediate_tables_need_a_shared_folder(spark):
    from types import SimpleNamespace

    from turnloom.llm import shared

    session = lambda master: SimpleNamespace(sparkContext=SimpleNamespace(master=master, applicationId="a"), conf=SimpleNamespace(get=lambda name, other: other))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(session("spark://host:7077"))
    assert shared.shared_folder(session("local[2]")).startswith("file:///")
    assert shared.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


# registered queries and the pipeline


def test_registered_queries_have_sql_that_agrees(spark, sf):
    for name, sql in queries.ORACLE_SQL.items():
        table = {"op2_chat_formatting": "conversations", "op9_warc": "pages"}.get(name, "documents")
        found, expected = by_sql(spark, queries.QUERIES[name](spark, sf), sql, **{table: spark.read.parquet(f"{sf}/{table}.parquet")})
        assert found == expected, name
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]


@pytest.mark.parametrize("rows", ["all", "none"])
def test_pipeline_of_odd_documents(spark, docs, rows):
    import corpus_pipeline
    from turnloom.llm.shared import stored

    long = " ".join(f"word{k % 977}" for k in range(60_000))
    extra = [(i, t, 0, "x", "y", 3) for i, t in [(900, long), (901, long), (None, long + " end"), (902, long.replace("word3 ", "other "))]]
    table = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    table = table if rows == "all" else table.limit(0)
    assert corpus_pipeline.STAGES[0][1](spark, table, "").columns == docs.columns  # keeps few of these
    kept = table
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stored(stage(spark, kept, ""), name.replace(" ", "-"))
        assert kept.columns == docs.columns
    assert len(kept.collect()) == kept.dropDuplicates(["doc_id", "text"]).count() <= table.count()
    packed = [tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, kept, "").collect()]
    sequences(packed)
    assert {r[0] for r in packed} == {r["doc_id"] for r in kept.collect()} and (rows == "all") == bool(packed)


def test_pipeline(spark, sf):
    import corpus_pipeline
    from turnloom.llm.shared import stored

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], sf), name.replace(" ", "-")))
    _, good, lines, one, packed = kept
    assert good.columns == lines.columns == one.columns == docs.columns
    assert got(lines, "doc_id") == got(good, "doc_id") and lines.where("length(text) <> n_chars").count() == 0
    assert {r[0] for r in got(one, "doc_id")} == jaccard_survivors([(r["doc_id"], r["text"]) for r in lines.select("doc_id", "text").collect()])
    rows = [tuple(r) for r in packed.collect()]
    sequences(rows)
    assert {r[0] for r in rows} == {r[0] for r in got(one, "doc_id")}
