"""Vector codes, exact top-k search and phrase mining: brute force, edges, and the parts they are made of."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import codes, neighbours, phrases

VECTORS = "vec_id long, embedding array<double>, label string, code string, score string, v string, rank int"
EXTRA = ("x", "y", "z", 1)


def floors(rows, scale):
    """(id, integers) of the rows with a whole vector."""
    return [(i, np.floor(scale * np.array(v, dtype=float)).astype(np.int64)) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]


# -- codes --------------------------------------------------------------------------------------

def codes_by_hand(vectors, entries, rounds, parts=4):
    first = [v for _, v in sorted(vectors, key=lambda r: r[0])]
    width = len(first[0]) // parts
    out, error = defaultdict(str), Counter()
    for p in range(parts):
        cut = np.array([v[p * width:(p + 1) * width] for v in first])
        book = cut[:entries].copy()
        for r in range(rounds + 1):
            gaps = ((cut[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
            near = gaps.argmin(axis=1)
            if r < rounds:
                for e in set(near.tolist()):
                    book[e] = cut[near == e].sum(axis=0) // (near == e).sum()
        for (i, _), e, gap in zip(sorted(vectors, key=lambda r: r[0]), near, gaps.min(axis=1)):
            out[i] += f"{e:02x}"
            error[i] += int(gap)
    return {i: (out[i], error[i]) for i in out}


@pytest.mark.parametrize("entries, rounds, spread", [(256, 4, 1.0), (7, 3, 0.01), (70, 2, 30.0)])
def test_codes_against_all_entries(spark, entries, rounds, spread):
    rng = np.random.default_rng(entries)
    rows = [(i, (rng.normal(size=12) * spread).round(3).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(50)]            # copies, so ties among the entries
    df = spark.createDataFrame([(i, v, None) for i, v in rows], "vec_id long, embedding array<double>, label string")
    vectors = codes.prepare(df, ["vec_id"], "embedding")
    books = codes.fit(vectors, "vec_id", entries=entries, rounds=rounds)
    got = {r["vec_id"]: (r["code"], r["error"]) for r in codes.encode(vectors, books).collect()}
    assert got == codes_by_hand(floors(rows, codes.SCALE), entries, rounds)
    for i, v in floors(rows, codes.SCALE)[::40]:
        assert int(((np.array(books.decode(got[i][0])) * codes.SCALE - v) ** 2).sum()) == got[i][1]


def test_masks_leave_just_the_entries_within_the_radius():
    rng = np.random.default_rng(3)
    entries, parts = rng.integers(-50, 50, (130, 5)), rng.integers(-60, 60, (40, 5))
    slices = codes.Slices(entries)
    for radius in (0, 9, 30, 200):
        masks = slices.candidates(parts, np.full(len(parts), radius))
        inside = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")
        assert (inside[:, :130] == (np.abs(parts[:, None] - entries[None]).max(axis=2) <= radius)).all()
        assert not inside[:, 130:].any()
    gaps = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    distance, index = slices.nearest(parts)
    assert (distance == gaps.min(axis=1)).all() and (index == gaps.argmin(axis=1)).all()


def test_code_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0, 3.0, 4.0], "a"), (1, None, "a"), (2, [1.0, None, 0.0, 0.0], "a"), (3, [nan, 0.0, 0.0, 0.0], None),
            (4, [inf, 0.0, 0.0, 0.0], None), (5, [], None), (6, [1.0], None), (7, [1.0], ""), (7, [1.0], ""),
            (8, [1e30, 0.0], "big"), (9, [0.0] * 4, None)]
    out, books = codes.compress(spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS))
    got = sorted((str(r[0]), r[1], r[2], r[3]) for r in out.collect())
    assert out.columns == ["vec_id", "code", "error", "label_error"]
    zero = got[0]
    assert got == [("5", zero[1], 0, 0), ("6", "01" + zero[1][2:], 0, 0), ("7", "01" + zero[1][2:], 0, 0),
                   ("7", "01" + zero[1][2:], 0, 0), ("8", None, None, None), ("9", zero[1], 0, 0),
                   ("None", got[-1][1], 0, 0)]
    assert books.decode(got[-1][1]) == [1.0, 2.0, 3.0, 4.0]
    for none in ([], [(1, None, None, *EXTRA)], [(1, [1e30], "a", *EXTRA)]):
        out, books = codes.compress(spark.createDataFrame(none, VECTORS))
        assert [tuple(r) for r in out.collect()] == ([(1, None, None, None)] if none and none[0][1] else [])
        assert books.digest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


# -- top-k --------------------------------------------------------------------------------------

def best_by_hand(rows, asks, k):
    out = []
    for q, x in rows:
        if q is not None and asks(q):
            found = sorted((-int(x @ y), i is None, i or 0) for i, y in rows if i != q)
            out += [(q, n, None if none else i, -s) for n, (s, none, i) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def clustered(count, seed, clusters=6, width=8, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width)) * rng.uniform(0.2, 3, size=(clusters, 1))
    return [(i, (centres[i % clusters] + rng.normal(size=width) * spread).tolist()) for i in range(count)]


@pytest.mark.parametrize("block, count, spread", [(1 << 17, 600, 0.02), (5, 600, 0.02), (3, 300, 1.0)])
def test_top_k_against_all_pairs(spark, monkeypatch, block, count, spread):
    monkeypatch.setattr(neighbours, "TILE", 64)
    rows = clustered(count, block, spread=spread)
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(5, rows[5][1]), (None, rows[1][1])]  # ties, repeated rows, no id
    data = spark.createDataFrame([(neighbours.NO_ID if i is None else i, v.tolist()) for i, v in floors(rows, 256)],
                                 "vec_id long, v array<int>")
    asked = data.filter((F.col("vec_id") % 10 == 0) & (F.col("vec_id") != neighbours.NO_ID))
    got = sorted((tuple(r) for r in neighbours.join(asked, data, 4, pivots=6, block=block).collect()), key=str)
    assert got == best_by_hand(floors(rows, 256), lambda i: i % 10 == 0, 4)


def test_top_k_replicates_only_what_a_group_needs(spark):
    """Of well separated clusters a cell needs its own and few others, and the bound is never too tight."""
    rows = floors(clustered(900, 1, clusters=9, spread=0.001), 256)
    data = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, v array<int>")
    asked = data.filter("vec_id % 10 = 0")
    space, width, _, _ = neighbours.space_of(data, asked, 9)
    plan = neighbours.plan_of(data, asked, space, width, 3, 50)
    needs = plan.needs(space.of_data(np.array([v for _, v in rows], dtype=float)))
    assert plan.groups > 1 and needs.mean() < 0.5
    cells = space.of_queries(np.array([v for _, v in rows], dtype=float)).argmin(axis=1)
    for q, _, i, _ in best_by_hand(rows, lambda i: i % 10 == 0, 3):
        assert needs[i, list(plan.used).index(cells[q])]


def test_top_k_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [1.0]), (1, [1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
            (5, []), (None, [3.0, 0.0]), (100, [1e30]), (150, [0.0, -1.0])]
    df = spark.createDataFrame([(i, v, None, *EXTRA) for i, v in rows], VECTORS)
    got = sorted((tuple(r) for r in neighbours.top_k(df, F.col("vec_id") % 50 == 0, 3).collect()), key=str)
    one = 256 * 256
    assert got == [(0, 1, None, 3 * one), (0, 2, 1, one), (0, 3, 1, one), (150, 1, 0, 0), (150, 2, 0, 0), (150, 3, 1, 0)]
    assert neighbours.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 3).collect() == []
    assert neighbours.top_k(df, F.lit(False), 3).collect() == []
    empty = spark.createDataFrame([(0, []), (50, []), (7, [])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in neighbours.top_k(empty, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == [(0, 1, 7, 0), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 7, 0)]


def test_top_k_of_large_components(spark):
    """Products beyond 2^53 are exact."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-(1 << 17), 1 << 17, 6) + 0.0).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in neighbours.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()), key=str)
    assert got == best_by_hand(floors(rows, 256), lambda i: i % 50 == 0, 5)


# -- phrases ------------------------------------------------------------------------------------

def phrases_by_hand(rows, at_least, most_words):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most_words + 1):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    often = {p: a for p, a in f.items() if a >= at_least}
    inside = Counter()
    for (lang, *words), a in often.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = (lang, *words[i:i + size])
                inside[key] = max(inside[key], a)
    out = defaultdict(list)
    for (lang, *words), a in often.items():
        if len(words) > 1 and inside[(lang, *words)] < a:
            cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found), 1))


@pytest.mark.parametrize("bits, at_least, most_words", [(1 << 28, 3, 5), (1 << 10, 2, 4), (1 << 10, 5, 2), (1 << 28, 400, 5)])
def test_phrases_by_brute_force(spark, monkeypatch, bits, at_least, most_words):
    """Also with a bitmap so small that it lets most pairs through."""
    whole = phrases.bitmap
    monkeypatch.setattr(phrases, "bitmap", lambda rows: whole(rows, bits))
    rng = np.random.default_rng(at_least)
    vocabulary = [*"abcdefgh", "Zu", "zu", "été", "ÉTÉ", "x" * 700, "x" * 699 + "y", "中文", " "]
    rows = [(None, "en"), ("", "en"), (" \t\n", None), ("a b c. a b c, a b c", None), ("a b c", "und"), ("one", "xx")]
    for i in range(80):
        words = rng.choice(vocabulary, size=int(rng.integers(0, 60)), p=np.r_[0.4, np.full(15, 0.04)])
        rows.append(("".join(w + str(rng.choice([" ", " ", " ", "\t ", ", ", "\n", "?!"])) for w in words), ["en", "de", None][i % 3]))
    rows += rows[-2:] + [("q r s t u v " * 4000, "long")]
    df = spark.createDataFrame([(*r, *"abcd") for r in rows], "text string, lang string, phrase string, a string, n string, l string")
    got = sorted(tuple(r) for r in phrases.collocations(df, at_least, most_words, most=None).collect())
    assert got == phrases_by_hand(rows, at_least, most_words)


def test_phrase_edges(spark):
    df = spark.createDataFrame([("a b", "en")], "text string, lang string")
    for rows in (df.limit(0), df, df.withColumn("text", F.lit(None).cast("string"))):
        out = phrases.collocations(rows)
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.collect() == []
    many = spark.createDataFrame([("a b, c d, e f", "en")] * 3, "text string, lang string")
    assert [r["phrase"] for r in phrases.collocations(many, 3, 5, most=2).orderBy("rank").collect()] == ["a b", "c d"]


def test_scores_pass_64_bits(spark):
    """1000 * a * n and l * r are decimals, so large counts don't wrap."""
    text = " ".join(["w v"] * 50_000)
    df = spark.createDataFrame([(text, "en")] * 4, "text string, lang string")
    a, n = 200_000, 400_000
    row = phrases.collocations(df, 100, 2, most=None).orderBy("rank").first()
    assert (row["phrase"], row["score"]) == ("w v", 1000 * a * n // (a * a))
