"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import pandas as pd
import pytest

import corpus_pipeline
from roadpulse.llm import (
    boilerplate, contamination, credentials, divergence, jaccard, licence, pieces, pii, text, url_filter, warc,
)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words string, spans string, component string, place string, seed string, site string, n_removed string")
LONG = "lorem ipsum " * 20_000 + "a" * 50_000 + " " * 1000 + "1" * 20_000 + "." * 1000
ROWS = [(None, "some words that stand here in a row", None, None, None), (1, None, "en", "s1", None),
        (2, "", "xx", "s2", 0), (3, " \n\t ", "en", None, 4), (4, LONG, "en", "s1", len(LONG)),
        (5, "same text again", "en", "s1", 15), (5, "same text again", "en", "s1", 15), (6, "same text again", "de", "s2", 15),
        (None, None, None, None, None)]
SCANS = [credentials.scan, divergence.judge, licence.scan, pieces.segment, pieces.encode, pii.scan]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("scan", SCANS, ids=lambda f: f"{f.__module__.rsplit('.', 1)[1]}.{f.__name__}")
def test_scans(docs, none, scan):
    rows = scan(docs, ["doc_id"]).collect()
    assert len(rows) == len(ROWS)
    same = [tuple(r)[1:] for r in rows if r["doc_id"] == 5]
    assert same[0] == same[1]
    empty = [tuple(r)[1:] for r in rows if r["doc_id"] in (1, 2)]
    assert empty[0] == empty[1]
    assert scan(none, ["doc_id"]).collect() == []


def test_batches_are_handed_on_in_slices(monkeypatch):
    batch = pd.DataFrame({"text": ["abc", None, "", "x" * 25, "de", "f"], "lang": [None] * 6}, index=[3, 1, 4, 1, 5, 9])
    monkeypatch.setattr(text, "SLICE_CHARS", 10)
    parts = [list(p["text"]) for p in text.slices_of(batch, ["text", "lang"])]
    assert parts == [["abc", None, ""], ["x" * 25], ["de", "f"]]
    assert list(text.slices_of(batch[:0], ["text", "lang"])) == []


def test_lines(spark, docs, none):
    out = boilerplate.remove_boilerplate(docs, sites=2)
    assert out.columns == [c for c in docs.columns if c != "n_removed"] + ["n_removed"] and out.count() == len(ROWS)
    assert boilerplate.remove_boilerplate(none).count() == 0
    line = "a line that two of the sites have in common"
    rows = [(1, f"{line}\nown", "a"), (2, f"{line} \nother\n{line}", "b"), (3, line, "c"), (3, line, "c"), (4, "own", None),
            (None, f"x\n{line}", "a")]
    got = sorted((str(r[0]), r[1], r[3]) for r in boilerplate.remove_boilerplate(
        spark.createDataFrame(rows, "doc_id long, text string, source string"), sites=3).collect())
    assert got == [("1", f"{line}\nown", 0), ("2", "other", 2), ("4", "own", 0), ("None", "x", 1)]


def test_lines_with_other_white_space_around_them_are_the_same(spark):
    line = "a line that three of the sites have in common"
    rows = [(n, f"{line}{end}\nown {n}", f"s{n}") for n, end in enumerate(["\r", "", " \t", "\v\f"])]
    rows.append((9, f"\t{line}\r\n \f\r\n", "s9"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in boilerplate.remove_boilerplate(docs, sites=3).collect()}
    assert got == {0: (rows[0][1], 0), **{n: (f"own {n}", 1) for n in (1, 2, 3)}}


def test_columns_that_clash_with_inner_ones_stay(spark):
    names = ["__gone", "__d1", "__D2", "___gone"]
    text = "words " * 30
    rows = [(n, text if n < 2 else f"{text}\n{'a line that all of the sites have'}", f"s{n}", *"abcd") for n in range(12)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long, text string, source string", *(f"{c} string" for c in names)]))
    bench = spark.createDataFrame([(1, "not one of them " * 5)], "item_id long, text string")
    for out in (boilerplate.remove_boilerplate(docs), contamination.remove_contaminated(docs, bench), jaccard.drop_near_duplicates(docs)):
        assert out.columns[:7] == docs.columns
        assert {tuple(r)[3:7] for r in out.collect()} == {tuple("abcd")}


def test_lines_near_and_above_the_threshold(spark, monkeypatch):
    """Estimates far above the threshold aren't counted again; those near it are, and decide."""
    rows = [(i, f"{'a line of thirty sites or so'}\n{'a line of exactly nine sites' if i < 9 else 'another line of ten or more'}", f"s{i}")
            for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit in (boilerplate.BROADCAST_PLACES, -1):
        monkeypatch.setattr(boilerplate, "BROADCAST_PLACES", limit)
        monkeypatch.setattr(boilerplate, "BROADCAST_LINES", limit)
        got = {r["doc_id"]: r["text"] for r in boilerplate.remove_boilerplate(docs).collect()}
        assert got.keys() == set(range(10)) and got[0] == rows[0][1] and got[5] == "a line of exactly nine sites"


def test_near_duplicates(docs, none):
    found = jaccard.near_duplicates(docs, 3, 90).collect()
    assert len(found) == len(ROWS)
    of = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None}
    assert of[1] == (0, 1) and of[2] == (0, 2) and of[3] == (0, 3) and of[5] == (1, 5) and of[6] == (1, 5)
    assert sorted(r["n_shingles"] for r in found if r["doc_id"] is None) == [0, 6]
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None", "None"]
    assert jaccard.near_duplicates(none).count() == 0 and jaccard.drop_near_duplicates(none).count() == 0


def test_near_duplicates_chain(spark):
    """Links of neighbours only make one component."""
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(100 - i, " ".join(words[3 * i:3 * i + 150])) for i in range(50)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.near_duplicates(docs, 3, 90).collect()} == {51}


def test_contamination(spark, docs, none):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "lorem ipsum " * 8)], "item_id long, text string")
    assert {r["doc_id"] for r in contamination.overlaps(docs, bench).collect()} == {4}
    assert contamination.remove_contaminated(docs, bench).count() == len(ROWS) - 1
    assert contamination.remove_contaminated(docs, bench.limit(0)).count() == len(ROWS)
    assert contamination.overlaps(none, bench).count() == 0


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x", "http://example.org", "https://a.example.org/en/12?q",
        "x://de.com/de/#", "http://com/fr/", "http://b.com/fr", "http://example.org/es?x=/y", "a://b.org://c", "http://exämple.org/?a"]
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_urls_by_trie_and_by_join(spark, monkeypatch):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, rule string")
    by_trie = sorted(map(tuple, url_filter.judge_urls(pages, RULES).collect()))
    monkeypatch.setattr(url_filter, "TRIE_BYTES", 0)
    assert sorted(map(tuple, url_filter.judge_urls(pages, RULES).collect())) == by_trie
    found = {r[0]: r[2:] for r in by_trie}
    assert found[0] == found[1] == found[2] == ("", "", None, "allow")
    assert found[4] == ("www.example.org", "/es/x", "example.org/es/", "block") and found[5] == ("example.org", "", None, "allow")
    assert found[6][2:] == ("example.org/en/1", "block") and found[7][2:] == ("com/de/", "block") and found[8][2] == "com/fr/"
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_archives(spark):
    big = "é" * 600
    rows = [(1, "u\r\nv", big), (7, "u", big), (3, None, big), (None, "u", big), (4, "u", None), (5, "u", "short"), (6, "u", "short"),
            (7, "u", big), (8, "u", "WARC/1.1\r\n\r\n" * 200_000)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload long")
    found = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(pages).collect()))
    assert found == sorted([(1, 1200, "revisit", 7), (7, 1200, "response", None), (3, 1200, "revisit", 7), (0, 1200, "revisit", 7),
                            (4, 0, "response", None), (5, 5, "response", None), (6, 5, "response", None), (7, 1200, "response", None),
                            (8, 2_400_000, "response", None)])
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_every_stage_on_edges(spark, docs, none):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (plain, none.select(*plain.columns)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, "/root/testdata/sf0.001")
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == plain.columns
