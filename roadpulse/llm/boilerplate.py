"""Line dedup by distinct-site spread: lines that many sites share are kept in one place only.

For each line (without outer white space) the distinct sites are counted by HyperLogLog sketches, which
merge as aggregates do, so a line that stands in a third of all documents costs one sketch a task. Where
an estimate is too near the threshold to trust, the sites are counted exactly. A line that at least
`SITES` sites have is boilerplate: its first place (smallest doc_id, then smallest text key, then first
line) stays, all others go. Lines of fewer than `MIN_CHARS` code points are left alone: short lines
coincide by chance.

Rows: a null text stays null and has no lines; a null site is a site of its own; null doc_ids come last.
Repeated rows (equal doc_id and text) are treated alike: if the first place is in one, it is in all. A
document that loses all its lines is dropped; one that loses none is returned as it came. An empty table gives
an empty one. A column `n_removed` of the input is replaced by the new one; other columns are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.llm.text import unused
from roadpulse.session import materialise

#: White space around a line: blanks, tabs, carriage returns, vertical tabs and form feeds.
WHITE = " \t\r\v\f"
SITES = 10
MIN_CHARS = 20
#: Sketches have 2^12 registers, so the standard error of an estimate is about 1.6 %. Estimates within
#: eight of these errors of the threshold, and at least one site either way, are counted again.
REGISTERS, ERROR, ERRORS = 12, 0.0163, 8
#: The places of lines that go are broadcast while there are at most so many (about 50 MB); else documents shuffle.
BROADCAST_PLACES = 1_000_000
#: Keys of shared lines are broadcast while there are at most so many (about 50 MB); else lines shuffle by them.
BROADCAST_LINES = 1_000_000
_LINE = ["h1", "h2"]
_DOC = ["__d1", "__d2"]


def key_of(*columns: Column) -> tuple[Column, Column]:
    """128 bits in two longs: cheap to group by, and no two lines of a corpus meet by chance."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def bare(line: Column) -> Column:
    """A line without white space around it: pages with CR LF have the lines of those with LF."""
    return F.btrim(line, F.lit(WHITE))


def with_keys(docs: DataFrame, names: list[str]) -> DataFrame:
    return docs.withColumns(dict(zip(names, key_of(F.col("doc_id"), F.col("text")))))


def lines_of(docs: DataFrame, site: str) -> DataFrame:
    """The lines of all documents that are long enough: document key and id, place, site, line key."""
    trimmed = bare(F.col("line"))
    h1, h2 = key_of(trimmed)
    return (
        with_keys(docs.select("doc_id", "text", F.col(site).alias("site")), _DOC)
        .select(*_DOC, "doc_id", F.coalesce(F.col("site").cast("string"), F.lit("\0")).alias("site"),
                F.posexplode(F.split("text", "\n")).alias("place", "line"))
        .filter(F.length(trimmed) >= MIN_CHARS)
        .select(*_DOC, "doc_id", "site", "place", h1.alias("h1"), h2.alias("h2")))


def few(keys: DataFrame) -> DataFrame:
    """A written table of line keys, to be broadcast if it is small: then no line has all its places in one task."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_LINES else keys


def spread_lines(lines: DataFrame, sites: int) -> DataFrame:
    """Keys of the lines that at least `sites` sites have."""
    margin = max(1.0, sites * ERROR * ERRORS)
    # Most lines stand in one site; least and greatest site tell so without a sketch.
    shared = lines.groupBy(*_LINE).agg(F.min("site").alias("a"), F.max("site").alias("b")).filter("a < b")
    candidates = lines.join(few(materialise(shared.select(*_LINE))), _LINE, "left_semi") if sites > 1 else lines
    sketches = materialise(
        candidates.groupBy(*_LINE).agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
        .select(*_LINE, F.hll_sketch_estimate("sketch").alias("n")))
    sure = sketches.filter(F.col("n") > sites + margin).select(*_LINE)
    near = materialise(sketches.filter(F.col("n").between(sites - margin, sites + margin)).select(*_LINE))
    exact = (lines.join(few(near), _LINE, "left_semi").select(*_LINE, "site").distinct()
             .groupBy(*_LINE).count().filter(F.col("count") >= sites).select(*_LINE))
    return sure.unionByName(exact)


def removals(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """For each document key the places (from 0) of the lines that go."""
    lines = lines_of(docs, site)
    common = materialise(spread_lines(lines, sites))
    places = lines.join(few(common), _LINE, "left_semi")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *_DOC, "place")
    first = materialise(places.groupBy(*_LINE).agg(F.min(place).alias("first")))
    gone = places.join(few(first), _LINE).filter(place != F.col("first"))
    return gone.groupBy(*_DOC).agg(F.array_distinct(F.collect_list("place")).alias("__gone"))


def remove_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """`docs` with cross-site lines left only in their first place, and `n_removed`, the lines cut from each."""
    docs = docs.drop("n_removed")
    *key, place = unused(docs, *_DOC, "__gone")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(place, i))
    cut = F.col(place).isNotNull()
    gone = materialise(removals(docs, site, sites)).toDF(*key, place)
    places = gone.agg(F.sum(F.size(place))).first()[0] or 0
    joined = with_keys(docs, key).join(F.broadcast(gone) if places <= BROADCAST_PLACES else gone, key, "left")
    return (
        joined.withColumn("text", F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("text")))
        .filter(~cut | (F.btrim("text", F.lit(WHITE + "\n")) != ""))
        .select(*docs.columns, F.when(cut, F.size(place)).otherwise(0).cast("long").alias("n_removed")))
