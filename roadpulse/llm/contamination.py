"""Benchmark decontamination by spaced seeds.

Words are lower-cased and stripped of marks at their ends. A seed is a window of `SPAN` words of which a
mask selects some; the selected words are hashed. Documents and benchmark items that have an equal
seed under the same mask are laid over each other at that place, and the item's words are compared one
by one with the document's words there. A document is contaminated if in some stretch of `STRETCH` of the item's
words that has the seed in it (or in the whole item, if it is shorter) at least `OVERLAP` of the words are equal:
up to a fifth may be replaced, wherever they are. Items of fewer than `SPAN` words have no seeds; a document is
contaminated by them if all their words stand there one after another.

Rows: null texts have no words; repeated documents are judged alike; an empty table of either kind gives no
rows. Documents are identified by a key of doc_id and text, items by their words: items with equal words count
as one, with the least id; an id may be null, and texts that share one are items of their own, with a row each.
Columns of the input are left as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.llm.boilerplate import key_of
from roadpulse.llm.text import unused
from roadpulse.session import materialise

#: Three masks over ten words, six selected: what one replaced word spoils for a mask another may ignore.
MASKS = ("1101001011", "1011010011", "1100111001")
SPAN = len(MASKS[0])
#: A stretch of an item is so many words around the seed, or the whole item if that is shorter.
STRETCH = 20
OVERLAP = 0.8
#: Benchmark seeds are broadcast while there are at most so many (about 100 MB); else both sides shuffle.
BROADCAST_SEEDS = 2_000_000
# Marks at the ends of words, as a class of characters.
_EDGE = r"""[\s.,;:!?'"()\[\]{}<>|*#$%&/\\_+=~`^-]+"""


def words_of(text: Column) -> Column:
    """The words of a text; marks between words and at their ends go with the white space."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _EDGE), "")


def hashes_of(text: Column) -> Column:
    """A 64-bit hash for each word; words are compared by these."""
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def seeds_of(rows: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, the place and the hash of every seed; `rows` has the array `hashes` of its words.

    Shifted copies of the array, zipped, put the words of a window side by side, so that hashing them
    is plain column work on exploded rows. The mask's number is part of the hash.
    """
    windows = F.size("hashes") - SPAN + 1
    used = [i for i in range(SPAN) if any(m[i] == "1" for m in MASKS)]
    shifted = F.arrays_zip(*(F.slice("hashes", i + 1, windows).alias(f"w{i}") for i in used))
    return (
        rows.filter(windows > 0)
        .select(*keep, F.posexplode(shifted).alias("place", "w"))
        .select(*keep, "place", F.explode(F.array(*(
            F.xxhash64(F.lit(n), *(F.col(f"w.w{i}") for i in range(SPAN) if mask[i] == "1"))
            for n, mask in enumerate(MASKS)))).alias("seed")))


def copies(ours: DataFrame, items: DataFrame, key: list[str]) -> DataFrame | None:
    """As `overlaps`, for items of fewer than `SPAN` words, which must be copied whole; None if there are none.

    A document's windows of the items' lengths are joined with the items by all their word hashes.
    """
    counts = items.groupBy(F.size("hashes").alias("n")).count().collect()     # at most SPAN - 1 rows
    if not counts:
        return None

    def windows_of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.size("hashes") - n + 1)
        return F.when(F.size("hashes") >= n, F.transform(places, lambda i: F.slice("hashes", i, F.lit(n)))).otherwise(
            F.lit([]).cast("array<array<bigint>>"))

    windows = F.flatten(F.array(*(windows_of(r["n"]) for r in sorted(counts))))
    theirs = items.select(F.col("hashes").alias("window"), "item_id")
    small = sum(r["count"] for r in counts) <= BROADCAST_SEEDS
    return (
        ours.select(*key, F.explode(F.array_distinct(windows)).alias("window"))
        .join(F.broadcast(theirs) if small else theirs, "window")
        .select(*key, "item_id", F.size("window").cast("long").alias("n_equal"), F.size("window").cast("long").alias("of"))
        .distinct())


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each contaminated document and item: document key, doc_id, item_id, `n_equal` and `of`.

    These are the equal words of the best stretch, and its length.
    """
    i1, i2 = key_of(F.col("hashes"))
    own = ["__i1", "__i2"]
    every = materialise(
        benchmark.select("item_id", hashes_of(F.col("text")).alias("hashes")).filter(F.size("hashes") > 0)
        .groupBy("hashes").agg(F.min("item_id").alias("item_id")).withColumns({"__i1": i1, "__i2": i2}))
    items = every.filter(F.size("hashes") >= SPAN)
    theirs = materialise(seeds_of(items, own).select("seed", *own, F.col("place").alias("item_place")))
    small = theirs.count() <= BROADCAST_SEEDS
    d1, d2 = key_of(F.col("doc_id"), F.col("text"))
    ours = docs.select(d1.alias("__d1"), d2.alias("__d2"), "doc_id", hashes_of(F.col("text")).alias("hashes"))
    key = ["__d1", "__d2", "doc_id"]
    short = copies(ours, every.filter(F.size("hashes") < SPAN), key)
    if small:  # a document's hashes come along by reference, and only the stretch around a hit is written out
        hits = seeds_of(ours, [*key, "hashes"]).join(F.broadcast(theirs), "seed")
    else:
        hits = (seeds_of(ours, key).join(theirs, "seed").drop("seed", "doc_id").distinct()
                .join(ours, ["__d1", "__d2"]))
    left = F.greatest(F.lit(0), F.col("place") - STRETCH)
    hits = hits.select(*key, *own, "item_place", "place", F.slice("hashes", left + 1, 2 * STRETCH).alias("around"))
    items = items.select(*own, "item_id", F.col("hashes").alias("__item"))
    stretch = F.least(F.size("__item"), F.lit(STRETCH))
    # The words of all stretches that have the seed in them, and what lies opposite in the document.
    begin = F.greatest(F.lit(0), F.col("item_place") + SPAN - stretch)
    end = F.least(F.size("__item"), F.col("item_place") + stretch)
    opposite = F.col("place") - F.col("item_place") + begin
    lost = F.greatest(F.lit(0), -opposite)     # words that lie before the document
    here = F.slice("around", opposite + lost - left + 1, end - begin - lost)
    there = F.slice("__item", begin + lost + 1, end - begin - lost)
    same = F.concat(F.array_repeat(F.lit(False), lost), F.zip_with(here, there, lambda a, b: a.eqNullSafe(b)))
    enough = F.ceil(F.lit(OVERLAP) * F.col("of"))

    def equal(words: Column) -> Column:
        return F.size(F.filter(words, lambda x: x))

    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - F.col("of") + 1),
                                   lambda i: equal(F.slice("same", i, F.col("of")))))
    found = (
        hits.join(F.broadcast(items) if small else items, own)
        .select(*key, *own, "item_id", same.alias("same"), stretch.alias("of"))
        .filter(equal(F.col("same")) >= enough)
        .select(*key, *own, "item_id", best.alias("n_equal"), "of").filter(F.col("n_equal") >= enough)
        .groupBy(*key, *own).agg(F.min("item_id").alias("item_id"), F.max("n_equal").cast("long").alias("n_equal"),
                                 F.max("of").cast("long").alias("of")).drop(*own))
    return found if short is None else found.unionByName(short)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without an overlap, as they came."""
    key = unused(docs, "__d1", "__d2")
    found = materialise(overlaps(docs, benchmark).select("__d1", "__d2").distinct()).toDF(*key)
    d1, d2 = key_of(F.col("doc_id"), F.col("text"))
    return docs.withColumns(dict(zip(key, (d1, d2)))).join(found, key, "left_anti").select(*docs.columns)
