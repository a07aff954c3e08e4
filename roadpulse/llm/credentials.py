"""Secret scan: plain secrets, and weak candidates that are reported only next to their other parts.

Plain kinds (`assign`, `access`, `hex`) are reported wherever their patterns stand. A credential often
has several parts, none of which is proof alone: an identifier, a secret, an endpoint. Weak candidates
of these roles are joined by intervals within one text: two parts are together if at most `REACH` code
points lie between them. A weak identifier is reported with a secret in reach, a weak secret with an
identifier or an endpoint, and an endpoint with both. `access` counts as an identifier, `assign` and
`hex` as secrets. Weak candidates that overlap a plain find are dropped. A mixed value is a weak secret
whatever it is assigned to, unless the name says that it is an identifier or a place.

The interval join is a sweep: the parts of a text are ordered by start, and each part meets the nearest
parts of every role on either side. No pair of parts is ever made. Only texts with a weak candidate and
a second role enter the sweep; they are identified by row number, so that repeated rows and null ids
stay apart. Offsets are code points, ends exclusive. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from roadpulse.session import materialise

REACH = 200
#: Matches of a text whose places are summed together.
BLOCK = 256
#: Kinds in the order in which they are listed where starts are equal; the first three are plain.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ROLES = {"access": "identifier", "assign": "secret", "hex": "secret"}
_SET = r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = r"[A-Za-z0-9+/_.=-]"
ASSIGN = rf"(?i)(?:password|passwd|secret|token|api_?key){_SET}({_VALUE}+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
_NAME = (r"(?<![a-z0-9])(?:access_?key_?id|(?<!secret)(?<!secret_)access_?key|client_?id|key_?id|account|user_?name|user|login)"
         rf"{_SET}")
IDENTIFIER = rf"(?i){_NAME}[a-z0-9@._+-]{{3,}}"
_PLACE = rf"(?<![a-z0-9])(?:host|endpoint|server|bucket|region){_SET}"
_NAMED = (r"(?i:(?<![a-z0-9])(?:secret_?(?:access_?)?key|pwd|pass|passphrase|private_?key|auth|credentials?|signature)"
          rf"{_SET}{_VALUE}{{6,}})")
_RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
_MIXED = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])"
          rf"(?=[a-z0-9+/_-]*[A-Z]){_RUN}")
#: Only matches with a first group count: the values of named identifiers and places are no secrets of their own.
SECRET = f"(?i:{_NAME}(?=[a-z0-9@._+-]{{3}})|{_PLACE}(?=[a-z0-9._:/-]{{3}})){_RUN}|({_NAMED}|{_MIXED})"
ENDPOINT = (r"""(?i)(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*://[^\s"'<>]+"""
            rf"|{_PLACE}[a-z0-9._:/-]{{3,}}")


def spans(text: Column, kind: str, pattern: str, min_value: int = 0) -> Column:
    """Leftmost matches that don't overlap, as an array of (start, order, end).

    What lies between the matches, and their lengths, give the starts: sums that run within blocks of `BLOCK`
    matches and over the blocks, so that no array grows by copies with the number of matches. Texts
    without a match, nearly all of them, take one search. With `min_value` matches with a shorter first
    group are dropped after the search, so that they aren't tried again from a later start.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if min_value else whole
    matches = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    sizes = F.transform(matches, lambda m: F.struct(
        F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("whole"), (F.length(m["value"]) >= min_value).alias("good")))
    none = F.lit([]).cast("array<struct<start:int,kind:int,end:int>>")

    def inside(block: Column, start: Column) -> Column:
        """The good matches of a block that begins at a place."""
        def step(state: Column, m: Column) -> Column:
            here = state["at"] + m["gap"]
            end = here + m["whole"]
            found = F.array(F.struct(here.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(m["good"], F.concat(state["out"], found)).otherwise(state["out"]).alias("out"))

        return F.aggregate(block, F.struct(start.alias("at"), none.alias("out")), step)["out"]

    def onward(state: Column, block: Column) -> Column:
        length = F.aggregate(block, F.lit(0), lambda sum_, m: sum_ + m["gap"] + m["whole"])
        return F.struct((state["at"] + length).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    def in_blocks(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(sizes, i * BLOCK + 1, F.lit(BLOCK)))

    def summed(blocks: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<int>").alias("out"))
        return F.flatten(F.zip_with(blocks, F.aggregate(blocks, zero, onward)["out"], inside))

    return F.when(text.rlike(pattern), once(sizes, lambda s: once(in_blocks(s), summed))).otherwise(none)


def once(value: Column, function: Callable[[Column], Column]) -> Column:
    """`function` of a value that is computed a single time, however often the function uses it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def spelled(parts: Column) -> Column:
    """The parts in order, as kind:start:end joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(parts), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_parts(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns`, the arrays `plain` and `weak` of parts, and a row number that stays."""
    text = F.coalesce("text", F.lit(""))
    plain = [spans(text, "assign", ASSIGN, 6), spans(text, "access", ACCESS), spans(text, "hex", HEX)]
    weak = [spans(text, k, p, n) for k, p, n in (("identifier", IDENTIFIER, 0), ("secret", SECRET, 1), ("endpoint", ENDPOINT, 0))]
    return materialise(docs.select(
        F.struct(*columns).alias("__row"), *(F.size(p).cast("long").alias(f"n_{k}") for k, p in zip(KINDS, plain)),
        F.concat(*plain).alias("__plain"), F.concat(*weak).alias("__weak"),
        F.monotonically_increasing_id().alias("__id")))


def link(parts: DataFrame) -> DataFrame:
    """For each text the weak parts (`__linked`) that have their complement in reach."""
    def is_a(role: str, kind: Column | str = "p.kind") -> Column:
        return (F.col(kind) if isinstance(kind, str) else kind).isin([i for i, k in enumerate(KINDS) if ROLES.get(k, k) == role])

    is_plain = F.col("p.kind") < len(ROLES)
    every = F.concat("__plain", "__weak")
    several = reduce(lambda a, b: a + b, (
        F.exists(every, lambda s: is_a(role, s["kind"])).cast("int") for role in KINDS[3:])) > 1
    rows = parts.filter((F.size("__weak") > 0) & several).select("__id", F.explode(every).alias("p"))
    # What comes after a part is what comes before it in reverse: frames that grow are summed as they go,
    # frames that shrink would be summed anew for each row.
    place = ("p.start", "p.kind", "p.end")
    before, after = (W.partitionBy("__id").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
                     for order in (place, map(F.desc, place)))

    def near(condition: Column, reach: int) -> Column:
        """Whether a part that meets the condition lies at most `reach` away; -1 is for overlaps."""
        left = F.col("p.start") - F.max(F.when(condition, F.col("p.end"))).over(before)
        right = F.min(F.when(condition, F.col("p.start"))).over(after) - F.col("p.end")
        return F.coalesce(left <= reach, F.lit(False)) | F.coalesce(right <= reach, F.lit(False))

    swept = rows.select(
        "__id", "p", near(is_plain, -1).alias("covered"),
        *(near(is_a(r), REACH).alias(r) for r in KINDS[3:]))
    reported = (F.when(is_a("identifier"), F.col("secret"))
                .when(is_a("secret"), F.col("identifier") | F.col("endpoint"))
                .otherwise(F.col("identifier") & F.col("secret")))
    return (swept.filter(~is_plain & ~F.col("covered") & reported)
            .groupBy("__id").agg(F.collect_list("p").alias("__linked")))


def scan(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns`, n_assign, n_access, n_hex, base_sha256, spans, and n_linked, the number of weak parts reported."""
    parts = find_parts(docs, columns)
    linked = F.coalesce("__linked", F.lit([]).cast("array<struct<start:int,kind:int,end:int>>"))
    return parts.join(link(parts), "__id", "left").select(
        "__row.*", "n_assign", "n_access", "n_hex", F.sha2(spelled(F.col("__plain")), 256).alias("base_sha256"),
        spelled(F.concat("__plain", linked)).alias("spans"), F.size(linked).cast("long").alias("n_linked"))
