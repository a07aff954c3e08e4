"""Time-to-live per key: the first event fills, later ones hit until `ttl` seconds after it.

The life of an entry runs from the filling event and is not extended by hits, so which events
fill depends on the whole chain before them. Folding a key's events one after another would put
a hot key into one task. Instead time is cut into chunks. How a chunk is left depends on the
past only through the last fill, which must be one of the events in the final `ttl` seconds of
the chunk before. So each (key, chunk) is a small map from the fill it is entered with to the one
it is left with. Maps of consecutive chunks are composed by doubling: in each round a chunk whose
map isn't constant yet takes in the one before it, and with it all that this has taken in, so a
row of n chunks is settled after log2(n) rounds, each of them one join by (key, chunk). In the
end each (key, chunk) knows its entry and marks its fills.

Nothing grows with the number of rows or chunks of a key: a chunk holds at most `chunk` distinct
seconds, its map at most `ttl` + 1 entries.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.operators.lookup import FOUND, lookup_tagged
from roadpulse.operators.skew import null_safe
from roadpulse.schemas import HIT, MISS, NOT_FOUND
from roadpulse.session import materialise

TTL_SECONDS = 300               # fixed value of the lookup service
_NEVER = -(1 << 60)             # "no fill that still matters": far enough back for any time-to-live


class _Chains:
    """The chunks of a batch on one time axis, each with a stretch of its own.

    Every moment points to the first one of its chunk that is at least `ttl` later, if there is one.
    """

    def __init__(self, moments: pd.Series, starts: pd.Series, ttl: int, chunk: int) -> None:
        sizes = moments.map(len).to_numpy()
        self.ttl, self.stretch = ttl, chunk + 2 * ttl
        self.base = starts.to_numpy("int64")
        self.first = np.cumsum(sizes) - sizes
        self.moment = np.concatenate([*moments, np.empty(0, dtype="int64")]).astype("int64")
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.axis = self.on_axis(self.moment, self.row)
        self.next = self.at_least(self.axis + ttl, self.row)

    def on_axis(self, seconds: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return seconds - self.base[rows] + rows * self.stretch

    def at_least(self, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The first moment of the row from the place on; -1 if there is none."""
        at = np.searchsorted(self.axis, places)
        inside = at < len(self.axis)
        inside[inside] = self.row[at[inside]] == rows[inside]
        return np.where(inside, at, -1)

    def entered(self, entries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The first fill of each row after an entry."""
        places = np.where(entries == _NEVER, rows * self.stretch, self.on_axis(entries, rows) + self.ttl)
        return self.at_least(places, rows)

    def ends(self) -> np.ndarray:
        """The last fill of the chain from each moment, by following the pointers in doubling steps."""
        jump = np.where(self.next >= 0, self.next, np.arange(len(self.next)))
        while not np.array_equal(jump, further := jump[jump]):
            jump = further
        return self.moment[jump]

    def chain(self, at: np.ndarray) -> np.ndarray:
        """Marks the moments of the chains from some of them."""
        fills = np.zeros(len(self.moment), dtype=bool)
        at = at[at >= 0]
        while len(at):
            fills[at] = True
            at = self.next[at]
            at = at[at >= 0]
        return fills


def _exits(moments: Column, entries: Column, start: Column, ttl: int, chunk: int) -> Column:
    """For each entry the chunk's last fill, `_NEVER` if it doesn't reach into the next chunk."""
    @F.pandas_udf("array<bigint>")
    def exits(moments: pd.Series, entries: pd.Series, starts: pd.Series) -> pd.Series:
        chains = _Chains(moments, starts, ttl, chunk)
        sizes = entries.map(len).to_numpy()
        rows = np.repeat(np.arange(len(sizes)), sizes)
        first = chains.entered(np.concatenate([*entries, np.empty(0, "int64")]).astype("int64"), rows)
        last = np.where(first >= 0, chains.ends()[first], _NEVER) if len(chains.moment) else first
        last = np.where(last > chains.base[rows] + chunk - ttl, last, _NEVER)
        return pd.Series(np.split(last, np.cumsum(sizes)[:-1])) if len(sizes) else pd.Series([], dtype=object)

    return exits(moments, entries, start)


def _fills(moments: Column, entry: Column, start: Column, ttl: int, chunk: int) -> Column:
    @F.pandas_udf("array<bigint>")
    def fills(moments: pd.Series, entry: pd.Series, starts: pd.Series) -> pd.Series:
        chains = _Chains(moments, starts, ttl, chunk)
        marked = chains.chain(chains.entered(entry.to_numpy("int64"), np.arange(len(entry))))
        return pd.Series([chains.moment[a:b][marked[a:b]] for a, b in zip(
            chains.first, [*chains.first[1:], len(marked)])], dtype=object)

    return fills(moments, entry, start)


def fill_moments(
    events: DataFrame, keys: list[str], second: str, ttl: int = TTL_SECONDS, chunk: int | None = None,
) -> DataFrame:
    """(keys, second) of the events that fill. `second` is a whole number of seconds."""
    chunk = max(chunk or 288 * ttl, ttl)
    here = F.floor(F.col(second) / chunk)
    reaches_next = F.col(second) > (here + 1) * chunk - ttl
    placed = (
        events.filter(F.col(second).isNotNull())
        .select(*keys, F.col(second).cast("long").alias(second)).distinct()
        .select(*keys, second, F.explode(F.when(reaches_next, F.array(here, here + 1))
                                         .otherwise(F.array(here))).alias("__chunk"))
        .withColumn("__own", here == F.col("__chunk"))
    )
    chunks = materialise(
        placed.groupBy(*keys, "__chunk").agg(
            F.sort_array(F.collect_list(F.when(F.col("__own"), F.col(second)))).alias("__moments"),
            F.collect_list(F.when(~F.col("__own"), F.col(second))).alias("__entries"))
        .filter(F.size("__moments") > 0))
    start = F.col("__chunk") * chunk
    # A chunk matters to another one only if it can be entered or its last event reaches on.
    matters = (F.size("__entries") > 0) | (F.element_at("__moments", -1) > start + chunk - ttl)
    entries = F.concat(F.array(F.lit(_NEVER)), F.col("__entries"))
    maps = materialise(chunks.filter(matters).select(
        *keys, "__chunk", entries.alias("__from"), _exits(F.col("__moments"), entries, start, ttl, chunk).alias("__to")))
    entered = _exits_in_rows(maps, keys).filter(F.col("__exit") != _NEVER).select(
        *keys, (F.col("__chunk") + 1).alias("__chunk"), F.col("__exit").alias("__entry"))
    entry = F.coalesce(F.when(F.size(chunks["__entries"]) > 0, entered["__entry"]), F.lit(_NEVER))
    known = chunks.join(entered, null_safe(chunks, entered, [*keys, "__chunk"]), "left").select(
        *[chunks[k] for k in [*keys, "__chunk", "__moments"]], entry.alias("__entry"))
    return known.select(*keys, F.explode(_fills(F.col("__moments"), F.col("__entry"), start, ttl, chunk)).alias(second))


def _exits_in_rows(maps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chunk, exit) of every chunk, from its map (`__from` and `__to` side by side).

    A chunk that nothing reaches into is entered with `_NEVER`, its first entry. An open chunk holds
    the map over all chunks from `__at` + 1 on to itself.
    """
    own = [*keys, "__chunk"]

    def settled(rows: DataFrame, is_first: Column) -> tuple[DataFrame, DataFrame]:
        """Chunks whose exit is known, and the others."""
        constant = is_first | (F.size(F.array_distinct("__to")) == 1)
        return (rows.filter(constant).select(*own, F.element_at("__to", 1).alias("__exit")),
                rows.filter(~constant).select(*own, "__at", "__from", "__to"))

    done, left = settled(maps.withColumn("__at", F.col("__chunk") - 1), F.size("__from") == 1)
    parts = [done]
    while not left.isEmpty():
        here, long = F.lit(None).cast("bigint"), F.lit(None).cast("array<bigint>")
        before = reduce(DataFrame.unionByName, parts).select(
            *own, "__exit", here.alias("__at"), long.alias("__from"), long.alias("__to"),
        ).unionByName(left.withColumn("__exit", F.lit(None).cast("bigint")))
        before = before.select(*keys, F.col("__chunk").alias("__at"), F.col("__exit").alias("__in"),
                               F.col("__at").alias("__b_at"), F.col("__from").alias("__b_from"), F.col("__to").alias("__b_to"))
        through = F.map_from_arrays(left["__from"], left["__to"])
        into = F.when(F.col("__in").isNotNull(), F.array("__in")).otherwise(F.col("__b_to"))
        composed = materialise(
            left.join(before, null_safe(left, before, [*keys, "__at"]))
            .select(*[left[c] for c in own], F.col("__b_at").alias("__at"), F.col("__b_from").alias("__from"),
                    through.alias("__map"), into.alias("__into"))
            .select(*own, "__at", F.coalesce("__from", F.col("__into")).alias("__from"),
                    F.transform("__into", lambda x: F.element_at("__map", x)).alias("__to")))
        done, left = settled(composed, F.col("__at").isNull())
        parts.append(done)
    return reduce(DataFrame.unionByName, parts)


def request_outcomes(
    requests: DataFrame, keys: DataFrame, ttl: int = TTL_SECONDS, chunk: int | None = None,
) -> DataFrame:
    """Label each request (`seq`, `segundo`, `tipo`, `uuid`) hit, miss or not found.

    A request for an unknown key is never stored. Of several requests for a key in the
    second it is filled, the one with the lowest `seq` is the miss. `seq` is unique.
    """
    tag = ["tipo", "uuid"]
    first = requests.groupBy(*tag, "segundo").agg(F.min("seq").alias("seq"))
    fills = fill_moments(requests, tag, "segundo", ttl, chunk)
    misses = first.join(fills, [*tag, "segundo"]).select("seq", F.lit(True).alias("__fill"))
    outcome = (F.when(F.col("estado") != FOUND, NOT_FOUND)
               .when(F.col("__fill").isNotNull(), MISS).otherwise(HIT))
    return (
        lookup_tagged(requests, keys).join(misses, "seq", "left")
        .withColumn("resultado", outcome)
        .select(*requests.columns, "resultado")
    )
