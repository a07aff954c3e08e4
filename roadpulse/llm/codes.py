"""Vector compression: each part of a vector becomes the index of its nearest codebook entry.

Components become integers floor(1024 * x) and vectors are cut into equal consecutive parts, each with a
codebook of 256 entries. The codebooks start as the parts of the first vectors and follow the means of the
parts assigned to them for a number of rounds. All arithmetic is in integers and so exact.

The nearest entry is found by slicing and intersecting bitmasks. For each coordinate the entries are sorted,
and every prefix of that order has a mask, uint64 words with a bit for each entry. A radius around a part
selects a range in each order by two binary searches; the masks of the range's two ends give the entries
inside it, and ANDing over all coordinates leaves the entries within the radius in every coordinate, the
candidates. Distances are taken to the candidates of some hundred parts together, by a matrix product, and each
part looks at its own. All entries within the radius by Euclidean distance are among them, so a nearest candidate
that isn't further away than the radius is the nearest entry. The initial radius is the codebook's own median
distance between neighbours; parts that it doesn't settle are sliced again with the distance to the best
candidate (without one, to the entry next in the first coordinate), which settles them all.

The vectors stay where they are: each round a task sends sums and counts of its entries, combined before the
shuffle, and the driver gets the codebooks only (their size is a parameter).

Rows: a null vector, or one with a null or non-finite component, goes. Vectors shorter than the longest (filled
up to a multiple of the number of parts) count as filled up with zeros, an empty one is all zeros. A component
of 2^16 or more leaves a vector with a null code and error, outside the fitting. Rows with equal ids, null ids
(which come last) and repeated rows are rows like others; the first vectors are ordered by id, then vector.
An empty table has codebooks without entries and gives no rows. Of the input only the columns asked for are
read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from roadpulse.llm.vectors import integers, matrix, whole
from roadpulse.operators.skew import join_unique
from roadpulse.session import materialise

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Parts that are sliced at a time.
CHUNK = 512


class Slices:
    """A codebook with the sorted values of each coordinate and the masks of all prefixes of their order."""

    def __init__(self, entries: np.ndarray) -> None:
        count, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T
        self.entries = entries
        self.values = np.take_along_axis(entries.T, order, axis=1)
        self.prefixes = np.zeros((width, count + 1, -(-count // 64)), dtype=np.uint64)
        for masks, places in zip(self.prefixes, order):
            masks[np.arange(1, count + 1), places >> 6] = np.uint64(1) << (places & 63).astype(np.uint64)
        np.bitwise_or.accumulate(self.prefixes, axis=1, out=self.prefixes)
        self.all = np.zeros(-(-count // 64) * 64, dtype=np.uint8)
        self.all[:count] = 1
        self.all = np.packbits(self.all, bitorder="little").view(np.uint64)
        self.radius = self._median_gap()

    def _median_gap(self) -> int:
        nearest = []
        for i, entry in enumerate(self.entries):
            gaps = ((self.entries - entry) ** 2).sum(axis=1)
            nearest.append(int(np.delete(gaps, i).min(initial=np.iinfo(np.int64).max)))
        return int(np.sqrt(np.median(nearest))) + 1 if len(nearest) > 1 else 1

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within each part's radius in every coordinate."""
        masks = np.repeat(self.all[None, :], len(parts), axis=0)
        for x, values, prefixes in zip(parts.T, self.values, self.prefixes):
            low = np.searchsorted(values, x - radius, "left")
            high = np.searchsorted(values, x + radius, "right")
            masks &= prefixes[high] & ~prefixes[low]
        return masks

    def best(self, parts: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest candidate of each part and its squared distance; -1 for both where there is none."""
        masks = self.candidates(parts, radius)
        inside = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")
        # The entries that are a candidate of any of these parts are multiplied with all of them at once.
        some = np.flatnonzero(inside.any(axis=0))
        if not len(some):
            return np.full(len(parts), -1), np.full(len(parts), -1)
        inside, entries = inside[:, some].astype(bool), self.entries[some]
        largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
        exact = np.float64 if 4 * largest ** 2 * max(1, parts.shape[1]) < 1 << 53 else np.int64
        p, e = parts.astype(exact), entries.astype(exact)
        squared = ((p * p).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * (p @ e.T)).astype(np.int64)
        squared[~inside] = np.iinfo(np.int64).max
        first = squared.argmin(axis=1)      # the lowest index of several nearest
        found = inside.any(axis=1)
        return (np.where(found, squared[np.arange(len(parts)), first], -1), np.where(found, some[first], -1))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance and index of the nearest entry of each part, the lowest index of several."""
        done = [self._nearest(parts[at:at + CHUNK]) for at in range(0, len(parts), CHUNK)]
        if not done:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([d for d, _ in done]), np.concatenate([i for _, i in done])

    def _nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distance, index = self.best(parts, np.full(len(parts), self.radius))
        open_ = np.flatnonzero((index < 0) | (distance > self.radius ** 2))
        if len(open_):
            bound = distance[open_]
            lost = np.flatnonzero(index[open_] < 0)
            bound[lost] = self._some_distance(parts[open_[lost]])
            wide = np.ceil(np.sqrt(bound.astype(np.float64))).astype(np.int64) + 1
            distance[open_], index[open_] = self.best(parts[open_], wide)
        return distance, index

    def _some_distance(self, parts: np.ndarray) -> np.ndarray:
        """The squared distance to the entry that is next in the first coordinate."""
        if not parts.shape[1]:
            return np.zeros(len(parts), dtype=np.int64)
        order = np.argsort(self.entries[:, 0], kind="stable")
        at = np.minimum(np.searchsorted(self.values[0], parts[:, 0]), len(order) - 1)
        return ((parts - self.entries[order[at]]) ** 2).sum(axis=1)


class Codebooks:
    """The entries of each part position, integers of `SCALE` a unit."""

    def __init__(self, entries: list[np.ndarray]) -> None:
        self.entries = entries
        self.width = sum(e.shape[1] for e in entries)

    def digest(self) -> str:
        numbers = (str(x) for entries in self.entries for x in entries.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for."""
        return [x / SCALE for entries, at in zip(self.entries, bytes.fromhex(code)) for x in entries[at].tolist()]


def prepare(rows: DataFrame, columns: list[str], vector: str) -> DataFrame:
    """`columns` and `__v`, the integers, of the rows that have a vector; written once for all rounds."""
    return materialise(rows.filter(whole(vector)).select(*columns, integers(vector, SCALE).alias("__v")))


def fit(
    vectors: DataFrame, id_column: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks of at most `entries` (up to 256) entries from the rows of `prepare`."""
    vectors = vectors.filter(F.col("__v").isNotNull())
    longest = vectors.agg(F.max(F.size("__v"))).first()[0] or 0
    part = -(-longest // parts)
    order = [F.col(id_column).asc_nulls_last(), "__v"]
    first = matrix((np.asarray(r["__v"]) for r in vectors.orderBy(*order).limit(entries).select("__v").collect()),
                   parts * part)
    books = [first[:, i * part:(i + 1) * part] for i in range(parts)]
    for _ in range(rounds if len(first) else 0):
        books = _means(vectors, books)
    return Codebooks(books)


def _means(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every entry becomes the floor of the mean of the parts nearest to it."""
    (count, part), parts = books[0].shape, len(books)
    slices = vectors.sparkSession.sparkContext.broadcast([Slices(b) for b in books])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((parts * count, part + 1), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch["__v"], parts * part)
            for i, book in enumerate(slices.value):
                own = rows[:, i * part:(i + 1) * part]
                _, index = book.nearest(own)
                into = sums[i * count:(i + 1) * count]
                into[:, part] += np.bincount(index, minlength=count)
                for place in range(part):  # float64 holds the sums of a batch exactly
                    into[:, place] += np.bincount(index, own[:, place], count).astype(np.int64)
        slot, place = np.nonzero(np.repeat(sums[:, part:] > 0, part + 1, axis=1))
        yield pd.DataFrame({"slot": slot, "place": place, "n": sums[slot, place]})

    rows = (vectors.select("__v").mapInPandas(run, "slot int, place int, n long")
            .groupBy("slot", "place").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect())
    slices.unpersist()
    n = {(r["slot"], r["place"]): int(r["n"]) for r in rows}
    out = [b.copy() for b in books]
    for slot, place in n:
        if place < part:
            out[slot // count][slot % count, place] = n[slot, place] // n[slot, part]
    return out


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The rows of `prepare` with `code` and `error` in place of the integers."""
    kept = [c for c in vectors.columns if c != "__v"]
    slices = vectors.sparkSession.sparkContext.broadcast([Slices(b) for b in books.entries])
    part = books.width // max(1, len(books.entries))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch["__v"].notna().to_numpy()
            rows = matrix(batch["__v"][known], books.width)
            found = [book.nearest(rows[:, i * part:(i + 1) * part]) for i, book in enumerate(slices.value)]
            codes = np.stack([index for _, index in found], axis=1).astype(np.uint8)
            out = batch[kept].copy()
            out["code"], out["error"] = None, None
            out.loc[known, "code"] = [row.tobytes().hex() for row in codes]
            out.loc[known, "error"] = sum(distance for distance, _ in found)
            yield out

    schema = T.StructType([vectors.schema[c] for c in kept]).add("code", "string").add("error", "long")
    return vectors.mapInPandas(run, schema)


def compress(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[
        DataFrame, Codebooks]:
    """(`id_column`, code, error, label_error) of every row that has a vector, and the codebooks.

    `label_error` is the error summed over all rows of the row's label, those without one together.
    """
    names = {id_column: "__id", label: "__label"}
    vectors = prepare(rows.select(*(F.col(c).alias(to) for c, to in names.items()), F.col(vector).alias("__x")),
                      list(names.values()), "__x")
    books = fit(vectors, "__id")
    coded = encode(vectors, books)
    key = F.when(F.col("__label").isNull(), F.lit("none")).otherwise(F.concat(F.lit("="), F.col("__label").cast("string")))
    coded = materialise(coded.withColumn("__key", key).drop("__label"))
    totals = coded.groupBy("__key").agg(F.try_sum("error").alias("label_error"))
    # A label may hold a third of the rows: its rows are dealt over salts.
    return join_unique(coded, totals, ["__key"]).select(
        F.col("__id").alias(id_column), "code", "error", "label_error"), books
