"""Exact Jaccard join of shingle sets: pivots, Voronoi regions, triangle-inequality windows.

The Jaccard distance is a metric, and two documents link if it is at most r = 1 - the threshold. Equal sets
are one class from the start, so that copies cost nothing below.

1. Pivots of the first level are single shingles. Shingles are ranked, rare before frequent, and each class
   goes to the regions of its first n - ceil(threshold * n) + 1 shingles: a set that has none of these is
   more than r away, since at least so many of the n are missing from it. (Whole documents don't serve as
   pivots here: nearly all distances between unrelated documents are 1, so every window would hold
   everything.) Regions with one class end there, and of regions with equal members one is kept.
2. In a region, parity sketches are compared: of n shingles hashed to about n bits, each flips one. The
   Hamming distance of two sketches is a metric and never more than the size of the symmetric difference,
   which for a link is at most (1 - t) / (1 + t) times both sizes. The empty set is the pivot of this level:
   sizes are distances to it, so only sets of like size can link. Regions too large for a task are cut
   into shells by it, with each class copied to its own shell and the next, and shells that are still
   too large into blocks by hash, of which each pair is a cell. What may link is joined to families.
3. A family's whole sets meet, each shipped once. Pivots are drawn from it, each class goes to its nearest
   pivot and to every other that is at most 2 r further away, and the regions so made are joined in the
   same way until they are small or no longer shrink; then intersections are counted for all pairs by a
   matrix product. A family too large for a task gets a document as its pivot and is first cut into shells
   of width r by the distance to it (and into pairs of blocks, as above).

A cell returns a star for each connected group, not its pairs. Stars are joined over all cells by
alternating large-star and small-star steps, so a chain of links of any length ends in one component.

Ranks come from counting the shingles of all documents; the frequent ones (at most `HOT_SHINGLES`, so the
list may be broadcast) rank by count, all others before them by hash. Any ranking gives the same links.

Rows: null texts and texts without words have empty sets, which link with nothing, not even each other.
Repeated rows are copies. Component ids ignore null doc_ids; a component of nothing else has a null one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.llm.boilerplate import key_of
from roadpulse.llm.text import small_batches, text_of, unused
from roadpulse.session import materialise

#: A shingle of at least so many documents is frequent, and at most so many are listed.
HOT_COUNT, HOT_SHINGLES = 32, 1 << 20
#: Shingles that a task gathers before it passes them on, and those of one cell.
GATHER, CELL = 1 << 19, 1 << 22
#: Classes whose sketches one cell compares.
MEMBERS = 1 << 13
#: Classes that are compared by a matrix product rather than divided again, and its columns at a time.
SMALL, COLUMNS = 256, 1 << 14
#: Keys of documents are broadcast while there are at most so many (about 50 MB); else both sides shuffle.
BROADCAST_KEYS = 1 << 20


#: Odd multipliers that tell the places of a shingle apart.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


# -- shingles -----------------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd multiplier and of its inverse, modulo 2^64, as far as they were needed."""

    base = 0x9E3779B97F4A7C15
    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            def powers(x: int) -> np.ndarray:
                out = np.full(max(n, 2 * len(cls.up)), x, dtype=np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            cls.up, cls.down = powers(cls.base), powers(pow(cls.base, -1, 1 << 64))
        return cls.up, cls.down


# Bytes with capitals made small, and 0 for white space: of bytes only ASCII counts for both.
_FOLDED = np.array([0 if c in b" \t\n\v\f\r" else c + 33 if 65 <= c <= 90 else c + 1 for c in range(256)], dtype=np.uint64)


def word_hashes(text: object) -> np.ndarray:
    """A 64-bit hash of each word: its bytes as a polynomial, from running sums over the whole text."""
    data = text_of(text).encode()
    points = _FOLDED[np.frombuffer(data, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff((points > 0).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _Powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(points * up[:len(data)], out=sums[1:])
    out = _mix((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts > 512):  # where polynomials of this kind could be made to collide
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].lower())
    return out


def shingles(text: object, k: int) -> np.ndarray:
    """The distinct shingles of `k` words as sorted 64-bit hashes; of a shorter text its whole sequence."""
    hashed = word_hashes(text)
    size = min(k, len(hashed))
    if not size:
        return np.empty(0, dtype=np.uint64)
    out = np.full(len(hashed) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out += hashed[i:len(hashed) - size + 1 + i] * np.uint64(_ODD[i % len(_ODD)] + 2 * (i // len(_ODD)))
    return np.unique(_mix(out))


def prefix_length(n: int, percent: int) -> int:
    """How many first shingles decide that a set shares one of them with any set that it links to."""
    return n + percent * n // -100 + 1 if n else 0


# -- counting -----------------------------------------------------------------------------------

def bucket_bits(spark: SparkSession) -> int:
    """Buckets follow the session's number of shuffle partitions, which follows the input."""
    return max(8, math.ceil(math.log2(4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))


def short(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits by which shingles are counted: those of the bucket and 32 more."""
    return (hashes >> np.uint64(32 - bits)).astype(np.int64)


def hot_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted short hashes of the frequent shingles of all documents, and their counts.

    Tasks count what they gather and send, for each bucket, the hashes seen once and those seen more
    often with their counts, packed: a few bytes for each distinct shingle.
    """
    bits = bucket_bits(docs.sparkSession)

    def pack(gathered: list[np.ndarray]) -> pd.DataFrame:
        found, n = np.unique(short(np.concatenate(gathered), bits), return_counts=True)
        rows = []
        for bucket, at in _by_bucket(found >> 32):
            low, counts = found[at].astype(np.uint32), n[at].astype(np.uint32)
            often = counts > 1
            rows.append((bucket, low[~often].tobytes(), np.stack([low[often], counts[often]]).tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "once", "often"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _gathered((shingles(t, k) for b in batches for t in b["text"]), pack)

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        once = [np.frombuffer(b, np.uint32) for b in rows["once"]]
        often = [np.frombuffer(b, np.uint32).reshape(2, -1) for b in rows["often"]]
        low = np.concatenate(once + [o[0] for o in often])
        n = np.concatenate([np.ones(sum(map(len, once)), np.int64)] + [o[1].astype(np.int64) for o in often])
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order]
        starts = np.flatnonzero(np.diff(low, prepend=low[:1] + np.uint32(1)))
        total = np.add.reduceat(n, starts) if len(starts) else n
        hot = total >= HOT_COUNT
        return pd.DataFrame({"shingle": (int(key[0]) << 32) + low[starts][hot].astype(np.int64), "n": total[hot]})

    hot = materialise(
        docs.select("text").mapInPandas(gather, "bucket long, once binary, often binary")
        .groupBy("bucket").applyInPandas(count, "shingle long, n long"))
    rows = hot.count()
    if rows > HOT_SHINGLES:
        hot = hot.filter(F.col("n") > hot.agg(F.percentile("n", 1 - HOT_SHINGLES / rows)).scalar())
    listed = hot.toPandas().sort_values("shingle")
    return listed["shingle"].to_numpy(np.int64), listed["n"].to_numpy(np.int64)


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The stretches of a sorted array of buckets."""
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(buckets)]):
        yield int(buckets[a]), slice(a, b)


def _gathered(arrays: Iterator, pack) -> Iterator[pd.DataFrame]:
    """`pack` of the arrays, `GATHER` elements or a little more at a time."""
    held, size = [], 0
    for a in arrays:
        held.append(a)
        size += len(a)
        if size >= GATHER:
            yield pack(held)
            held, size = [], 0
    if size:
        yield pack(held)


def parity(hashes: np.ndarray) -> bytes:
    """A bit for each bucket, set if an odd number of shingles falls into it; n to 2 n buckets, at least 64."""
    buckets = max(64, 1 << max(0, len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits(counts & 1, bitorder="little").tobytes()


# -- regions ------------------------------------------------------------------------------------

def sketch_documents(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """For each document its keys, set size, class, parity sketch, and the frequent and rare shingles of its prefix."""
    bits = bucket_bits(docs.sparkSession)
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(docs, k))

    def sketch(text: object) -> tuple:
        found = shingles(text, k)
        listed, counts = hot.value
        n = np.zeros(len(found), dtype=np.int64)
        if len(listed):
            key = short(found, bits)
            at = np.minimum(np.searchsorted(listed, key), len(listed) - 1)
            n = np.where(listed[at] == key, counts[at], 0)
        first = np.lexsort((found, n))[:prefix_length(len(found), percent)]
        name = blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
        often = n[first] > 0
        signed = found.view(np.int64)
        return len(found), name, parity(found), signed[first[often]], signed[first[~often]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([sketch(t) for t in batch.pop("text")], columns=["n", "class", "sketch", "hot", "rare"],
                                index=batch.index)
            yield pd.concat([batch, rows], axis=1)

    d1, d2 = key_of(F.col("doc_id"), F.col("text"))
    return materialise(docs.select("doc_id", d1.alias("d1"), d2.alias("d2"), "text").mapInPandas(
        run, "doc_id long, d1 long, d2 long, n long, class binary, sketch binary, hot array<long>, rare array<long>"))


def rare_regions(sketches: DataFrame, percent: int) -> DataFrame:
    """(pivot, class) for the rare pivots of at least two classes whose sizes allow a link.

    Rare pivots have few documents each, so a bucket of them is bounded. Pivots, sizes and classes travel
    packed. A class goes if neither the next smaller nor the next larger set of the pivot is near in size.
    """
    bits = bucket_bits(sketches.sparkSession)

    def pack(gathered: list[np.ndarray]) -> pd.DataFrame:
        pairs = np.concatenate(gathered)
        pairs = pairs[np.argsort(pairs[:, 0])]
        return pd.DataFrame([(bucket, pairs[at].tobytes()) for bucket, at in _by_bucket(
            (pairs[:, 0] >> np.uint64(64 - bits)).astype(np.int64))], columns=["bucket", "pairs"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def arrays() -> Iterator[np.ndarray]:
            for batch in batches:
                for name, n, rare in zip(batch["class"], batch["n"], batch["rare"]):
                    out = np.empty((len(rare), 4), dtype=np.uint64)
                    out[:, 0] = np.asarray(rare, dtype=np.int64).view(np.uint64)
                    out[:, 1], out[:, 2:] = n, np.frombuffer(name, dtype=np.uint64)
                    yield out
        yield from _gathered(arrays(), pack)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        pairs = np.concatenate([np.frombuffer(b, dtype=np.uint64).reshape(-1, 4) for b in rows["pairs"]])
        pairs = pairs[np.lexsort(pairs.T[::-1])]
        pairs = pairs[np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))]  # copies are one class
        sizes = pairs[:, 1].astype(np.int64)
        near = (pairs[1:, 0] == pairs[:-1, 0]) & (100 * sizes[:-1] >= percent * sizes[1:])
        shared = pairs[np.append(near, False) | np.insert(near, 0, False)]
        return pd.DataFrame({"pivot": shared[:, 0].astype(np.int64),
                             "class": [row.tobytes() for row in shared[:, 2:]]})

    return (sketches.filter(F.size("rare") > 0).select("class", "n", "rare")
            .mapInPandas(gather, "bucket long, pairs binary")
            .groupBy("bucket").applyInPandas(meet, "pivot long, class binary"))


def regions(sketches: DataFrame, percent: int) -> DataFrame:
    """(region, class): all regions of at least two classes, without those that have another's members."""
    hot = sketches.select(F.explode("hot").alias("pivot"), "class").distinct()
    members = materialise(rare_regions(sketches, percent).unionByName(hot))
    digest = [F.xxhash64("class"), F.xxhash64(F.lit("second"), "class")]
    kept = (
        members.groupBy("pivot").agg(F.count("*").alias("size"), *(F.bit_xor(d).alias(f"x{i}") for i, d in enumerate(digest)))
        .filter("size > 1").groupBy("size", "x0", "x1").agg(F.min("pivot").alias("pivot")).select("pivot"))
    return materialise(members.join(kept, "pivot").select(F.col("pivot").alias("region"), "class"))


def sets_of(docs: DataFrame, sketches: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(class, n, shingles) of every class that has a family, from one document of each."""
    wanted = members.select("class").distinct()
    keys = materialise(sketches.join(wanted, "class", "left_semi").groupBy("class").agg(
        F.min(F.struct("d1", "d2")).alias("d")).select("d.d1", "d.d2"))
    d1, d2 = key_of(F.col("doc_id"), F.col("text"))
    some = docs.select(d1.alias("d1"), d2.alias("d2"), "text").join(
        F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, ["d1", "d2"], "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, k) for t in batch["text"]]
            yield pd.DataFrame({
                "class": [blake2b(s.tobytes(), digest_size=16).digest() for s in found],
                "n": [len(s) for s in found], "shingles": [s.view(np.int64) for s in found]})

    return materialise(some.select("text").mapInPandas(run, "class binary, n long, shingles array<long>")
                       .dropDuplicates(["class"]))


def cut(rows: DataFrame, by: str, shell: Column, limit: int) -> DataFrame:
    """`rows` of (`by`, class, weight, ...) with `shell` and `pair`; large groups are cut into such cells.

    Classes that link lie in the same or in neighbouring shells, so each goes to its own and the next.
    A shell of more than `limit` is cut into blocks by hash: block i meets block j in the cell of that pair.
    """
    rest = [c for c in rows.columns if c not in (by, "weight")]
    large = materialise(rows.groupBy(by).agg(F.sum("weight").alias("w")).filter(F.col("w") > limit).select(by))
    whole = [by, F.lit(0).alias("shell"), F.lit(0).alias("pair"), *rest]
    if large.isEmpty():
        return rows.select(*whole)
    small = rows.join(large, by, "left_anti").select(*whole)
    shells = materialise(rows.join(large, by, "left_semi")
                         .withColumn("shell", F.explode(F.array(shell, shell + 1))))
    blocks = shells.groupBy(by, "shell").agg(F.ceil(F.sum("weight") * 2 / limit).cast("int").alias("blocks"))
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("class"), "blocks").cast("int")).otherwise(0)
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: (
        F.least(block, other) * F.col("blocks") + F.greatest(block, other)).cast("int"))
    return small.unionByName(
        shells.join(blocks, [by, "shell"]).withColumn("pair", F.explode(pairs))
        .select(by, "shell", "pair", *rest))


def by_cell(rows: DataFrame, by: str, function: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """(a, b) from `function(rows of a cell)` for every cell of at least two rows.

    Cells are many and most of them small, so a task reads its sorted rows in large batches and divides
    these itself; it holds one batch and the cell that is being gathered.
    """
    key = [by, "shell", "pair"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            rows = batch.reset_index(drop=True)
            new = np.zeros(len(rows), dtype=bool)
            for c in key:
                values = rows[c].to_numpy()
                new[1:] |= values[1:] != values[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), len(rows)]
            out = []
            for a, b in zip(starts, starts[1:]):
                part = rows.iloc[a:b]
                if held and any(held[-1][c].iloc[-1] != part[c].iloc[0] for c in key):
                    out.append(held)
                    held = []
                held = [*held, part]
            yield from solved(out)
        yield from solved([held])

    def solved(found: list[list[pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        results = [function(pd.concat(parts) if len(parts) > 1 else parts[0])
                   for parts in found if sum(map(len, parts)) > 1]
        if results:
            yield pd.concat(results)

    return rows.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, "a binary, b binary")


# -- sketches -----------------------------------------------------------------------------------

def linked_sketches(n: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """A number for each class, equal for classes that chains of near sketches connect.

    From one class after another all near ones that weren't reached before are taken, so that groups of
    copies shrink at once. Sketches of different lengths are compared at the shorter one's.
    """
    group, left = np.full(len(n), -1), np.argsort(n, kind="stable")
    lengths = np.array([len(s) for s in sketches]) // 8
    folded: dict[tuple[int, int], np.ndarray] = {}

    def rows(length: int, at: int) -> np.ndarray:
        """The sketches of `length` words, folded to `at` words."""
        if (length, at) not in folded:
            all_ = np.stack([np.frombuffer(sketches[i], dtype=np.uint64) for i in np.flatnonzero(lengths == length)])
            folded[length, at] = np.bitwise_xor.reduce(all_.reshape(len(all_), length // at, at), axis=1)
        return folded[length, at]

    place = np.empty(len(n), dtype=np.int64)
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        place[own] = np.arange(len(own))
    for number, first in enumerate(left.tolist()):
        if group[first] >= 0:
            continue
        group[first] = number
        queue = [first]
        left = left[group[left] < 0]
        while queue:
            i = queue.pop()
            like = left[(100 * n[left] >= percent * n[i]) & (percent * n[left] <= 100 * n[i])]
            for length in np.unique(lengths[like]):
                js = like[lengths[like] == length]
                at = int(min(length, lengths[i]))
                apart = np.bitwise_count(rows(int(length), at)[place[js]] ^ rows(int(lengths[i]), at)[place[i]]).sum(axis=1)
                near = js[(100 + percent) * apart.astype(np.int64) <= (100 - percent) * (n[js] + n[i])]
                group[near] = number
                queue += near.tolist()
            if len(like):
                left = left[group[left] < 0]
    return group


def families(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(family, class): classes whose sketches are near in some region, joined over all regions."""
    known = sketches.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # The empty set as pivot: sizes of linked classes differ by a factor of 100 / percent at most.
    shell = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) + 1e-9)).cast("int")
    rows = members.join(known, "class").withColumn("weight", F.lit(1))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return stars(list(rows["class"]), linked_sketches(rows["n"].to_numpy(), list(rows["sketch"]), percent))

    near = components(by_cell(cut(rows, "region", shell, MEMBERS), "region", run))
    return materialise(near.unionByName(near.select(F.col("b").alias("a"), "b").distinct()).select(
        F.col("b").alias("family"), F.col("a").alias("class")))


def stars(names: list[bytes], groups: np.ndarray) -> pd.DataFrame:
    """Every name but the first of its group, with that first one."""
    _, first, own = np.unique(groups, return_index=True, return_inverse=True)
    return pd.DataFrame([(names[i], names[j]) for i, j in enumerate(first[own].tolist()) if i != j], columns=["a", "b"])


# -- whole sets ---------------------------------------------------------------------------------

class Cell:
    """The exact join of a cell's sets."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent, self.reach = percent, 1 - percent / 100
        self.size = np.array([len(s) for s in sets])
        _, flat, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Only shingles of several sets can be in an intersection; they get new numbers.
        number = np.where(n > 1, np.cumsum(n > 1) - 1, -1)
        self.width = int((n > 1).sum())
        self.sets = [s[s >= 0] for s in np.split(number[flat], np.cumsum(self.size)[:-1])]
        self.group = np.arange(len(sets))

    def compare(self, left: np.ndarray, right: np.ndarray) -> None:
        """Counts all intersections of two blocks, some columns at a time, and joins groups that link."""
        common = np.zeros((len(left), len(right)), dtype=np.float32)
        for at in range(0, self.width, COLUMNS):
            common += self.dense(left, at) @ self.dense(right, at).T
        common = np.rint(common).astype(np.int64)
        both = self.size[left][:, None] + self.size[right][None, :] - common
        for i, row in zip(left, 100 * common >= self.percent * both):
            others = np.unique(self.group[right[row]])
            others = others[others != self.group[i]]
            if len(others):
                self.group[np.isin(self.group, others)] = self.group[i]

    def dense(self, rows: np.ndarray, at: int) -> np.ndarray:
        out = np.zeros((len(rows), min(COLUMNS, self.width - at)), dtype=np.float32)
        for i, r in enumerate(rows):
            s = self.sets[r]
            out[i, s[(s >= at) & (s < at + COLUMNS)] - at] = 1
        return out

    def distances(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        inside = np.zeros(self.width + 1, dtype=np.int64)
        inside[self.sets[pivot]] = 1
        common = np.array([inside[self.sets[r]].sum() for r in rows])
        return 1 - common / (self.size[rows] + self.size[pivot] - common)

    def join(self, rows: np.ndarray) -> None:
        """Voronoi regions with windows of 2 r, or all pairs of small or indivisible ones, block by block."""
        if len(rows) > SMALL:
            gaps = np.stack([self.distances(rows, p) for p in rows[:: len(rows) // 8][:8]])
            # What links to a member of a pivot's region is inside its window too.
            within = gaps <= gaps.min(axis=0) + 2 * self.reach + 1e-9
            if within.sum(axis=1).max() <= 0.8 * len(rows):
                for inside in within:
                    self.join(rows[inside])
                return
        for i in range(0, len(rows), SMALL):
            for j in range(i, len(rows), SMALL):
                self.compare(rows[i:i + SMALL], rows[j:j + SMALL])


def links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each cell and connected group of classes, every class with the group's first."""
    pivot = sets.select("class", "shingles").join(
        members.groupBy("family").agg(F.min("class").alias("class"), F.count("*").alias("m")).filter(f"m > {SMALL}"),
        "class").select("family", F.col("shingles").alias("__p"))
    near = F.size(F.array_intersect("shingles", "__p"))
    gap = 1 - near / (F.col("weight") + F.size("__p") - near)
    # A little more than r, so that rounding doesn't part classes that are just r away.
    shell = F.coalesce(F.floor(gap / ((100 - percent) / 100 + 1e-9)).cast("int"), F.lit(0))
    rows = members.join(sets.withColumnRenamed("n", "weight"), "class").join(pivot, "family", "left").withColumn(
        "__shell", shell).drop("__p")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cell = Cell([np.asarray(s, dtype=np.int64) for s in rows["shingles"]], percent)
        cell.join(np.arange(len(rows)))
        return stars(list(rows["class"]), cell.group)

    return by_cell(cut(rows, "family", F.col("__shell"), CELL).drop("__shell"), "family", run)


# -- components ---------------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node that has an edge, but the least of its component, with that least one."""
    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(least.select("a", F.col("m").alias("b"))))

    def stored(e: DataFrame) -> tuple[DataFrame, tuple]:
        e = materialise(e.filter("a != b").distinct())
        return e, tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges, seen = stored(edges)
    while True:
        edges, now = stored(small(large(edges)))
        if now == seen:
            return edges
        seen = now


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, d1, d2 (key of doc_id and text), n_shingles, component (a class) and component_id of every document.

    Two documents link if 100 * the size of their sets' intersection >= `percent` * that of the union.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = sketch_documents(docs, k, percent)
    members = families(regions(sketches, percent), sketches, percent)
    sets = sets_of(docs, sketches, members, k)
    linked = components(links(members, sets, percent))
    least = sketches.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    named = least.join(linked.withColumnRenamed("a", "class"), "class", "left").withColumn("b", F.coalesce("b", "class"))
    ids = named.groupBy("b").agg(F.min("least").alias("component_id"))
    of_class = named.join(ids, "b").select("class", F.col("b").alias("component"), "component_id")
    return sketches.join(of_class, "class", "left").select(
        "doc_id", "d1", "d2", "component", F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that with the least doc_id (then the least key), as it came.

    Documents without words stay. Rows equal in doc_id and text are one document: one row of them stays.
    """
    found = near_duplicates(docs, k, percent).filter(F.col("component").isNotNull())
    key = unused(docs, "__d1", "__d2")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "d1", "d2")
    named = materialise(found.select("component", F.col("d1").alias(key[0]), F.col("d2").alias(key[1]), order.alias("k")))
    # Only components and documents of several rows have anything to drop.
    several = named.groupBy("component").agg(F.min("k").alias("first"), F.count("*").alias("m")).filter("m > 1")
    rows = materialise(named.join(several.select("component", "first"), "component"))
    gone = materialise(rows.filter(F.col("k") != F.col("first")).select(*key).distinct())
    again = materialise(rows.filter(F.col("k") == F.col("first")).groupBy(*key).count().filter("count > 1").select(*key))
    d1, d2 = key_of(F.col("doc_id").cast("long"), F.col("text"))
    small = lambda keys: F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    kept = docs.withColumns(dict(zip(key, (d1, d2)))).join(small(gone), key, "left_anti")
    if not again.isEmpty():
        kept = kept.join(small(again), key, "left_anti").unionByName(
            kept.join(small(again), key, "left_semi").dropDuplicates(key))
    return kept.select(*docs.columns)
