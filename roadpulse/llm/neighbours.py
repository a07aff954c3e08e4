"""Exact top-k search by inner product as a Voronoi kNN join.

Inner products become distances: with M the largest norm of the data, a data vector x is lifted to
(x, sqrt(M^2 - |x|^2)) and a query q to (q, 0), so that |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, and the
nearest data are those of the highest product.

1. Pivots are data vectors: of a bounded sample (`SAMPLE` rows, the least by a hash of the vector) the ones that
   are farthest from each other. Queries and data go to the cell of their nearest pivot.
2. Summaries. Each cell of queries has the least and largest distance of its queries to every pivot, each cell
   of data the k + 1 least distances to its own pivot (one more, as a query's own row doesn't count). A
   query of cell i lies within high[i, j] of pivot j, so a row at distance s of pivot j lies within high[i, j] + s
   of it: the (k + 1)-th least of these sums bounds the k-th neighbour's distance for the whole cell.
3. Replication. A row x is at least max over pivots p of (d(x, p) - high[i, p], low[i, p] - d(x, p)) from all queries
   of cell i. It is sent to the groups of the cells for which this isn't more than the bound, and to no others.
   Groups are cells with near pivots, up to `BLOCK` queries; a larger cell is dealt over several groups.
4. A group's data is dealt over salts, each with a copy of the group's queries, which a task holds while
   the data stream past in order of their ids. Cell by cell, only the rows that the cell needs are multiplied.
   The best k of each salt meet in a window.

Bounds are floating point with a margin far above their rounding; products are exact integers. Where vectors
have no clusters, as with random ones of many dimensions, bounds rule out little and each group gets all data:
that costs time and shuffle, the result stays exact.

Rows: vectors that are null or hold null or non-finite components, or a component of 2^26 / `SCALE` or more, take no
part. Shorter vectors count as filled up with zeros. Rows of a query's own id are not its candidates; if several
rows have a query's id, the one with the least vector asks. Repeated rows are candidates each. Null ids are
candidates that lose ties (as does the id 2^63 - 1, which stands for them). Fewer candidates than k are all
given. Empty tables give no rows. Only the two columns named are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadpulse.llm.vectors import integers, matrix, whole
from roadpulse.session import materialise

SCALE, PIVOTS, SAMPLE = 256, 32, 1024
#: Queries that a task holds, and queries and rows that are multiplied at a time.
BLOCK, TILE = 1 << 17, 1 << 10
NO_ID = (1 << 63) - 1
NO_SCORE = -(1 << 62)


class Space:
    """The pivots and the distances of lifted rows to them."""

    def __init__(self, rows: np.ndarray, norm: float, count: int) -> None:
        self.norm = norm
        self.pivots, self.lift = rows, self._lift(rows)
        far = np.full(len(rows), np.inf)
        chosen: list[int] = []
        while len(chosen) < min(count, len(rows)) and (not chosen or far.max() > 0):
            chosen.append(int(far.argmax()))
            far = np.minimum(far, self._to(rows, self._lift(rows), [chosen[-1]])[:, 0])
        self.pivots, self.lift = rows[chosen], self.lift[chosen]

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0))

    def _to(self, x: np.ndarray, lift: np.ndarray, pivots: list[int] | slice) -> np.ndarray:
        inner = x @ self.pivots[pivots].T + lift[:, None] * self.lift[pivots]
        return np.sqrt(np.maximum(2 * self.norm ** 2 - 2 * inner, 0))

    def of_data(self, x: np.ndarray) -> np.ndarray:
        return self._to(x, self._lift(x), slice(None))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + self.norm ** 2 - 2 * (q @ self.pivots.T), 0))


class Plan:
    """Which groups a cell's queries are in, and which cells a data row is needed for."""

    def __init__(self, space: Space, low: np.ndarray, high: np.ndarray, bound: np.ndarray, count: np.ndarray,
                 block: int) -> None:
        self.space, self.low, self.high = space, low, high
        largest = max(space.norm, float(high[count > 0].max(initial=0)))
        self.bound = bound + 1e-6 * largest
        self.first, self.groups_of = np.zeros(len(count), dtype=np.int64), np.ones(len(count), dtype=np.int64)
        self.used = np.flatnonzero(count)
        groups, free = 0, 0
        for cell in self._in_line(self.used):
            if count[cell] > free:
                self.groups_of[cell] = -(-int(count[cell]) // block)
                self.first[cell] = groups
                groups += int(self.groups_of[cell])
                free = block - int(count[cell]) if self.groups_of[cell] == 1 else 0
            else:
                self.first[cell] = groups - 1
                free -= int(count[cell])
        self.groups = groups

    def _in_line(self, cells: np.ndarray) -> Iterator[int]:
        """The cells, each followed by the one with the nearest pivot of those left."""
        left = list(cells)
        at = left[0] if left else 0
        while left:
            at = min(left, key=lambda c: float(self.high[at, c]))
            left.remove(at)
            yield at

    def needs(self, gaps: np.ndarray) -> np.ndarray:
        """For each row (its distances to the pivots) and each used cell whether the row may be in its results."""
        out = np.empty((len(gaps), len(self.used)), dtype=bool)
        for i, cell in enumerate(self.used):
            apart = np.maximum(gaps - self.high[cell], self.low[cell] - gaps).max(axis=1)
            out[:, i] = apart <= self.bound[cell]
        return out


class Best:
    """The k best of a group's queries, by score, then smaller id, while rows arrive by ascending id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int) -> None:
        self.ids, self.rows, self.k = ids, rows, k
        self.score = np.full((len(ids), k), NO_SCORE)
        self.found = np.full((len(ids), k), NO_ID)

    def add(self, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Multiplies some of the queries with rows of data."""
        score = np.rint(self.rows[queries] @ rows.T).astype(np.int64)
        order = np.argsort(self.ids[queries])
        at = np.minimum(np.searchsorted(self.ids[queries][order], ids), len(order) - 1)
        own = np.flatnonzero(self.ids[queries][order][at] == ids)
        score[order[at[own]], own] = NO_SCORE
        # Later rows have larger ids: with an equal score they lose to what is there.
        better = score > self.score[queries, -1][:, None]
        if better.sum() > 4 * self.k * len(queries) and len(ids) > self.k:
            better &= score >= np.partition(score, -self.k, axis=1)[:, -self.k][:, None]
        row, column = np.nonzero(better)
        touched, place = np.unique(row, return_inverse=True)
        if not len(touched):
            return
        kept = queries[touched]
        group = np.concatenate([np.repeat(np.arange(len(kept)), self.k), place])
        scores = np.concatenate([self.score[kept].ravel(), score[row, column]])
        found = np.concatenate([self.found[kept].ravel(), ids[column]])
        order = np.lexsort((found, -scores, group))
        starts = np.searchsorted(group[order], np.arange(len(kept)))
        best = order[(starts[:, None] + np.arange(self.k)).ravel()]
        self.score[kept], self.found[kept] = scores[best].reshape(-1, self.k), found[best].reshape(-1, self.k)

    def result(self) -> pd.DataFrame:
        there = self.score > NO_SCORE
        return pd.DataFrame({"query_id": np.repeat(self.ids, self.k)[there.ravel()],
                             "vec_id": self.found[there], "score": self.score[there]})


def _rows(batches: Iterator[pd.DataFrame], width: int, dtype: type) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), TILE):
            part = batch.iloc[at:at + TILE]
            yield part, matrix(part["v"], width, dtype)


def space_of(data: DataFrame, queries: DataFrame, pivots: int) -> tuple[Space, int, type, type] | None:
    """Pivots, width, and the types that hold components (shipped) and their products (multiplied) exactly."""
    facts = [rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))), F.max(
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).first()
        for rows in (data, queries)]
    if any(f[0] is None for f in facts):
        return None
    width, largest = (max(f[i] or 0 for f in facts) for i in (0, 1))
    sample = data.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()
    space = Space(matrix((np.asarray(r["v"]) for r in sample), width, np.float64), float(np.sqrt(facts[0][2])), pivots)
    exact = np.float64 if largest ** 2 * max(1, width) < 1 << 53 else np.int64
    return space, width, np.int16 if largest < 1 << 15 else np.int32, exact


def plan_of(data: DataFrame, queries: DataFrame, space: Space, width: int, k: int, block: int) -> Plan:
    """The summaries of all cells, of which the driver gets pivots x pivots and pivots x (k + 1) rows."""
    count = len(space.pivots)

    def query_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = np.full((count, count), np.inf), np.full((count, count), -np.inf)
        n = np.zeros(count, dtype=np.int64)
        for _, x in _rows(batches, width, np.float64):
            gaps = space.of_queries(x)
            cell = gaps.argmin(axis=1)
            np.minimum.at(low, cell, gaps)
            np.maximum.at(high, cell, gaps)
            n += np.bincount(cell, minlength=count)
        cell, pivot = np.nonzero(np.isfinite(low))
        yield pd.DataFrame({"cell": cell, "pivot": pivot, "low": low[cell, pivot], "high": high[cell, pivot], "n": n[cell]})

    def data_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame({"cell": [], "vec_id": [], "gap": []}).astype({"cell": int, "vec_id": int, "gap": float})
        for part, x in _rows(batches, width, np.float64):
            gaps = space.of_data(x)
            rows = pd.DataFrame({"cell": gaps.argmin(axis=1), "vec_id": part["vec_id"].to_numpy(), "gap": gaps.min(axis=1)})
            # An id counts once; null ids are left out, which only widens the bound.
            held = pd.concat([held, rows[rows["vec_id"] != NO_ID]]).sort_values("gap", kind="stable")
            held = held.drop_duplicates(["cell", "vec_id"]).groupby("cell").head(k + 1)
        yield held

    low, high = np.full((count, count), np.inf), np.zeros((count, count))
    n = np.zeros(count, dtype=np.int64)
    for r in (queries.select("v").mapInPandas(query_cells, "cell int, pivot int, low double, high double, n long")
              .groupBy("cell", "pivot").agg(F.min("low"), F.max("high"), F.sum("n")).collect()):
        low[r[0], r[1]], high[r[0], r[1]], n[r[0]] = r[2:]
    nearest = Window.partitionBy("cell").orderBy("gap", "vec_id")
    cells = (data.mapInPandas(data_cells, "cell int, vec_id long, gap double")
             .groupBy("cell", "vec_id").agg(F.min("gap").alias("gap"))
             .withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k + 1).collect())
    bound = np.full(count, np.inf)
    for cell in np.flatnonzero(n):
        seen: dict[int, float] = {}
        for reach, vec_id in sorted((high[cell, r["cell"]] + r["gap"], r["vec_id"]) for r in cells):
            seen.setdefault(vec_id, reach)
            if len(seen) > k:
                bound[cell] = reach
                break
    return Plan(space, low, high, bound, n, block)


def join(queries: DataFrame, data: DataFrame, k: int, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of `data` (vec_id, v) for each row of `queries` (vec_id, v).

    Both hold integer vectors, and ids without nulls; an id is in `queries` once.
    """
    spark = data.sparkSession
    found = space_of(data, queries, pivots)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    space, width, packed, exact = found
    plan = plan_of(data, queries, space, width, k, block)
    salts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // plan.groups))
    shared = spark.sparkContext.broadcast(plan)
    schema = "grp long, salt int, side int, vec_id long, v binary"

    def send_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        for part, x in _rows(batches, width, np.float64):
            cell = plan.space.of_queries(x).argmin(axis=1)
            ids = part["vec_id"].to_numpy()
            dealt = (pd.util.hash_array(ids) >> np.uint64(1)).astype(np.int64)
            rows = pd.DataFrame({"grp": plan.first[cell] + dealt % plan.groups_of[cell], "salt": 0, "side": 0,
                                 "vec_id": ids, "v": [r.tobytes() for r in x.astype(packed)]})
            for salt in range(salts):
                yield rows.assign(salt=salt)

    def send_data(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        for part, x in _rows(batches, width, np.float64):
            needs = plan.needs(plan.space.of_data(x))
            ids, vectors = part["vec_id"].to_numpy(), [r.tobytes() for r in x.astype(packed)]
            salt = pd.util.hash_array(ids) % np.uint64(salts)
            sent = np.zeros((len(x), plan.groups), dtype=bool)
            for i, cell in enumerate(plan.used):
                sent[:, plan.first[cell]:plan.first[cell] + plan.groups_of[cell]] |= needs[:, i:i + 1]
            row, group = np.nonzero(sent)
            yield pd.DataFrame({"grp": group, "salt": salt[row].astype(np.int32), "side": 1, "vec_id": ids[row],
                                "v": [vectors[i] for i in row]})

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        key, ids, vectors, best, cells = None, [], [], None, []
        for batch in batches:
            new = (batch[["grp", "salt", "side"]].diff().fillna(0) != 0).any(axis=1).to_numpy()
            cuts = [0, *np.flatnonzero(new).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.iloc[a:b]
                group, salt, side = part[["grp", "salt", "side"]].iloc[0]
                if (group, salt) != key:
                    if best is not None:
                        yield best.result()
                    key, ids, vectors, best = (group, salt), [], [], None
                x = np.frombuffer(bytearray().join(part["v"]), dtype=packed).reshape(len(part), width)
                if side == 0:
                    ids.append(part["vec_id"].to_numpy())
                    vectors.append(x)
                    continue
                if best is None and not ids:    # one of a cell's groups that no query was dealt to
                    continue
                if best is None:
                    best = Best(np.concatenate(ids), np.concatenate(vectors).astype(exact), k)
                    own = plan.space.of_queries(best.rows.astype(np.float64)).argmin(axis=1)
                    cells = [np.flatnonzero(own == cell) for cell in plan.used]
                    ids, vectors = [], []
                for at in range(0, len(x), TILE):
                    rows, names = x[at:at + TILE].astype(exact), part["vec_id"].to_numpy()[at:at + TILE]
                    needs = plan.needs(plan.space.of_data(rows.astype(np.float64)))
                    for need, own in zip(needs.T, cells):
                        if need.any():
                            for q in range(0, len(own), TILE):
                                best.add(own[q:q + TILE], names[need], rows[need])
        if best is not None:
            yield best.result()

    rows = queries.mapInPandas(send_queries, schema).unionByName(data.mapInPandas(send_data, schema))
    key = ["grp", "salt"]
    some = (rows.repartition(*key).sortWithinPartitions(*key, "side", "vec_id")
            .mapInPandas(solve, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")


def top_k(rows: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows of the highest inner product with each row that `is_query` picks (by id, as column `vec_id`)."""
    vectors = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("x")).filter(
        whole("x")).select("vec_id", integers("x", SCALE).alias("v")).filter(F.col("v").isNotNull())
    data = materialise(vectors.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))))
    asked = data.filter((F.col("vec_id") != NO_ID) & is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    return join(materialise(asked), data, k)
