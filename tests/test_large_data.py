"""Operators for large inputs: feed files by ranges, sketches per run, points along a curve."""

import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import clustering, duplicates as dup, grid, lookup, sketches
from roadpulse.sources import feeds, ranges
from tests.test_sources_and_sinks import a_jam, an_alert, put

TRICKY = ['"', "\\", '\\"', "a,b", "]", "[{", "}", "ñ", "\\\\", "中", "\n", "{\"x\": [1, 2]}", ""]


def objects(rng, count):
    out = []
    for i in range(count):
        text = "".join(rng.choice(TRICKY) for _ in range(rng.randrange(12)))
        out.append({"uuid": f"u{i}", "street": text, "subtype": rng.choice(TRICKY), "more": [[1, "]"], {"a": "[,"}],
                    "roadType": rng.choice([None, 1, "x"])})
    return out


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 20])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, monkeypatch, size):
    """Cuts inside strings, escapes and signs of several bytes; small steps past the end of a range."""
    rng = random.Random(size)
    monkeypatch.setattr(ranges, "_STEP", 16)
    monkeypatch.setattr(ranges, "MOST_TASKS", 8)
    few = 3 if size < 8 else 60
    for name, text in {
        "plain.json": json.dumps(objects(rng, few)), "wide.json": json.dumps(objects(rng, few), indent=3, ensure_ascii=False),
        "empty_list.json": " [ ] ", "mark.json": "﻿\n [" + json.dumps(a_jam(1)) + "]\n", "scalars.json": '[1, "a,b", null, [2, 3], {}]',
    }.items():
        put(tmp_path / "flat", name, text)
    want = feeds.read_flat_feed(spark, str(tmp_path / "flat"))
    got = ranges.read_large_flat_feed(spark, str(tmp_path / "flat"), range_bytes=size)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_ranges_of_unusable_files(spark, tmp_path):
    folder = tmp_path / "flat"
    put(folder, "good.json", [an_alert("a")])
    put(folder, "cut.json", json.dumps([an_alert("a"), an_alert("b")])[:-9])
    put(folder, "open_string.json", '[{"uuid": "a}]')
    put(folder, "nested.json", {"celdas": [1, 2]})
    put(folder, "empty.json", "")
    found = ranges.flat_ranges(spark, str(folder), range_bytes=16)
    bad = {r.file.rsplit("/", 1)[1]: r.reason for r in ranges.unusable_flat_files(found).collect()}
    assert bad == {"cut.json": "malformed", "open_string.json": "malformed", "nested.json": "no_list"}
    assert [r.file.rsplit("/", 1)[1] for r in ranges.read_flat_ranges(found).collect()] == ["good.json"]


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    folder = tmp_path / "flat"
    put(folder, "one.json", json.dumps([{"uuid": f"u{i}", "street": 'x"],[{' * 10} for i in range(20_000)]))
    rows = ranges.read_large_flat_feed(spark, str(folder), range_bytes=1 << 16)
    parts = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in parts) == 20_000 and len(parts) > 3
    assert rows.filter(F.col("uuid") == F.concat(F.lit("u"), F.col("pos").cast("string"))).count() == 20_000


# -- sketches -------------------------------------------------------------------------------

def test_merged_latencies_are_within_the_rank_error(spark):
    rng = random.Random(1)
    log = [(f"run{i % 7}", "hit" if i % 3 else "miss", rng.lognormvariate(3, 2)) for i in range(60_000)]
    log += [("run0", "hit", None), ("run1", "no_encontrado", None), ("run2", "one", 5.0)]
    df = spark.createDataFrame(log, "run string, resultado string, tiempo_ms double")
    kept = sketches.latency_sketches(df)
    got = {r.resultado: r for r in sketches.merged_percentiles(kept).collect()}
    assert set(got) == {"hit", "miss", "one"} and (got["one"].n, got["one"].p50, got["one"].p99) == (1, 5.0, 5.0)
    for outcome in ("hit", "miss"):
        values = sorted(ms for _, o, ms in log if o == outcome and ms is not None)
        assert got[outcome].n == len(values)
        exact = {r.resultado: r for r in lookup.latency_percentiles(df).collect()}[outcome]
        for q in (50, 90, 99):
            rank = sum(v <= got[outcome][f"p{q}"] for v in values) / len(values)
            assert abs(rank - q / 100) <= sketches.KLL_RANK_ERROR
            assert sum(v <= exact[f"p{q}"] for v in values) / len(values) == pytest.approx(q / 100, abs=1e-3)
    share = {(r.run, r.resultado): r.share for r in sketches.latency_rank(kept, 20.0).collect()}
    mine = [ms for run, o, ms in log if (run, o) == ("run3", "hit")]
    assert share["run3", "hit"] == pytest.approx(sum(v <= 20 for v in mine) / len(mine), abs=sketches.KLL_RANK_ERROR)
    assert sketches.merged_percentiles(kept.limit(0)).collect() == []


def keyed_items(spark, count, seed=0):
    rng = random.Random(seed)
    rows = [(f"r{rng.randrange(3)}", f"k{rng.randrange(count)}" if rng.random() < 0.99 else None, rng.choice(["alerta", "atasco"]))
            for _ in range(3 * count)]
    return rows, spark.createDataFrame(rows, "run string, uuid string, kind string")


@pytest.mark.parametrize("lg, count, error", [(14, 500, 0), (10, 40_000, 0.12)])
def test_key_sketches_against_the_exact_queries(spark, lg, count, error):
    """Exact up to the sketch's size; beyond it within four standard errors (and those of intersections)."""
    rows, df = keyed_items(spark, count)
    kept = sketches.key_sketches(df, lg=lg)
    near = lambda n: pytest.approx(n, rel=error, abs=0)
    by_run = {run: {k for r, k, _ in rows if r == run and k} for run in ("r0", "r1", "r2")}
    before = set()
    for r in sketches.key_summary(kept).orderBy("run").collect():
        mine = df.filter(F.col("run") == r.run)
        exact = dup.key_counts(mine).first()
        assert (r.objects, r.distinct_keys, r.repeated_keys) == (exact.total, near(exact.distinct_keys), near(exact.repeated_keys))
        assert r.mixed_keys == near(dup.mixed_keys(mine).count()) and r.kept_keys == near(len(before & by_run[r.run]))
        before = by_run[r.run]
    one, other = by_run["r0"], by_run["r2"]
    got = sketches.overlap(kept, "r0", "r2").first()
    assert tuple(got) == (near(len(one & other)), near(len(one | other)), near(len(one - other)))
    total = sketches.all_runs(kept).first()
    assert (total.objects, total.distinct_keys) == (sum(k is not None for _, k, _ in rows), near(len(set().union(*by_run.values()))))
    assert total.mixed_keys == near(dup.mixed_keys(df).count())


def test_sketch_of_an_absent_run(spark):
    _, df = keyed_items(spark, 50)
    got = sketches.overlap(sketches.key_sketches(df), "r0", "none").first()
    assert got.shared_keys == 0 and got.all_keys == got.lost_keys > 0


# -- areas ----------------------------------------------------------------------------------

def test_an_area_reads_a_small_share_of_a_clustered_table(spark, tmp_path):
    points = spark.range(40_000).select(
        F.col("id"), (F.lit(-71.0) + F.pmod(F.xxhash64("id"), F.lit(5000)) / 10000).alias("location_x"),
        (F.lit(-33.2) - F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)) / 10000).alias("location_y"))
    points = points.unionByName(spark.sql("select -1L as id, null as location_x, -33.3D as location_y"))
    plain, curve = str(tmp_path / "plain"), str(tmp_path / "curve")
    points.write.option("maxRecordsPerFile", 500).parquet(plain)
    clustering.write_clustered(points, curve, rows_per_file=500)
    box = (-33.30, -33.34, -70.80, -70.75)

    def share(path):
        read = total = 0
        for file in spark.read.parquet(path).inputFiles():
            meta = pq.ParquetFile(file.removeprefix("file://")).metadata
            for g in range(meta.num_row_groups):
                stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in (1, 2)}
                x, y = stats["location_x"], stats["location_y"]
                total += 1
                read += x.has_min_max and not (x.min > box[3] or x.max < box[2] or y.min > box[0] or y.max < box[1])
        return read / total

    inside = lambda path: sorted(r.id for r in grid.within_bounds(spark.read.parquet(path), *box).collect())
    assert inside(curve) == inside(plain) and inside(curve)
    assert share(plain) > 0.9 and share(curve) < 0.15
    plan = grid.within_bounds(spark.read.parquet(curve), *box)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(location_x), IsNotNull(location_y), GreaterThanOrEqual(location_x" in plan
    assert spark.read.parquet(curve).count() == 40_001


def test_the_curve_keeps_neighbours_together(spark):
    place = clustering.curve_place(F.col("x"), F.col("y"))
    rows = spark.createDataFrame([(-71.0, -33.2), (-200.0, 90.0), (None, -33.3), (200.0, -90.0)], "x double, y double")
    got = [r[0] for r in rows.select(place).collect()]
    assert got[0] == got[1] == 0 and got[2] is None and got[3] == 2 ** 32 - 1


def test_short_ranges_share_tasks_and_long_ones_have_their_own(spark, tmp_path, monkeypatch):
    """The number of tasks follows the bytes, not the number of ranges."""
    for n in range(4):
        (tmp_path / f"{n}.json").write_text(json.dumps([{"uuid": f"u{i}", "street": "x" * 90} for i in range(400)]))
    found = ranges.flat_ranges(spark, str(tmp_path), range_bytes=100)
    least = ranges._TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert found.count() > 10 * least
    objects = ranges.read_flat_ranges(found)
    assert objects.rdd.getNumPartitions() == least
    rows = [(r.file[-6:], r.pos, json.loads(r.o)["uuid"]) for r in objects.collect()]
    assert sorted(rows) == sorted((f"{n}.json", i, f"u{i}") for n in range(4) for i in range(400))
    monkeypatch.setattr(ranges, "RANGE_BYTES", 100)
    assert ranges._dealt(found).rdd.getNumPartitions() == found.count()
