import random

import pytest
from pyspark.sql import Window, functions as F

from roadpulse.functions import draws as random_draws
from roadpulse.operators import (
    documents as docs, duplicates as dup, grid, lookup, numbering, quality, rollups, sampling, skew,
    staging, suppression, topk,
)
from roadpulse.schemas import (
    ALERT_COLUMNS, ALERT_DOCUMENT, ALERTS, JAM_COLUMNS, JAM_DOCUMENT, JAMS, RESULT_COLUMNS,
)


def alert(uuid="a", city="C", muni="false", kind="ACCIDENT", street="S", confidence=1.0, x=0.0, y=0.0,
          fecha="2025-06-01 07:30:00"):
    return (uuid, city, muni, kind, street, confidence, x, y, fecha)


def jam(uuid="1", severity=1, country="CL", length=10, endnode="E", roadtype=1, speed=1.0, street="S",
        fecha="2025-06-01 07:30:00", region="R", city="C"):
    return (uuid, severity, country, length, endnode, roadtype, speed, street, fecha, region, city)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# -- staging --------------------------------------------------------------------------------

def test_stage_alerts_defaults(spark):
    rows = [
        {"uuid": None, "n": 0},
        {"uuid": "b", "city": "peñaflor, malloco", "location": {"x": 1.0, "y": 2.0}, "x": 9.0, "n": 1},
        {"uuid": "c", "x": 3.0, "y": 4.0, "confidence": 5.0, "n": 2},
    ]
    schema = ALERT_DOCUMENT.simpleString()[len("struct<"):-1] + ",n:int"
    full = [{f: r.get(f) for f in [*ALERT_DOCUMENT.fieldNames(), "n"]} for r in rows]
    got = staging.stage_alerts(spark.createDataFrame(full, f"struct<{schema}>"), "n").collect()
    assert [tuple(r) for r in got] == [
        ("item_0", "", "", "", "", 0.0, 0.0, 0.0, ""),
        ("b", "Peñaflor;Malloco", "", "", "", 0.0, 1.0, 2.0, ""),
        ("c", "", "", "", "", 5.0, 3.0, 4.0, ""),
    ]


def test_stage_jams_speed_and_missing_numbers(spark):
    rows = [{"uuid": 7, "speed": 2.5}, {"uuid": 8, "speedKMH": 1.5, "speed": 2.5}]
    full = [{f: r.get(f) for f in JAM_DOCUMENT.fieldNames()} for r in rows]
    got = staging.stage_jams(spark.createDataFrame(full, JAM_DOCUMENT)).collect()
    assert [(r.uuid, r.speed, r.length, r.country) for r in got] == [("7", 2.5, None, ""), ("8", 1.5, None, "")]


def test_lenient_cast_never_fails(spark):
    texts = spark.createDataFrame([("a",) + ("abc",) * 8], ALERT_COLUMNS)
    assert staging.cast_leniently(texts, ALERTS).first().confidence is None


# -- quality --------------------------------------------------------------------------------

def test_clean_alerts_edges(spark):
    rows = [
        alert("k1", city=None), alert("k2", city=""), alert("k3", confidence=None), alert("k4", confidence=0.0),
        alert("uuid", city="city"), alert(None),
        alert("k5", fecha="2025-06-02 00:00:00"), alert("k5", fecha="2025-06-01 00:00:00", street="early"),
        alert("k6", street="B"), alert("k6", street="A"),
    ]
    got = {r.uuid: r.street for r in quality.clean_alerts(spark.createDataFrame(rows, ALERTS)).collect()}
    assert got == {"k4": "S", "k5": "early", "k6": "A"}


def test_first_per_key_uses_sequence_and_is_idempotent(spark):
    df = spark.createDataFrame([("a", "t", 2), ("a", "t", 1), ("b", "t", 3)], "uuid string, fecha string, seq int")
    once = quality.first_per_key(df, ["uuid"], ["fecha", "seq"])
    assert sorted(map(tuple, once.collect())) == [("a", "t", 1), ("b", "t", 3)]
    assert sorted(quality.first_per_key(once, ["uuid"], ["fecha", "seq"]).collect()) == sorted(once.collect())


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(quality.first_per_key(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_shifted_rows_with_vocabulary(spark):
    df = spark.createDataFrame([alert("a", kind="false"), alert("b", kind="zzz"), alert("c")], ALERTS)
    assert [r.uuid for r in quality.shifted_rows(df).collect()] == ["a"]
    assert {r.uuid for r in quality.shifted_rows(df, ["ACCIDENT"]).collect()} == {"a", "b"}


def test_funnel_shrinks(spark):
    df = spark.createDataFrame([alert("a"), alert("a"), alert("b", city=""), alert("uuid")], ALERTS)
    assert tuple(quality.funnel(df, ALERT_COLUMNS, "alerta").first()) == ("alerta", 3, 2, 1)


# -- duplicates -----------------------------------------------------------------------------

@pytest.mark.parametrize("kinds, merged", [
    (["desconocido", "alerta"], "mixto"), (["alerta", "desconocido"], "alerta"),
    (["alerta", "atasco"], "mixto"), (["atasco", "atasco"], "atasco"),
    (["desconocido", "desconocido"], "desconocido"), (["atasco", "desconocido", "alerta"], "mixto"),
])
def test_flat_kind_merge(spark, kinds, merged):
    rows = [("f", i, "u", kind) for i, kind in enumerate(kinds)]
    items = spark.createDataFrame(rows, "file string, pos long, uuid string, kind string")
    assert dup.flat_keys_by_file(items).first().kind == merged


def test_file_summary_of_unknown_kind_and_empty(spark):
    schema = "file string, pos long, uuid string, kind string"
    rows = [("f", 0, "u", "desconocido"), ("f", 1, "u", "desconocido"), ("f", 2, "w", "alerta")]
    summary = dup.file_summary(dup.flat_keys_by_file(spark.createDataFrame(rows, schema)))
    row = summary.first()
    assert (row.unique_keys, row.duplicated, row.dup_desconocido, row.dup_percent) == (2, 1, 1, 50.0)
    none = dup.file_summary(dup.keys_by_file(spark.createDataFrame([], schema)))
    assert tuple(dup.global_summary(none).first()) == (0, 0, 0)


def test_repeated_instances_of_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", f"f{i % 7}", i) for i in range(3000)] + [("twice", "f0", -1), ("twice", "f9", 0)]
    df = spark.createDataFrame(rows, "uuid string, file string, pos int")
    got = {(r.uuid, r.instance): (r.file, r.pos) for r in dup.repeated_instances(df).collect()}
    hot = sorted((f, p) for u, f, p in rows if u == "hot")
    assert [got[("hot", i + 1)] for i in range(len(hot))] == hot
    assert got[("twice", 1)] == ("f0", -1) and got[("twice", 2)] == ("f9", 0)
    assert len(got) == len(hot) + 2


# -- rollups and top-k ----------------------------------------------------------------------

def some_alerts(spark, n=400):
    rng = random.Random(5)
    kinds, cities = ["ACCIDENT", "JAM"], ["A", "B", "C"]
    rows = [alert(f"u{i}", rng.choice(cities), kind=rng.choice(kinds), street=f"s{rng.randrange(9)}",
                  fecha=f"2025-06-01 {rng.randrange(24):02d}:00:00") for i in range(n)]
    return spark.createDataFrame(rows, ALERTS)


@pytest.mark.parametrize("ranking", [
    rollups.peak_hours, rollups.alerts_by_city, rollups.alerts_by_type, rollups.alerts_by_street,
    rollups.accidents_by_city, rollups.accidents_by_street_city,
])
def test_cube_gives_the_same_rankings(spark, ranking):
    alerts = some_alerts(spark)
    assert ranking(rollups.alert_cube(alerts), "n").collect() == ranking(alerts).collect()


def test_group_counts_add_up(spark):
    alerts = some_alerts(spark)
    assert rollups.alerts_by_city(alerts).agg(F.sum("cantidad_alertas")).first()[0] == 400
    assert rollups.count_rows(alerts.limit(0)).first()[0] == 0


def test_result_tables_and_charts(spark):
    jams = spark.createDataFrame([jam("1", length=5), jam("2", length=9, city="D"), jam("3", length=None)], JAMS)
    results = rollups.result_tables(some_alerts(spark), jams, some_alerts(spark))
    assert {name: df.columns for name, df in results.items()} == RESULT_COLUMNS
    assert [r.uuid for r in results["atascos_largos"].collect()] == ["2", "1", "3"]
    assert topk.charts_for("atascos_por_ciudad.csv") == ["atascos_por_ciudad_largo", "atascos_por_ciudad_numero"]
    assert topk.chart_data("atascos_por_ciudad_largo", results).first().ciudad == "D"
    with pytest.raises(KeyError):
        topk.charts_for("alertas_count")
    assert "TakeOrderedAndProject" in plan(topk.chart_data("calles_con_mas_alertas", results))


def test_hours_without_a_value_come_first(spark):
    hours = spark.createDataFrame([("07", 3), (None, 1), ("00", 2)], "hora string, cantidad_alertas long")
    assert [r.hora_etiqueta for r in topk.hour_distribution(hours).collect()] == ["Sin hora", "00", "07"]


# -- skewed join, numbering -----------------------------------------------------------------

@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_join_unique_equals_a_plain_join(spark, how):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 60, 2)], "k long, v string")
    got = skew.join_unique(rows, table, ["k"], how, share=0.01)
    want = rows.join(table, ["k"], how)
    assert sorted(got.collect(), key=str) == sorted(want.select(*got.columns).collect(), key=str)


def test_hot_keys_are_bounded_and_salted(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    hot = skew.hot_keys(rows, ["k"], 0.01).collect()
    assert [(r["k"], r["__salts"]) for r in hot] == [(0, 34)]


def test_number_rows_is_dense_and_global(spark):
    values = list(range(997))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(x,) for x in values], "x int").repartition(13)
    got = {r.x: r.n for r in numbering.number_rows(df, ["x"], "n", start=1).collect()}
    assert got == {x: x + 1 for x in range(997)}


def test_number_within_equals_row_number(spark):
    rng = random.Random(2)
    rows = [(None if i % 11 == 0 else "hot" if rng.random() < 0.5 else f"k{i % 5}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, pos int").repartition(9)
    got = {r.pos: r.n for r in numbering.number_within(df, ["k"], ["pos"], "n").collect()}
    seen = {}
    for k, pos in rows:
        seen[k] = seen.get(k, 0) + 1
        assert got[pos] == seen[k]


def test_running_total_over_small_blocks(spark):
    df = spark.range(1000).select(F.col("id").alias("p"), (F.col("id") % 7).alias("v")).repartition(5)
    got = {r.p: r.t for r in numbering.running_total(df, "p", "v", "t", block=10).collect()}
    total = 0
    for p in range(1000):
        total += p % 7
        assert got[p] == total


def test_total_within_splits_hot_and_null_keys(spark):
    rows = [(None if i % 5 == 0 else "hot" if i % 5 < 4 else "cold", i, i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, pos long, v long").repartition(7)
    got = {r.pos: r.t for r in numbering.total_within(df, ["k"], ["pos"], F.col("v"), "t").collect()}
    seen = {}
    for k, pos, v in rows:
        seen[k] = seen.get(k, 0) + v
        assert got[pos] == seen[k]


def test_latency_percentiles_without_a_window_by_outcome_alone(spark):
    rows = [("hit", i / 1000) for i in range(1, 1001)] + [("miss", 5.0), ("miss", 5.0), ("miss", None), (None, 1.0)]
    got = lookup.latency_percentiles(spark.createDataFrame(rows, "resultado string, tiempo_ms double"))
    assert {tuple(r) for r in got.collect()} == {
        ("hit", 1000, 0.5, 0.9, 0.99), ("miss", 2, 5.0, 5.0, 5.0), (None, 1, 1.0, 1.0, 1.0)}
    empty = spark.createDataFrame([], "resultado string, tiempo_ms double")
    assert lookup.latency_percentiles(empty).collect() == []


# -- time to live ---------------------------------------------------------------------------

def fills_by_hand(events, ttl):
    last, fills = {}, set()
    for key, t in sorted(events, key=lambda e: e[1]):
        if key not in last or t - last[key] >= ttl:
            last[key] = t
            fills.add((key, t))
    return fills


def test_ttl_fixture(spark):
    df = spark.createDataFrame([("k", t) for t in (0, 100, 299, 300, 500, 601)], "k string, t long")
    assert sorted(r.t for r in suppression.fill_moments(df, ["k"], "t").collect()) == [0, 300, 601]


@pytest.mark.parametrize("ttl, chunk, gap", [(300, 300, 40), (300, 900, 100), (300, None, 250), (7, 7, 1), (7, 21, 6), (10, 30, 25)])
def test_ttl_against_a_plain_loop(spark, ttl, chunk, gap):
    rng = random.Random(ttl * 1000 + gap)
    events = []
    for key in ("hot", "warm", "cold", "before"):
        t = -50000 if key == "before" else rng.randrange(1000)
        for _ in range({"hot": 900, "warm": 200, "cold": 5, "before": 300}[key]):
            t += rng.randrange(0, gap * (1 if key == "hot" else 3) + 1)
            events += [(key, t)] * rng.randrange(1, 3)
    df = spark.createDataFrame(events, "k string, t long").repartition(6)
    got = [tuple(r) for r in suppression.fill_moments(df, ["k"], "t", ttl, chunk).collect()]
    assert len(got) == len(set(got)) and set(got) == fills_by_hand(events, ttl)


def test_ttl_of_dense_keys(spark):
    """Chunks that pass on as many possible fills as a time-to-live has seconds."""
    rng = random.Random(8)
    events = [("hot", t) for t in range(5000) if rng.random() < 0.9] + [("k", t) for t in range(0, 5000, 7)]
    events += [("full", t) for t in range(3000)] + [(None, t) for t in range(0, 3000, 2)]
    df = spark.createDataFrame(events, "k string, t long")
    for chunk in (60, 100, 600):
        assert {tuple(r) for r in suppression.fill_moments(df, ["k"], "t", 60, chunk).collect()} == fills_by_hand(events, 60)


@pytest.mark.parametrize("rare", [0, 50])
def test_ttl_in_rounds_that_grow_with_the_logarithm_of_the_chunks(spark, monkeypatch, rare):
    """One key with 80,000 chunks in a row, each entered with a fill of the one before."""
    written = []
    whole = suppression.materialise
    monkeypatch.setattr(suppression, "materialise", lambda df: written.append(whole(df)) or written[-1])
    seconds = [t for t in range(0, 240_000) if not rare or t % rare != 1]
    df = spark.createDataFrame([("k", t) for t in seconds], "k string, t long").repartition(4)
    got = sorted(r.t for r in suppression.fill_moments(df, ["k"], "t", 2, 3).collect())
    assert got == sorted(t for _, t in fills_by_hand([("k", t) for t in seconds], 2))
    chunks, maps, *rounds = written
    assert chunks.count() == 80_000 and len(rounds) <= 18
    assert sum(r.count() for r in rounds) <= 18 * 80_000


def test_request_outcomes(spark):
    asked = [("alerta", "a", 0), ("alerta", "a", 0), ("alerta", "a", 299), ("alerta", "a", 300),
             ("alerta", "zz", 5), ("atasco", "a", 6), ("alerta", "zz", 7)]
    requests = spark.createDataFrame([(i, t, kind, u) for i, (kind, u, t) in enumerate(asked)],
                                     "seq long, segundo long, tipo string, uuid string")
    keys = spark.createDataFrame([("alerta", "a")], "tipo string, uuid string")
    got = [r.resultado for r in suppression.request_outcomes(requests, keys).orderBy("seq").collect()]
    missing = "no_encontrado"
    assert got == ["miss", "hit", "hit", "miss", missing, missing, missing]


# -- lookups --------------------------------------------------------------------------------

def test_jam_lookup_needs_digits(spark):
    requests = spark.createDataFrame([("7",), ("x-7",), ("8",)], "uuid string")
    got = lookup.lookup_jams(requests, spark.createDataFrame([("7", "C")], "uuid string, city string"))
    assert {(r.uuid, r.city, r.estado) for r in got.collect()} == {
        ("7", "C", "encontrado"), ("x-7", None, "no_encontrado"), ("8", None, "no_encontrado")}


def test_key_list_drops_empty_and_zero(spark):
    assert [r.uuid for r in lookup.key_list(spark.createDataFrame([("a",), ("",), (None,)], "uuid string")).collect()] == ["a"]
    assert [r.uuid for r in lookup.key_list(spark.createDataFrame([(5,), (0,), (None,)], "uuid long")).collect()] == ["5"]


def test_summary_of_an_empty_log(spark):
    log = spark.createDataFrame([], "segundo long, resultado string, tiempo_ms double")
    row = lookup.request_summary(log).first()
    assert row.total_requests == 0 and row.hit_rate == 0 and row.hit_ms_mean == 0 and row.requests_per_second == 0


# -- grid -----------------------------------------------------------------------------------

def test_grid_cells(spark):
    cells = {r.indice_celda: r for r in grid.grid_cells(spark).collect()}
    assert len(cells) == 32 and (cells[0].top, cells[0].left) == (-33.2, -71.0)
    assert cells[31].bottom == pytest.approx(-33.7068) and cells[31].right == pytest.approx(-70.4664)
    assert (cells[9].zona_aproximada, cells[9].fila, cells[9].columna, cells[9].grid_size) == ("Celda 10", 2, 2, "8x4")


def test_each_point_has_the_cell_whose_box_holds_it(spark):
    rng = random.Random(3)
    points = spark.createDataFrame(
        [(i, rng.uniform(-71.05, -70.4), rng.uniform(-33.75, -33.15)) for i in range(500)],
        "i int, location_x double, location_y double")
    placed = grid.assign_cell(points)
    boxes = [r for r in grid.grid_cells(spark).collect()]
    for r in placed.collect():
        inside = [b.indice_celda for b in boxes
                  if b.left <= r.location_x < b.right and b.bottom < r.location_y <= b.top]
        assert inside == ([] if r.indice_celda is None else [r.indice_celda])
    assert "NestedLoop" not in plan(placed)


def test_null_keys_of_a_join_are_spread(spark):
    rows = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 5000).alias("k"), "id")
    table = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "32"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = skew.join_unique(rows, table, ["k"], share=0.01)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 100_000 and max(sizes) < 1.5 * 100_000 / 32
        assert joined.filter("v is null").count() == 50_000
        assert skew.join_unique(rows, table, ["k"], "inner", share=0.01).count() == 50_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_zipf_exponents_near_one_are_refused(spark):
    with pytest.raises(ValueError):
        random_draws.zipf("z", F.col("id"), 1.05)


# -- sampling, documents, accounting --------------------------------------------------------

def test_samples_are_skewed_and_complete(spark):
    keys = spark.range(50).select(F.lit("alerta").alias("tipo"), F.format_string("k%03d", "id").alias("uuid"))
    draws = spark.range(2000).select(F.col("id").alias("draw"))
    zipf = sampling.sample_zipf(sampling.listed_keys(keys), draws)
    counts = {r.uuid: r["count"] for r in zipf.groupBy("uuid").count().collect()}
    assert sum(counts.values()) == 2000 and max(counts, key=counts.get) == "k000"
    normal = sampling.sample_normal(sampling.shuffled_keys(keys), draws)
    assert normal.count() == 2000
    middle = normal.filter(F.col("indice").between(15, 34)).count() / 2000
    assert 0.38 < middle < 0.52      # about 45 % within 0.6 deviations


def test_ingest_accounting(spark):
    items = spark.createDataFrame(
        [("f1", "alerta", "a"), ("f1", "alerta", "a"), ("f2", "alerta", "a"), ("f2", "alerta", None),
         ("f2", "alerta", None), ("f2", "alerta", "b"), ("f2", "atasco", "a")], "file string, kind string, uuid string")
    got = {(r.file, r.kind): (r.found, r.inserted, r.duplicates) for r in docs.ingest_accounting(items).collect()}
    assert got == {("f1", "alerta"): (2, 1, 1), ("f2", "alerta"): (4, 2, 2), ("f2", "atasco"): (1, 1, 0)}
    stored = spark.createDataFrame([("alerta", "b"), ("alerta", None)], "kind string, uuid string")
    again = docs.ingest_accounting(items, stored)
    assert tuple(docs.ingest_totals(again).first()) == (2, 7, 2, 5)


def test_ingest_accounting_opens_its_items_once(spark):
    from roadpulse.plans import queries
    plan = queries.ingest_accounting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Generate" not in plan and "events" not in plan


def test_number_within_few_takes_one_shuffle(spark):
    """Keys that go on over partitions, a null key and nulls among the values, as `row_number` has them."""
    rows = [((None, "a", "b", "b")[i % 4], None if i % 17 == 0 else i * 7919 % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long, id long").repartition(7)
    numbered = numbering.number_within_few(df, "k", [F.bitwise_not("v"), "id"], "n")
    got = {(r.id, r.n) for r in numbered.collect()}
    place = Window.partitionBy("k").orderBy(F.bitwise_not("v"), "id")
    assert got == {(r.id, r.n) for r in df.withColumn("n", F.row_number().over(place)).collect()}


def test_numbered_documents_shuffle_their_rows_once(spark, monkeypatch):
    results = {"t": spark.range(50).selectExpr("id % 7 as c", "cast(id as string) as u", "cast(null as int) as z"),
               "s": spark.range(3).selectExpr("nullif(id, 1) as c", "'x' as u")}
    orders = {"t": [("c", False), ("u", True)], "s": [("c", False)]}
    sources = []
    whole = numbering.materialise
    monkeypatch.setattr(numbering, "materialise", lambda df, *more: (sources.append(df.columns), whole(df, *more))[1])
    found = docs.numbered_documents(results, orders, "now")
    assert sources == [["__name", "t", "s", "__stamp"]]
    want = [r for name, df in results.items() for r in docs.as_index_rows(docs.result_documents(
        name, df, [F.col(c) if up else F.desc(c) for c, up in orders[name]], "now")).collect()]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want))


def test_numbered_documents_are_sorted_by_columns(spark, monkeypatch):
    """Nothing is computed at each comparison; numbers too large for the first key, nulls and ties come out as ranked."""
    far = [None, 0, 1, -1, 2**53, 2**53 + 1, 2**53 + 2, -2**53, -2**53 - 1, -2**53 - 2, 2**63 - 1, -2**63]
    rows = [(n, f"u{i % 3}", n, float(i)) for i, n in enumerate(far * 3)]
    df = spark.createDataFrame(rows, "c long, u string, d long, x double")
    results = {"down": df, "up": df, "text": df, "short": df.select("c").distinct(), "whole": df.selectExpr("cast(x as int) as x")}
    orders = {"down": [("c", False), ("u", True), ("x", True)], "up": [("c", True), ("u", True), ("x", False)],
              "text": [("u", True), ("d", False), ("x", True)], "short": [("c", False)], "whole": [("x", False)]}
    plans = []
    whole = numbering.materialise
    monkeypatch.setattr(numbering, "materialise", lambda df, *more: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), whole(df, *more))[1])
    found = docs.numbered_documents(results, orders, "now").collect()
    steps = [line for line in plans[0].split("\n") if "Sort [" in line or "RepartitionByExpression" in line]
    assert len(steps) == 2 and not any("CASE" in line for line in steps)
    want = [r for name, df in results.items() for r in docs.as_index_rows(docs.result_documents(
        name, df, [F.col(c) if up else F.desc(c) for c, up in orders[name]], "now")).collect()]
    assert sorted(map(tuple, found)) == sorted(map(tuple, want))


def test_content_is_the_text_but_for_when_it_was_processed(spark):
    df = spark.createDataFrame([(1, 'a","fecha_procesamiento":"x",'), (2, None)], "c int, u string")
    both = [docs.numbered_documents({"t": df}, {"t": [("c", True)]}, when, content=True).withColumn(
        "stored", docs.stored_content(F.col("_source"))).collect() for when in ("now", "then")]
    assert all(r.content == r.stored for rows in both for r in rows)
    assert [r.content for r in both[0]] == [r.content for r in both[1]] and both[0][0]._source != both[1][0]._source


def test_result_documents(spark):
    result = spark.createDataFrame([("A", 5), ("B", 9)], "comuna string, cantidad long")
    got = docs.result_documents("t", result, [F.desc("cantidad")], "2024-01-01T00:00:00").orderBy("fila_numero").collect()
    assert [(r._index, r._id, r.comuna, r.fila_numero) for r in got] == [
        ("analisis_t", "t_0", "B", 1), ("analisis_t", "t_1", "A", 2)]


def test_report_fields_have_defaults(spark):
    df = spark.createDataFrame([("u", None, "T", None, None, "f", 1)],
                               "uuid string, subtype string, type string, reportBy string, city string, file string, pos int")
    assert tuple(staging.report_fields(df).first()) == ("u", "N/A", "T", "N/A", "N/A", "f", 1)


def test_complete_jams_drops_null_length(spark):
    df = spark.createDataFrame([jam("1", length=None), jam("2")], JAMS)
    assert [r.uuid for r in quality.complete(df, JAM_COLUMNS).collect()] == ["2"]


def test_bounding_box_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "points")
    spark.createDataFrame([alert("a", x=-70.9, y=-33.3), alert("b")], ALERTS).write.parquet(path)
    df = grid.within_bounds(spark.read.parquet(path), -33.2, -33.4, -71.0, -70.8).select("uuid")
    text = plan(df)
    assert [r.uuid for r in df.collect()] == ["a"]
    assert "GreaterThanOrEqual(location_x,-71.0)" in text and "confidence" not in text.split("ReadSchema")[1].split("\n")[0]


def test_counting_shuffles_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "alerts")
    some_alerts(spark).withColumn("seq", F.monotonically_increasing_id()).write.parquet(path)
    clean = quality.clean_alerts(spark.read.parquet(path), ("seq",))
    shuffled = [line for line in rollups.count_rows(clean)._jdf.queryExecution().optimizedPlan().toString().split("\n")
                if "Window [" in line or "Project [" in line]
    assert not any("location_x" in line for line in shuffled)


def test_approximate_key_counts(spark):
    rows = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("uuid"))
    total, distinct = dup.approximate_key_counts(rows).first()
    assert total == 3000 and abs(distinct - 1000) < 50


def test_a_third_of_all_requests_on_one_key_is_spread(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(-1, 30000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.join_unique(rows, table, ["k"], "inner", share=0.01)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 30000 and max(sizes) < 30000 / 8 * 1.5
