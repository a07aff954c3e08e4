import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from roadpulse.operators import documents, duplicates as dup, incremental
from roadpulse.operators.suppression import fill_moments
from roadpulse.plans import jobs
from roadpulse.schemas import ALERTS, JAMS, RESULT_ORDER, struct
from roadpulse.session import drop_materialised, drop_table, materialise
from roadpulse.sinks import buckets, keyed, writers
from roadpulse.sources import feeds, tables
from roadpulse.streaming.ingest import ingest_feed, unseen_within
from roadpulse.streaming import refresh
from roadpulse.streaming.refresh import refresh_index, refresh_results_on_stream
from roadpulse.streaming.suppression import fills_on_stream


def put(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def cell(alerts=None, jams=None):
    data = {k: v for k, v in (("alerts", alerts), ("jams", jams)) if v is not None}
    return {"data": data}


def an_alert(uuid, **more):
    base = {"uuid": uuid, "city": "peñaflor, malloco", "reportByMunicipalityUser": "false", "type": "ACCIDENT",
            "street": "Av. A, B", "confidence": 1, "location": {"x": -70.9, "y": -33.3}, "fecha": "2025-06-01 07:30:00"}
    return {k: v for k, v in {**base, **more}.items() if v is not ...}


def a_jam(uuid, **more):
    base = {"uuid": uuid, "severity": 2, "country": "CL", "length": 10, "endNode": "E", "roadType": 1,
            "speedKMH": 3.5, "street": "S", "fecha": "2025-06-01 07:30:00", "region": "R", "city": "lo prado"}
    return {**base, **more}


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    put(folder, "f1.json", {"celdas": [
        cell([an_alert("a"), an_alert("a", street="later")], [a_jam(1)]), {}, {"data": {}}, cell([], [])]})
    put(folder, "f2.json", {"celdas": [cell([an_alert("a", street="other file"), an_alert("b", confidence=...),
                                             an_alert(...), an_alert(..., street="x")], [a_jam(1), a_jam(2, length=99)])]})
    put(folder, "f3.json", {"otros": 1})
    put(folder, "f4.json", '{"celdas": [')
    return folder


def test_read_feed_and_quarantine(spark, feed):
    read = feeds.read_feed(spark, str(feed))
    bad = {r.file_name: r.reason for r in feeds.quarantined_documents(read).collect()}
    assert bad == {"f3.json": "missing_celdas", "f4.json": "malformed"}
    good = feeds.good_documents(read)
    assert feeds.unnest_alerts(good).count() == 6 and feeds.unnest_jams(good).count() == 3
    items = feeds.feed_items(good)
    assert items.filter("kind = 'alerta'").count() == 6 and items.select("file", "pos").distinct().count() == 9


def test_feed_files_of_several_lines(spark, tmp_path):
    """A file is one JSON value however it is laid out."""
    put(tmp_path / "feed", "nested.json", json.dumps({"celdas": [cell([an_alert("a")], [a_jam(1)])]}, indent=2))
    put(tmp_path / "feed", "flat.json", json.dumps([an_alert("b"), a_jam(2)], indent=2))
    read = feeds.read_documents(spark, str(tmp_path / "feed"))
    assert read.count() == 2 and feeds.quarantined_documents(read).isEmpty()
    assert sorted(r.uuid for r in feeds.mixed_items(read).collect()) == ["1", "2", "a", "b"]


def test_flat_feed(spark, tmp_path):
    put(tmp_path / "flat", "l.json", [
        {"uuid": 5, "roadType": 1, "street": "S"}, {"uuid": "u", "subtype": "x", "reportRating": 3}, {"type": "T"}])
    rows = feeds.read_flat_feed(spark, str(tmp_path / "flat")).orderBy("pos").collect()
    assert [(r.file.endswith("/flat/l.json"), r.pos, r.uuid, r.roadType) for r in rows] == [
        (True, 0, "5", "1"), (True, 1, "u", None), (True, 2, None, None)]


def test_a_mistyped_field_costs_neither_its_object_nor_its_file(spark, tmp_path):
    put(tmp_path / "feed", "f.json", {"celdas": [
        cell([an_alert("a", confidence="high"), an_alert("b", location="here"), an_alert("c", confidence="0.5"), "text"],
             [a_jam(1, length="far"), a_jam("x"), a_jam(2, length=7.0)]),
        "no cell", {"data": 3}, cell({"not": "a list"}, [a_jam(3, length=2.5)])]})
    read = feeds.read_feed(spark, str(tmp_path / "feed"))
    assert feeds.quarantined_documents(read).isEmpty()
    good = feeds.good_documents(read)
    alerts = [(r.uuid, r.confidence, r.location and r.location.x) for r in feeds.unnest_alerts(good).orderBy("pos").collect()]
    assert alerts == [("a", None, -70.9), ("b", 1.0, None), ("c", 0.5, -70.9), (None, None, None)]
    jams = [(r.uuid, r.length, r.severity) for r in feeds.unnest_jams(good).orderBy("cell", "pos").collect()]
    assert jams == [(1, None, 2), (None, 10, 2), (2, 7, 2), (3, None, 2)]


def test_files_of_one_name_in_two_folders_are_two_files(spark, tmp_path):
    put(tmp_path / "one", "same.json", {"celdas": [cell([an_alert("a")])]})
    put(tmp_path / "two", "same.json", {"celdas": [cell([an_alert("a")])]})
    good = feeds.good_documents(feeds.read_feed(spark, [str(tmp_path / "one"), str(tmp_path / "two")]))
    items = feeds.feed_items(good)
    assert items.select("file").distinct().count() == 2
    assert dup.repeated(dup.keys_by_file(items)).isEmpty()
    accounts = sorted((r.found, r.inserted) for r in documents.ingest_accounting(items).collect())
    assert accounts == [(1, 0), (1, 1)]


def test_a_folder_with_both_shapes(spark, tmp_path):
    folder = tmp_path / "mixed"
    put(folder, "nested.json", {"celdas": [cell([an_alert("a")], [a_jam(1)])]})
    put(folder, "flat.json", [{"uuid": "u", "subtype": "x", "reportRating": "five"}, {"uuid": 5, "roadType": 1, "street": "S"}])
    put(folder, "cut_flat.json", '  [{"uuid": 1}, ')
    put(folder, "cut_nested.json", '{"celdas": [{')
    put(folder, "neither.json", '{"otros": []}')
    put(folder, "blank.json", " ")
    read = feeds.read_documents(spark, str(folder))
    bad = {r.file_name: r.reason for r in feeds.quarantined_documents(read).collect()}
    assert bad == {"cut_flat.json": "malformed", "cut_nested.json": "malformed", "blank.json": "malformed",
                   "neither.json": "missing_celdas"}
    got = sorted((r.file.rsplit("/", 1)[1], r.kind, r.uuid) for r in feeds.mixed_items(read).collect())
    assert got == [("flat.json", "alerta", "u"), ("flat.json", "atasco", "5"),
                   ("nested.json", "alerta", "a"), ("nested.json", "atasco", "1")]


HEADER = "uuid,city,municipalityUser,type,street,confidence,location_x,location_y,fecha\n"


def test_csv_with_quotes_bad_numbers_and_empties(spark, tmp_path):
    put(tmp_path / "csv", "a.csv", HEADER + 'a,C,false,T,"Av. A, B",abc,1.5,2,f\nb,,false,T,"say ""hi""",1,,2,f\n')
    rows = {r.uuid: r for r in tables.read_csv(spark, str(tmp_path / "csv"), ALERTS).collect()}
    assert rows["a"].street == "Av. A, B" and rows["a"].confidence is None and rows["a"].location_x == 1.5
    assert rows["b"].city is None and rows["b"].street == 'say "hi"' and rows["b"].location_x is None


def test_unquoted_reading_shifts_columns_as_expected(spark, tmp_path):
    put(tmp_path / "csv", "a.csv", HEADER + 'a,"Peñaflor, Malloco",false,T,S,1,1,2,f\n')
    assert tables.read_csv(spark, str(tmp_path / "csv"), ALERTS, quoted=False).first().type == "false"
    raw = tables.read_csv(spark, str(tmp_path / "csv"), ALERTS, header=False)
    assert raw.filter("uuid = 'uuid'").count() == 1


def test_jam_street_comma_does_not_move_the_city(spark, tmp_path):
    names = ",".join(JAMS.fieldNames())
    put(tmp_path / "csv", "j.csv", names + '\n1,1,CL,2,E,1,1.0,"A, B",f,R,C\n')
    row = tables.read_csv(spark, str(tmp_path / "csv"), JAMS).first()
    assert (row.city, row.street) == ("C", "A, B")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 1), ('q"x', None)], "s string, n int")
    path = str(tmp_path / "out")
    writers.write_csv(df, path)
    assert sorted(map(str, tables.read_csv(spark, path, df.schema).collect())) == sorted(map(str, df.collect()))


def test_csv_files_follow_the_order(spark, tmp_path):
    path = tmp_path / "out"
    writers.write_csv(spark.range(2000).orderBy(F.desc("id")), str(path))
    lines = [line for file in sorted(path.glob("part-*.csv")) for line in file.read_text().split()]
    assert [int(x) for x in lines if x != "id"] == list(range(1999, -1, -1))


def test_inferred_csv_and_collections(spark, tmp_path):
    put(tmp_path / "csv", "a.csv", "n,s\n1,x\n2,y\n")
    assert dict(tables.read_csv_inferred(spark, str(tmp_path / "csv")).dtypes) == {"n": "int", "s": "string"}
    spark.createDataFrame([(1, "a")], "_id int, uuid string").write.parquet(str(tmp_path / "c"))
    assert tables.read_collection(spark, str(tmp_path / "c")).columns == ["uuid"]
    assert tables.read_collection(spark, str(tmp_path / "c"), keep_id=True).columns == ["_id", "uuid"]


def test_request_summary_and_key_list_as_json(spark, tmp_path):
    log = spark.createDataFrame([("alerta", "hit", 0.001, 0), ("alerta", "hit", 0.001, 1), ("atasco", "miss", 0.004, 4),
                                 ("atasco", "no_encontrado", None, 4)], "tipo string, resultado string, tiempo_ms double, segundo long")
    keys = spark.createDataFrame([("alerta", "a"), ("atasco", None)], "tipo string, uuid string")
    jobs.summarise_requests(log, keys, str(tmp_path), "r")
    whole = spark.read.json(str(tmp_path / "resumen/r")).filter("tipo = 'todos'").first()
    assert (whole.hit_ms, whole.miss_ms, whole.hit_ms_mean, whole.total_requests) == (0.002, 0.004, 0.001, 4)
    lines = "".join(f.read_text() for f in (tmp_path / "claves/r").glob("part-*"))
    assert '{"tipo":"atasco","uuid":null}' in lines


def test_result_files_without_header_stubs(spark, tmp_path):
    put(tmp_path / "r", "horas.csv", "hora,n\n07,3\n")
    put(tmp_path / "r", "encabezado_horas.csv", "hora,n\n")
    rows = tables.read_result_files(spark, str(tmp_path / "r"), spark.createDataFrame([], "hora string, n int").schema)
    assert [(r.hora, r.archivo) for r in rows.collect()] == [("07", "horas.csv")]


def test_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = (writers.run_name(datetime(2025, 1, d, 10, 20, 30)) for d in (1, 2))
    for run, n in ((first, 3), (second, 5), (second, 4)):
        writers.write_run(spark.range(n), path, run)
    writers.write_run(spark.range(9), path, "zz_not_a_run")
    assert tables.run_names(spark, path) == [first, second]
    assert tables.read_latest(spark, path).count() == 4
    assert tables.latest_run(spark.read.parquet(path)).count() == 4


def test_insert_if_absent_keeps_the_first_and_can_be_repeated(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "uuid string, v int"
    one = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4)], schema)
    two = spark.createDataFrame([("a", 0), ("b", 7), (None, 1)], schema)
    for batch, df in ((0, one), (1, two), (1, two), (2, one.union(two))):
        keyed.insert_if_absent(df, path, ["uuid"], ["v"], batch)
    got = sorted(map(tuple, keyed.read_inserted(spark, path).collect()), key=str)
    assert got == [("a", 1), ("b", 7), (None, 4)]


def files_read(df):
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}


def test_insert_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "uuid string, v int"
    rows = lambda *r: spark.createDataFrame(r, schema)
    keyed.insert_if_absent(rows(*((f"k{i}", i) for i in range(200))), path, ["uuid"], ["v"], 0, buckets=16)
    keyed.insert_if_absent(rows(("k3", -1), ("new", 1)), path, ["uuid"], ["v"], buckets=999)    # the store's number holds
    first = rows(("k3", 0), ("other", 0)).withColumn(buckets.BUCKET, buckets.bucket_of(["uuid"], 16))
    known = keyed.stored_keys(spark, path, first, ["uuid"], 7)
    assert files_read(known) == {f"bucket={n}" for n in buckets.touched(first)} and len(files_read(known)) <= 2
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ReadSchema: struct<uuid:string,batch_id:bigint>" in plan
    assert "k3" in {r.uuid for r in known.collect()}
    assert keyed.read_inserted(spark, path).count() == 201
    keyed.compact_keys(spark, path, rows(), ["uuid"])
    assert len(list((tmp_path / "s/_keys").glob("bucket=*/*.parquet"))) <= 16
    keyed.insert_if_absent(rows(("k3", -1), ("new", 2), ("newer", 1)), path, ["uuid"], ["v"])
    got = {r.uuid: r.v for r in keyed.read_inserted(spark, path).collect()}
    assert len(got) == 202 and (got["k3"], got["new"], got["newer"]) == (3, 1, 1)


def test_keys_of_a_batch_that_failed_do_not_count(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "s"), "uuid string, v int"
    insert = lambda *r, **more: keyed.insert_if_absent(spark.createDataFrame(r, schema), path, ["uuid"], ["v"], **more)
    insert(("a", 1))
    with monkeypatch.context() as broken:
        broken.setattr(keyed, "write_batch", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            insert(("b", 2))
    insert(("b", 3), batch=5)       # another number: the keys of the failed batch 1 are there, its rows are not
    insert(("b", 4), ("c", 4))
    assert sorted(map(tuple, keyed.read_inserted(spark, path).collect())) == [("a", 1), ("b", 3), ("c", 4)]


def test_a_store_without_a_key_table_gets_one(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "uuid string, v int"
    keyed.write_batch(spark.createDataFrame([("a", 1), (None, 2)], schema), path)
    keyed.insert_if_absent(spark.createDataFrame([("a", 5), (None, 5), ("b", 5)], schema), path, ["uuid"], ["v"])
    got = sorted(map(tuple, keyed.read_inserted(spark, path).collect()), key=str)
    assert got == [("a", 1), ("b", 5), (None, 2)]


def test_document_store_overwrites_by_id(spark, tmp_path):
    path, schema = str(tmp_path / "index"), "_index string, _id string, _source string"
    keyed.write_documents(spark.createDataFrame([("i", "1", "old"), ("i", "2", "x")], schema), path, 0)
    for _ in range(2):
        keyed.write_documents(spark.createDataFrame([("i", "1", "new"), ("j", "1", "y")], schema), path, 1)
    want = [("i", "1", "new"), ("i", "2", "x"), ("j", "1", "y")]
    assert sorted(map(tuple, keyed.current_documents(spark, path).collect())) == want
    keyed.write_documents(spark.createDataFrame([("i", "1", "old"), ("i", "2", "x")], schema), path, 0)  # late again
    assert sorted(map(tuple, keyed.current_documents(spark, path).collect())) == want
    assert keyed.next_batch(spark, path) == 2


def test_upsert_replaces_only_the_buckets_it_touches(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "index"), "_index string, _id string, _source string"
    documents = lambda *r: spark.createDataFrame(r, schema)
    keyed.write_documents(documents(*(("i", str(n), "old") for n in range(300))), path, buckets=16)
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "index").glob("bucket=*/*.parquet")}
    before = files()
    for n in range(5):
        keyed.write_documents(documents(("i", "7", f"new{n}"), ("i", "8", f"new{n}")), path)
    after = files()
    assert len(after) == len(before) == 16                                   # however many batches there were
    assert sum(f not in before for f in after) <= 2
    monkeypatch.setattr(buckets, "materialise", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        keyed.write_documents(documents(("i", "9", "lost")), path)
    got = {r._id: r._source for r in keyed.current_documents(spark, path).collect()}
    assert len(got) == 300 and (got["7"], got["8"], got["9"]) == ("new4", "new4", "old")


def test_documents_are_handed_to_a_connector(spark, tmp_path):
    documents = spark.createDataFrame([("i", "1", '{"a":1}')], "_index string, _id string, _source string")
    for _ in range(2):
        keyed.export_documents(documents, "json", path=str(tmp_path / "out"))
    got = spark.read.json(str(tmp_path / "out")).collect()
    assert [(r._index, r._id, r._source) for r in got] == [("i", "1", '{"a":1}')] * 2


def test_whole_batch_job(spark, feed, tmp_path):
    base = str(tmp_path)
    bad = jobs.ingest(spark, str(feed), f"{base}/store")
    assert bad.count() == 2
    jobs.ingest(spark, str(feed), f"{base}/store")              # nothing new
    jobs.ingest(spark, str(feed), f"{base}/store", retry_of=0)  # the same again
    run = "ejecucion_20250601_100000"
    jobs.clean(spark, f"{base}/store", f"{base}/clean", run)
    alerts = {r.uuid: r for r in tables.read_latest(spark, f"{base}/clean/alertas_limpias").collect()}
    assert len(alerts) == 3 and alerts["a"].street == "Av. A, B" and alerts["a"].city == "Peñaflor;Malloco"
    assert alerts["b"].confidence == 0.0 and any(u.startswith("item_") for u in alerts)
    steps = {r.step: r.rows for r in tables.read_latest(spark, f"{base}/clean/metricas").collect()}
    assert steps == {"alertas_total": 3, "alertas_limpias": 3, "atascos_total": 2, "atascos_limpias": 2}
    results = jobs.rank(spark, f"{base}/clean", f"{base}/results", run)
    assert [tuple(r) for r in results["horas_pico"].collect()] == [("07", 3)]
    assert [r.uuid for r in results["atascos_largos"].orderBy(*jobs.result_order("atascos_largos")).collect()] == ["2", "1"]
    jobs.export_results(results, f"{base}/csv", run)
    assert sorted(p.name for p in (tmp_path / "csv").iterdir()) == sorted(results)
    jams = next((tmp_path / f"csv/atascos_largos/{run}").glob("part-*.csv")).read_text().splitlines()
    assert jams[0].startswith("uuid,severity,country") and [line[0] for line in jams[1:]] == ["2", "1"]
    jobs.index_results(results, f"{base}/index", "2025-06-01T10:00:00")
    indexed = keyed.current_documents(spark, f"{base}/index").collect()
    jam = json.loads(next(d._source for d in indexed if d._id == "atascos_largos_0"))
    assert (jam["uuid"], jam["archivo_origen"], jam["fila_numero"]) == ("2", "atascos_largos", 1)


def test_a_second_feed_leaves_the_first_in_place(spark, tmp_path):
    store = str(tmp_path / "store")
    for name in ("a", "b"):
        put(tmp_path / name, "f.json", {"celdas": [cell([an_alert(name)], [])]})
        jobs.ingest(spark, str(tmp_path / name), store)
    assert sorted(r.uuid for r in keyed.read_inserted(spark, f"{store}/alertas").collect()) == ["a", "b"]
    jobs.ingest(spark, str(tmp_path / "b"), store, retry_of=1)
    assert sorted(r.uuid for r in keyed.read_inserted(spark, f"{store}/alertas").collect()) == ["a", "b"]
    assert keyed.next_batch(spark, f"{store}/alertas") == 2


def test_position_of_the_one_document_without_a_key(spark):
    rows = [(f"u{i}" if i != 5 else None, f"f{i // 4}", i % 4, 0) for i in range(12)]
    numbered = jobs.with_position(spark.createDataFrame(rows, "uuid string, file string, cell int, pos int"))
    assert numbered.filter("uuid is null").first().position == 5
    assert "rangepartitioning" not in numbered._jdf.queryExecution().executedPlan().toString()


def test_bucketed_table_is_not_shuffled_again(spark):
    spark.sql("drop table if exists keyed_rows")
    writers.write_bucketed(spark.range(100).select(F.col("id").cast("string").alias("uuid")), "keyed_rows", "uuid", 4)
    try:
        joined = spark.table("keyed_rows").hint("merge").join(spark.table("keyed_rows"), "uuid")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and joined.count() == 100
    finally:
        spark.sql("drop table keyed_rows")


def test_intermediate_tables_can_be_cleared(spark):
    kept = materialise(spark.range(5))
    drop_table(kept)
    other = materialise(spark.range(7))
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        kept.collect()
    assert other.count() == 7
    drop_materialised(spark)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        other.collect()


# -- streams --------------------------------------------------------------------------------

def test_streamed_ingest_equals_one_batch(spark, feed, tmp_path):
    base, watched = str(tmp_path), tmp_path / "watched"

    def sweep():
        ingest_feed(spark, str(watched), f"{base}/alerts", f"{base}/jams", f"{base}/bad", f"{base}/ckpt").awaitTermination()

    put(watched, "f1.json", (feed / "f1.json").read_text(encoding="utf-8"))
    sweep()
    for name in ("f2.json", "f4.json"):
        put(watched, name, (feed / name).read_text(encoding="utf-8"))
    sweep()
    sweep()
    bad = spark.read.parquet(f"{base}/bad").select("file_name", "reason").collect()
    assert [tuple(r) for r in bad] == [("f4.json", "malformed")]
    alerts = keyed.read_inserted(spark, f"{base}/alerts").collect()
    assert sorted(str(r.uuid) for r in alerts) == ["None", "a", "b"]
    assert next(r.street for r in alerts if r.uuid == "a") == "Av. A, B"
    assert sorted(r.uuid for r in keyed.read_inserted(spark, f"{base}/jams").collect()) == [1, 2]


def test_refresh_overwrites_by_id(spark, tmp_path):
    base, schema = str(tmp_path), "uuid string, v int"
    data = spark.createDataFrame([], schema).schema

    def refresh():
        refresh_index(spark, f"{base}/rows", data, "alertas", f"{base}/index", f"{base}/ckpt", every_seconds=None).awaitTermination()

    spark.createDataFrame([("a", 1), ("b", 1)], schema).write.parquet(f"{base}/rows")
    refresh()
    spark.createDataFrame([("a", 2)], schema).write.mode("append").parquet(f"{base}/rows")
    refresh()
    got = {r._id: json.loads(r._source)["v"] for r in keyed.current_documents(spark, f"{base}/index").collect()}
    assert got == {"a": 2, "b": 1}


def test_refreshed_results_equal_a_full_rebuild(spark, tmp_path, monkeypatch):
    """Three triggers with new rows and one with none; the object without a key moves as others come before it."""
    base, stamp = str(tmp_path), "2025-06-01T10:00:00"
    loads = [("m", [an_alert("a"), an_alert("b", type="JAM"), an_alert("s1", type="false"), an_alert(..., type="false")],
              [a_jam(1), a_jam(2, length=50), a_jam(3, city="renca")]),
             ("z", [an_alert("a", type="JAM"), an_alert("c", street="Otra"), an_alert("d", fecha="2025-06-01 09:00:00"),
                    an_alert("e", city="")], [a_jam(4, length=None), a_jam(5, length=70)]),
             ("c", [an_alert("s0", type="false"), an_alert("f"), an_alert("g", street="Otra")], [a_jam(6, city="renca", length=1)])]
    written = []
    whole = refresh.write_documents
    monkeypatch.setattr(refresh, "write_documents", lambda df, *more: (written.append(df.count()), whole(df, *more)))

    def sweep():
        refresh_results_on_stream(spark, f"{base}/store", f"{base}/state", f"{base}/index", f"{base}/ckpt",
                                  every_seconds=None, now=lambda: stamp).awaitTermination()

    def rebuilt():
        run = "ejecucion_20250601_100000"
        jobs.clean(spark, f"{base}/store", f"{base}/clean", run)
        results = jobs.rank(spark, f"{base}/clean", f"{base}/results", run)
        return documents.numbered_documents(results, RESULT_ORDER, stamp).collect()

    for name, alerts, jams in loads:
        put(tmp_path / name, f"{name}.json", {"celdas": [cell(alerts, jams)]})
        jobs.ingest(spark, f"{base}/{name}", f"{base}/store")
        sweep()
        indexed = keyed.current_documents(spark, f"{base}/index").collect()
        assert sorted(map(tuple, indexed)) == sorted(map(tuple, rebuilt()))
    sweep()
    assert len({r._index for r in indexed}) == 9
    assert len(written) == 3 and written[1] < len(indexed) and written[2] < len(indexed)


def test_a_refresh_writes_documents_without_another_copy(spark, tmp_path, monkeypatch):
    """Unchanged documents stay as they are, all others are the new ones; a batch written again changes nothing."""
    path, ids = str(tmp_path / "index"), "_index string, _id string"
    rows = lambda text, *numbers: spark.createDataFrame(
        [("i", f"d_{n}", f'{{"n":{n},"x":"{text}"}}') for n in numbers], keyed.DOCUMENT)
    keyed.write_documents(rows("old", *range(40)), path, 0, 4)
    same = spark.createDataFrame([("i", f"d_{n}") for n in range(0, 40, 3)], ids)
    copies = []
    monkeypatch.setattr(buckets, "materialise", lambda df, *more: copies.append(df))
    want = {(f"d_{n}", "new" if n % 3 or n >= 40 else "old") for n in range(50)}
    for _ in range(2):
        keyed.write_documents(rows("new", *(n for n in range(50) if n % 3 or n >= 40)), path, 1, 4, same)
        got = [(r._id, json.loads(r._source)["x"]) for r in keyed.current_documents(spark, path).collect()]
        assert set(got) == want and len(got) == 50
    assert not copies


def test_rows_of_a_batch_are_added_without_reading_those_there(spark, tmp_path):
    path = str(tmp_path / "rows")
    add = lambda batch, *keys: incremental.add_rows(spark.createDataFrame(
        [(k, "c", "s", "f") for k in keys], "uuid string, city string, street string, fecha string"), path, batch)
    add(0, "a", "b")
    before = sorted((tmp_path / "rows" / "batch_id=0").iterdir())
    add(1, "c", None)
    add(1, "c", None)
    assert sorted((tmp_path / "rows" / "batch_id=0").iterdir()) == before
    found = keyed.finished_batches(spark, path, struct(uuid=T.StringType(), city=T.StringType()))
    assert sorted((r.uuid or "") for r in found.collect()) == ["", "a", "b", "c"]
    assert keyed.finished_batches(spark, path + "x", found.schema).count() == 0


def test_jams_are_staged_once_a_refresh(spark, tmp_path, monkeypatch):
    """Sums by city are taken from the rows as written, also when a batch is merged again."""
    state, sums = str(tmp_path / "state"), {}
    whole = incremental.add_sums
    monkeypatch.setattr(incremental, "add_sums", lambda df, path, *more: (
        sums.update({path.rsplit("/", 1)[1]: df.inputFiles()}), whole(df, path, *more)))
    alerts, schemas = (spark.createDataFrame([], T.StructType([*refresh._PLACE, *refresh.ALERT_DOCUMENT.fields])), refresh.JAM_DOCUMENT)
    row = lambda n, city, length: (n, 1, "CL", length, "x", 1, 1.0, 1.0, "s", "2025-06-01 10:00:00", "r", city)
    for batch, jams in ((0, [row(1, "renca", 5), row(2, "ñuñoa", 7), row(3, "renca", None)]), (1, [row(4, "renca", 2)]),
                        (1, [row(4, "renca", 2)])):
        incremental.merge_documents(alerts, spark.createDataFrame(jams, schemas).withColumns(
            {"file": F.lit("f"), "cell": F.lit(0), "pos": F.lit(0)}), state, batch)
        assert sums["ciudades_atascos"] and all(f"atascos_limpios/batch_id={batch}/" in f for f in sums["ciudades_atascos"])
    got = sorted(map(tuple, incremental.stored_sums(spark, f"{state}/ciudades_atascos", *incremental.CITIES[1:]).collect()))
    assert got == [("Renca", 7, 2), ("Ñuñoa", 7, 1)]


def test_a_batch_merged_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "sums")
    add = lambda batch, *r: incremental.add_sums(
        spark.createDataFrame(r, "ciudad string, largo_total long, num_atascos long"), path, *incremental.CITIES[1:], batch)
    add(0, ("a", 10, 1), (None, 5, 1))
    for _ in range(3):
        add(1, ("a", 7, 2), ("b", 1, 1), (None, 1, 1))
    got = sorted(map(tuple, incremental.stored_sums(spark, path, *incremental.CITIES[1:]).collect()), key=str)
    assert got == [("a", 17, 3), ("b", 1, 1), (None, 6, 2)]


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(key)


def fill_sweep(spark, base, rows, ttl, delay):
    """Feeds a batch of events and returns (fills so far, rows of state)."""
    schema = "k string, t long"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    query = (fills_on_stream(spark.readStream.schema(schema).parquet(f"{base}/in"), "k", "t", ttl, delay)
             .writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    fills = sorted(map(tuple, spark.read.schema(schema).parquet(f"{base}/out").collect()))
    return fills, query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_ttl_on_a_stream(spark, tmp_path, rocksdb):
    base = str(tmp_path)
    sweep = lambda *rows: fill_sweep(spark, base, rows, 300, "0 seconds")
    assert sweep(("k", 1000), ("k", 1100), ("k", 1100), ("m", 1005), ("k", None))[0] == [("k", 1000), ("m", 1005)]
    assert sweep(("k", 1299), ("k", 1300), ("k", 1500))[0] == [("k", 1000), ("k", 1300), ("m", 1005)]
    # 1305 of m is behind the watermark (1500): too late. 1601 of k is a fill.
    assert sweep(("k", 1601), ("m", 1305))[0] == [("k", 1000), ("k", 1300), ("k", 1601), ("m", 1005)]


def test_ttl_on_a_stream_equals_the_batch_in_any_order(spark, tmp_path, rocksdb):
    """Events in any order within the delay, and state that goes once the watermark has passed."""
    rng, ttl, sweeps = random.Random(4), 40, 4
    events = [(f"k{rng.randrange(30)}", 1000 + 100 * n + rng.randrange(100)) for n in range(sweeps) for _ in range(150)]
    for n in range(sweeps):
        part = events[150 * n:150 * (n + 1)]
        rng.shuffle(part)
        fills, held = fill_sweep(spark, str(tmp_path), part, ttl, "100 seconds")
        assert held > 0
    fills, held = fill_sweep(spark, str(tmp_path), [("end", 9000)], ttl, "100 seconds")
    df = spark.createDataFrame(events, "k string, t long")
    assert fills == sorted(map(tuple, fill_moments(df, ["k"], "t", ttl).collect()))
    assert held == 1        # the last event, which still waits


def test_bounded_state_deduplication(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([("a", "2025-01-01 00:00:00"), ("a", "2025-01-01 00:01:00"), ("b", "2025-01-01 00:00:30")],
                                 "uuid string, fecha string").withColumn("fecha_ts", F.to_timestamp("fecha"))
    rows.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    query = (unseen_within(stream, "1 hour").writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.uuid for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b"]
