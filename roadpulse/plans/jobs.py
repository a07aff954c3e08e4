"""The batch jobs: ingest feed files, clean them, compute the result tables, index them.

Each job ends in a written table and the next one starts by reading it. That is the one place
where rows are materialised: a lost executor costs the tasks it ran, not the whole chain.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.operators.documents import numbered_documents
from roadpulse.operators.lookup import request_summary
from roadpulse.operators.quality import clean_alerts, clean_jams
from roadpulse.operators.rollups import alert_cube, result_tables
from roadpulse.operators.staging import FIRST_WRITE, stage_alerts, stage_jams, with_position
from roadpulse.schemas import RESULT_ORDER
from roadpulse.session import drop_table, materialise, side_by_side
from roadpulse.sinks.keyed import BATCH, insert_if_absent, next_batch, read_inserted, write_batch, write_documents
from roadpulse.sinks.writers import counted, write_csv, write_json, write_metrics, write_run
from roadpulse.sources.feeds import (
    good_documents, quarantined_documents, read_feed, unnest_alerts, unnest_jams,
)
from roadpulse.sources.tables import read_latest

def result_order(name: str) -> list:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in RESULT_ORDER[name]]


def ingest(spark: SparkSession, feed: str, store: str, retry_of: int | None = None) -> DataFrame:
    """Add unseen alerts and jams of the feed files to the store; returns the unusable files.

    The JSON is parsed once: alerts, jams and the quarantine all read the written documents.
    Each call adds a batch. `retry_of` replaces one, for the same feed; running a feed that failed
    half way once more needs no such number, as what is stored already is not added again.
    """
    paths = [f"{store}/{name}" for name in ("alertas", "atascos", "cuarentena")]
    batch = next_batch(spark, *paths) if retry_of is None else retry_of
    documents = materialise(read_feed(spark, feed))
    good = good_documents(documents)
    insert_if_absent(unnest_alerts(good), paths[0], ["uuid"], list(FIRST_WRITE), batch)
    insert_if_absent(unnest_jams(good), paths[1], ["uuid"], list(FIRST_WRITE), batch)
    write_batch(quarantined_documents(documents), paths[2], batch)
    drop_table(documents)
    return spark.read.parquet(f"{paths[2]}/{BATCH}={batch}")


def clean(spark: SparkSession, store: str, out: str, run: str) -> None:
    """Stage and clean the stored documents into run-stamped tables, with row counts."""
    kinds = {"alertas": (stage_alerts, clean_alerts), "atascos": (stage_jams, clean_jams)}
    seen = {}

    def clean_kind(kind: str) -> None:
        stage, keep = kinds[kind]
        staged = stage(with_position(read_inserted(spark, f"{store}/{kind}")), "position", FIRST_WRITE)
        write_run(staged, f"{out}/{kind}_preparadas", run)
        prepared = spark.read.parquet(f"{out}/{kind}_preparadas/run_id={run}")
        prepared, seen[f"{kind}_total"] = counted(prepared, f"{kind}_total")
        kept, seen[f"{kind}_limpias"] = counted(keep(prepared, FIRST_WRITE), f"{kind}_limpias")
        write_run(kept, f"{out}/{kind}_limpias", run)

    side_by_side([partial(clean_kind, kind) for kind in kinds])
    write_metrics(spark, seen, f"{out}/metricas", run)


def rank(spark: SparkSession, cleaned: str, out: str, run: str) -> dict[str, DataFrame]:
    """The nine result tables of the latest clean run, each written under its own name."""
    alerts = read_latest(spark, f"{cleaned}/alertas_limpias")
    jams = read_latest(spark, f"{cleaned}/atascos_limpias")
    raw = read_latest(spark, f"{cleaned}/alertas_preparadas")
    write_run(alert_cube(alerts), f"{out}/cubo_alertas", run)
    cube = spark.read.parquet(f"{out}/cubo_alertas/run_id={run}")
    results = result_tables(alerts, jams, raw, cube)
    side_by_side([partial(write_run, df, f"{out}/{name}", run) for name, df in results.items()])
    return {name: spark.read.parquet(f"{out}/{name}/run_id={run}") for name in results}


def export_results(results: dict[str, DataFrame], out: str, run: str) -> None:
    """Each result table as a folder of CSV files with its header, in its ranking's order."""
    side_by_side([partial(write_csv, df.orderBy(*result_order(name)), f"{out}/{name}/{run}")
                   for name, df in results.items()])


def summarise_requests(log: DataFrame, keys: DataFrame, out: str, run: str) -> None:
    """The summary of a request log, whole and by tag, and the list of known keys, as JSON."""
    whole = request_summary(log.withColumn("tipo", F.lit("todos")), ("tipo",))
    write_json(whole.unionByName(request_summary(log, ("tipo",))), f"{out}/resumen/{run}")
    write_json(keys, f"{out}/claves/{run}")


def index_results(
    results: dict[str, DataFrame], store: str, processed_at: str, retry_of: int | None = None,
) -> None:
    """Result rows as documents with lineage into the index store, as a new batch or for one of old."""
    write_documents(numbered_documents(results, RESULT_ORDER, processed_at), store, retry_of)
