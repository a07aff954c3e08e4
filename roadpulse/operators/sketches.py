"""Sketches per run, small enough to keep and merge for good, in place of reading old runs again.

Latencies keep a KLL quantile sketch for each run and outcome: sketches of any runs merge into one
whose quantiles have the same rank error as if all latencies had gone into it. Keys keep theta
sketches, sets of the smallest hashes, which can be united and intersected: how many keys two runs share
is answered from two rows. A set is held exactly until it has 2^`lg` keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadpulse.operators.duplicates import _per_key

#: Size of a quantile sketch, and its rank error (two-sided, 99 times of 100).
KLL_SIZE, KLL_RANK_ERROR = 800, 0.005
#: Nominal entries of a theta sketch as a power of two; beyond them the standard error is 2^(-lg / 2).
THETA_LG = 14


# -- latencies ------------------------------------------------------------------------------

def latency_sketches(log: DataFrame, run: str = "run") -> DataFrame:
    """(run, resultado, n, sketch): one small row for each run and outcome. Rows without a latency don't count."""
    return (
        log.filter(F.col("tiempo_ms").isNotNull()).groupBy(run, "resultado")
        .agg(F.count("*").alias("n"), F.kll_sketch_agg_double("tiempo_ms", KLL_SIZE).alias("sketch"))
    )


def merged_percentiles(sketches: DataFrame, at: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """Percentiles by outcome over all runs whose sketches are given, within `KLL_RANK_ERROR` in rank."""
    merged = sketches.groupBy("resultado").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"))
    return merged.select("resultado", "n", *(
        F.kll_sketch_get_quantile_double("sketch", F.lit(q / 100)).alias(f"p{q}") for q in at))


def latency_rank(sketches: DataFrame, limit: float) -> DataFrame:
    """The share of latencies up to `limit` for each run and outcome: a service level, over time."""
    return sketches.withColumn("share", F.kll_sketch_get_rank_double("sketch", F.lit(limit))).drop("sketch")


# -- keys -----------------------------------------------------------------------------------

SETS = ("distinct", "repeated", "alerts", "jams")


def key_sketches(items: DataFrame, run: str = "run", lg: int = THETA_LG) -> DataFrame:
    """(run, objects, and a sketch for each of `SETS`) of items (`uuid`, `kind`) that name their run.

    Keys are counted within their run first, so a hot key is one row by the time it is hashed.
    """
    seen = _per_key(items.filter(F.col("uuid").isNotNull()), [run, "uuid"])
    wanted = {"distinct": F.lit(True), "repeated": F.col("n") > 1, "alerts": F.col("alerts") > 0, "jams": F.col("jams") > 0}
    return seen.groupBy(run).agg(F.sum("n").alias("objects"), *(
        F.theta_sketch_agg(F.when(test, F.col("uuid")), lg).alias(name) for name, test in wanted.items()))


def _size(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def key_summary(sketches: DataFrame, run: str = "run") -> DataFrame:
    """Per run: objects, distinct and repeated keys, those of both kinds, and those the run before had too."""
    before = F.lag("distinct").over(Window.orderBy(run))        # a row a run, however large
    kept = F.when(before.isNotNull(), _size(F.theta_intersection("distinct", "before"))).otherwise(F.lit(0))
    return sketches.withColumn("before", before).select(
        run, "objects", _size(F.col("distinct")).alias("distinct_keys"), _size(F.col("repeated")).alias("repeated_keys"),
        _size(F.theta_intersection("alerts", "jams")).alias("mixed_keys"), kept.alias("kept_keys"))


def overlap(sketches: DataFrame, one, other, run: str = "run") -> DataFrame:
    """Two runs side by side: keys of both, of either, and of the one alone."""
    sides = [sketches.filter(F.col(run) == name).agg(F.theta_union_agg("distinct").alias(side))
             for name, side in ((one, "a"), (other, "b"))]
    return sides[0].join(sides[1], F.lit(True)).select(     # one row each
        _size(F.theta_intersection("a", "b")).alias("shared_keys"), _size(F.theta_union("a", "b")).alias("all_keys"),
        _size(F.theta_difference("a", "b")).alias("lost_keys"))


def all_runs(sketches: DataFrame) -> DataFrame:
    """Distinct and mixed keys over all runs together."""
    united = sketches.agg(F.sum("objects").alias("objects"), *(
        F.theta_union_agg(name).alias(name) for name in ("distinct", "alerts", "jams")))
    return united.select("objects", _size(F.col("distinct")).alias("distinct_keys"),
                         _size(F.theta_intersection("alerts", "jams")).alias("mixed_keys"))
