"""Skewed samples with replacement from a list of keys, and random arrival times."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadpulse.functions import draws as D
from roadpulse.functions.values import nearest_index
from roadpulse.operators.numbering import number_rows, running_total
from roadpulse.operators.skew import join_unique
from roadpulse.session import materialise

_INDEX = "indice"


def shuffled_keys(keys: DataFrame, seed: str = "shuffle") -> DataFrame:
    """The key list in a random but repeatable order, with 0-based `indice`."""
    columns = [F.col(c) for c in keys.columns]
    return number_rows(keys, [D.shuffle_key(seed, *columns), *columns], _INDEX)


def listed_keys(keys: DataFrame) -> DataFrame:
    """The key list in its own order (alerts before jams, by uuid), with 0-based `indice`."""
    return number_rows(keys, list(keys.columns), _INDEX)


def sample_normal(listed: DataFrame, draws: DataFrame, draw: str = "draw", seed: str = "normal") -> DataFrame:
    """One key per draw; positions are normal around the middle of the list.

    Mean n/2 and deviation n/3, rounded half to even and clipped to the list.
    """
    n = listed.agg(F.count("*").cast("double")).scalar()
    position = D.normal(seed, F.col(draw), n / 2, n / 3)
    return _pick(listed, draws.withColumn(_INDEX, nearest_index(position, n)), draw)


def sample_zipf(
    listed: DataFrame, draws: DataFrame, draw: str = "draw", a: float = 1.3, seed: str = "zipf",
) -> DataFrame:
    """One key per draw; position x-1 modulo n for a Zipf(a) draw x: the first keys are hot."""
    n = listed.agg(F.count("*")).scalar()
    position = F.pmod(D.zipf(seed, F.col(draw), a) - 1, n)
    return _pick(listed, draws.withColumn(_INDEX, position), draw)


def _pick(listed: DataFrame, placed: DataFrame, draw: str) -> DataFrame:
    # The join reads the positions twice and drawing is dear, so they are written first.
    return join_unique(materialise(placed), listed, [_INDEX], "inner", spread=[draw])


def arrival_times(
    draws: DataFrame, draw: str = "draw", rate: float = 0.5, seed: str = "arrival",
) -> DataFrame:
    """Exponential gaps with mean 1/rate seconds and the arrival times they add up to.

    `draw` is dense from 0; the first arrival does not wait. Whole microseconds, so the sum
    is exact in any order.
    """
    micros = F.rint(D.exponential(seed, F.col(draw), rate) * 1e6).cast("long")
    gaps = draws.withColumn("gap_us", F.when(F.col(draw) == 0, F.lit(0)).otherwise(micros))
    return running_total(gaps, draw, "gap_us", "arrival_us")
