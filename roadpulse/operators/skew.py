"""Equi-join against a table with unique keys that stays even when a few keys are very hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_SALT, _SALTS, _ROWS = "__salt", "__salts", "__rows"


def hot_keys(
    rows: DataFrame, keys: list[str], share: float, counts: DataFrame | None = None, n: str = _ROWS,
) -> DataFrame:
    """Keys holding more than `share` of all rows, with the number of salts each one needs.

    `counts` are the rows per key in column `n`, if the caller has them already. Null keys are
    left out: they match nothing.

    At most 1/share keys can qualify and their salts add up to less than 2/share, whatever the
    size of `rows`: that bound is what makes broadcasting the result safe. The counts are
    combined map-side, so a hot key costs one row per task.
    """
    if counts is None:
        counts = rows.filter(_complete(keys)).groupBy(*keys).agg(F.count("*").alias(n))
    limit = F.lit(share) * counts.agg(F.sum(n)).scalar()
    return counts.filter(_complete(keys) & (F.col(n) > limit)).select(
        *keys, F.ceil(F.col(n) / limit).cast("int").alias(_SALTS))


def _complete(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def join_unique(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    share: float = 0.001,
    spread: list[str] | None = None,
    counts: DataFrame | None = None,
    n: str = _ROWS,
) -> DataFrame:
    """`rows.join(table, keys, how)` for a `table` with at most one row per key.

    Rows of a hot key are spread over salts by a hash of the `spread` columns (all columns by
    default) and the one matching table row is copied once per salt. All other keys keep
    salt 0 and are not copied. A null key matches nothing: such rows go before an inner join,
    and otherwise are dealt evenly by their salt alone. `how` is `left`, `inner` or `left_semi`;
    `counts` and `n` as in `hot_keys`.
    """
    if how != "left":
        rows = rows.filter(_complete(keys))
    hot = F.broadcast(hot_keys(rows, keys, share, counts, n))
    # xxhash64 over whole rows: two identical rows share a salt, distinct rows of a key do not.
    digest = F.xxhash64(*(spread or rows.columns))
    salted_rows = (
        rows.join(hot, keys, "left")
        .withColumn(_SALT, F.when(~_complete(keys), F.pmod(digest, F.lit(1 << 30)).cast("int"))
                    .when(F.col(_SALTS).isNull(), F.lit(0))
                    .otherwise(F.pmod(digest, F.col(_SALTS)).cast("int")))
        .drop(_SALTS)
    )
    salted_table = (
        table.join(hot, keys, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    joined = salted_rows.join(salted_table, [*keys, _SALT], how).drop(_SALT)
    rest = [c for c in table.columns if c not in keys] if how != "left_semi" else []
    return joined.select(*rows.columns, *rest)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition under which null equals null. It still plans as a hash or merge join."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))
