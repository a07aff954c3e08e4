"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, types as T

# ASCII letters only: the contracts leave all other letters as they are.
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})

BATCH_ROWS = 1000
#: Characters of input whose results are gathered before they are handed on (a longer row is handed on alone).
SLICE_CHARS = 4_000_000


def text_of(value: object) -> str:
    """A null text (None, or NaN as pandas may have it) counts as empty."""
    return value if isinstance(value, str) else ""


def small_batches(docs: DataFrame) -> DataFrame:
    """`docs`, in a session whose Arrow batches hold `BATCH_ROWS` rows at most.

    Spark counts the rows of a batch, not their bytes: at its default of 10,000 a batch of long texts, with
    what Python makes of them, would be the largest thing in an executor's memory.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs


def slices_of(batch: pd.DataFrame, inputs: list[str], most: int | None = None) -> Iterator[pd.DataFrame]:
    """The rows of a batch in order, cut where another `most` (`SLICE_CHARS`) characters of input are full."""
    chars = sum(batch[c].map(lambda v: len(text_of(v))).astype("int64") for c in inputs)
    return (rows for _, rows in batch.groupby(chars.cumsum() // (most or SLICE_CHARS), sort=False))


def map_slices(
    docs: DataFrame, columns: list[str], inputs: list[str], fields: str,
    function: Callable[[pd.DataFrame], list[tuple]], most: int | None = None,
) -> DataFrame:
    """`columns` of `docs`, then `fields`, of which `function` gives a row for each row of a slice of `inputs`.

    One pass without a shuffle. Rows travel in Arrow batches; only `columns` and `inputs` are read,
    so an input column named like one of `fields` doesn't clash unless it is asked for.
    """
    added = T.StructType.fromDDL(fields).fields
    names = [f.name for f in added]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices_of(batch, inputs, most):
                out = pd.DataFrame(function(part[inputs]), columns=names, dtype=object, index=part.index)
                yield pd.concat([part[columns], out], axis=1)

    schema = T.StructType([docs.schema[c] for c in columns] + added)
    return small_batches(docs).select(*dict.fromkeys([*columns, *inputs])).mapInPandas(run, schema)


def map_rows(
    docs: DataFrame, columns: list[str], inputs: list[str], fields: str, function: Callable[..., tuple]
) -> DataFrame:
    """`map_slices`, where `function(*inputs)` gives the fields of one row."""
    return map_slices(docs, columns, inputs, fields,
                      lambda part: [function(*values) for values in zip(*(part[c] for c in inputs))])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it from clashing with a column of `df`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out
