"""Run a registered query and its SQL side by side and compare whole results."""

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None or isinstance(value, str) else str(value)


def difference(spark_df, con, sql):
    """None when equal, otherwise a short description."""
    columns = sorted(spark_df.columns)
    ours = Counter(tuple(_cell(row[c]) for c in columns) for row in spark_df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(_cell(row[i]) for i in order) for row in result.fetchall())
    if ours == theirs:
        return None
    only, missing = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; columns {columns}; "
            f"only ours {list(only)[:3]}; only theirs {list(missing)[:3]}")
