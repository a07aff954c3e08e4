import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roadpulse.functions import draws as D
from roadpulse.functions import text, values as v


def column(spark, data, kind, expression):
    rows = [(i, x) for i, x in enumerate(data)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.o for r in df.select("i", expression(F.col("x")).alias("o")).orderBy("i").collect()]


def by_python(city):
    if not city:
        return city
    return ";".join(part.strip().title() for part in city.replace(",", ";").split(";"))


CITIES = ["peñaflor, malloco", "o'higgins", "aguirre-cerda", "  SAN bernardo\t", "ñuñoa", "x2y",
          "álamo 3a,b", "", None, "a,,b", " , a", "a  b ,  c", "ÁLAMO 3 B;c", "a ,b ; c,", " ",
          " ; ", "san\tjuan", "x  y", "comuna 12, sector 2", " lo  espejo  ", "3 poniente"]


def test_normalize_city(spark):
    assert column(spark, CITIES, "string", text.normalize_city) == [by_python(c) for c in CITIES]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet=" ,;'-.\táñÑéabzABZ0129", max_size=14), min_size=200, max_size=200))
def test_normalize_city_random(spark, names):
    assert column(spark, names, "string", text.normalize_city) == [by_python(c) for c in names]


def test_normalize_city_is_compiled_with_its_step(spark):
    """A function over an array would leave the whole step to row-by-row evaluation."""
    df = spark.range(1).select(text.normalize_city(F.col("id").cast("string")).alias("city")).filter("city <> ''")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan and "lambda" not in plan
    odd = ["a\ufdd0 b-c", "x\ufdd00y", "\ufdd0", "a\ufdd0  \ufdd0 1b", "- a-b ,\u2003c-d\t;e'f"]
    assert column(spark, odd, "string", text.normalize_city) == [by_python(c) for c in odd]


def test_text_helpers(spark):
    assert column(spark, ["a", "", None], "string", text.filled) == [True, False, False]
    assert column(spark, ["12", "1a", "-1", "", None], "string", text.is_digits) == [
        True, False, False, False, False]
    names = ["ejecucion_20240101_101010", "ejecucion_2024_1", "x_ejecucion_20240101_101010", None]
    assert column(spark, names, "string", text.is_run_name) == [True, False, False, False]
    paths = ["/a/b/Horas_Pico.csv", "x.tar.gz", "plain"]
    assert column(spark, paths, "string", text.file_stem) == ["horas_pico", "x.tar", "plain"]


def test_hours(spark):
    fechas = ["2025-06-01 07:30:00", "short", "2025-06-01 0", "2025-06-01 ", None]
    assert column(spark, fechas, "string", v.hour_of_day) == ["07", None, "0", "", None]
    assert column(spark, ["07", "x", None], "string", v.hour_number) == [7, -1, -1]
    assert column(spark, ["07", None], "string", v.hour_label) == ["07", "Sin hora"]


def test_epoch_seconds_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        # 00:30 on 2024-09-08 does not exist in that zone
        got = column(spark, ["2024-09-08 00:30:00", "bad"], "string", v.epoch_seconds)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [1725755400, None]


def test_shares_and_indexes(spark):
    assert column(spark, [0, 4], "int", lambda x: v.share_percent(F.lit(1), x)) == [0.0, 25.0]
    assert column(spark, [0, 4], "int", lambda x: v.mean_or_zero(F.lit(2.0), x)) == [0.0, 0.5]
    assert column(spark, [0.00123456], "double", v.seconds_to_ms) == [1.23]
    half_even = [-3.0, 0.5, 1.5, 2.5, 99.0]
    assert column(spark, half_even, "double", lambda x: v.nearest_index(x, F.lit(10))) == [0, 0, 2, 2, 9]


def test_uniform_and_exponential(spark):
    draws = spark.range(20000)
    row = draws.select(D.uniform("s", F.col("id")).alias("u"), D.exponential("s", F.col("id"), 0.5).alias("e")).agg(
        F.min("u"), F.max("u"), F.avg("u"), F.avg("e")).first()
    assert 0 < row[0] and row[1] < 1 and row[2] == pytest.approx(0.5, abs=0.02)
    assert row[3] == pytest.approx(2.0, abs=0.06)


def test_normal(spark):
    row = spark.range(20000).select(D.normal("n", F.col("id"), F.lit(10.0), F.lit(3.0)).alias("x")).agg(
        F.avg("x"), F.stddev("x")).first()
    assert row[0] == pytest.approx(10, abs=0.1) and row[1] == pytest.approx(3, abs=0.1)


def test_zipf_frequencies(spark):
    got = Counter(r.x for r in spark.range(20000).select(D.zipf("z", F.col("id"), 2.0).alias("x")).collect())
    assert None not in got
    zeta = math.pi**2 / 6
    for x in (1, 2, 3):
        assert got[x] / 20000 == pytest.approx(1 / (x * x * zeta), abs=0.015)


def test_draws_do_not_depend_on_partitions(spark):
    def run(parts):
        df = spark.range(0, 500, 1, parts)
        return sorted(df.select("id", D.zipf("z", F.col("id"), 1.3), D.uniform("u", F.col("id"))).collect())

    assert run(1) == run(7)
