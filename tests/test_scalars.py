import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymetrics.functions import rows as R
from daymetrics.functions import scalars as S


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_day_zero(spark):
    assert one(spark, S.epoch_day_to_iso(F.lit(0))) == "1970-01-01"


def test_day_is_text(spark):
    assert isinstance(one(spark, S.epoch_day_to_iso(F.lit(19000))), str)


def test_day_format(spark):
    text = one(spark, S.epoch_day_to_iso(F.lit(20000)))
    assert len(text) == 10
    assert len(text.split("-")) == 3


def test_consecutive_days(spark):
    a, b = (one(spark, S.epoch_day(F.lit(n))) for n in (20000, 20001))
    assert (b - a).days == 1


@pytest.mark.parametrize(
    "n, day", [(-1, "1969-12-31"), (19000.9, "2022-01-08"), (-719162, "0001-01-01"), (None, None)]
)
def test_day_edges(spark, n, day):
    assert one(spark, S.epoch_day_to_iso(F.lit(n).cast("double"))) == day


def test_weekday_names(spark):
    days = spark.range(7).select(S.weekday_name(S.epoch_day(F.col("id") + 4)).alias("n"))  # a Monday
    assert [r["n"] for r in days.collect()] == [
        "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo",
    ]


def many_doubles():
    rng = random.Random(7)
    values = [rng.uniform(-1e4, 1e4) for _ in range(3000)]
    values += [k / 1000 for k in range(-4000, 4000)]  # decimal ties at two digits
    values += [k / 20 for k in range(-4000, 4000)]  # decimal ties at one digit
    values += [k / 8 for k in range(-400, 400)]  # ties in binary, too
    values += [0.0, 7.35, 2.675, 0.15, 0.25, 0.35, 1e12 + 0.05, 123456789.25]
    return values


def test_round_exact_is_the_rounding_of_the_stored_value(spark):
    values = many_doubles()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", *[S.round_exact(F.col("x"), n).alias(f"r{n}") for n in (0, 1, 2)])
    for r in got.collect():
        for n in (0, 1, 2):
            assert r[f"r{n}"] == round(r["x"], n), (r["x"], n)


def test_round_half_even_is_the_array_rounding(spark):
    values = many_doubles()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", *[S.round_half_even(F.col("x"), n).alias(f"r{n}") for n in (1, 2, 3)])
    for r in got.collect():
        for n in (1, 2, 3):
            assert r[f"r{n}"] == np.round(r["x"], n), (r["x"], n)


def test_round_half_away(spark):
    def expected(x, n):
        scaled = abs(x * 10.0**n)
        whole = math.floor(scaled)
        whole += scaled - whole >= 0.5
        return math.copysign(whole / 10.0**n, x)

    df = spark.createDataFrame([(v,) for v in many_doubles()], "x double")
    got = df.select("x", *[S.round_half_away(F.col("x"), n).alias(f"r{n}") for n in (1, 2)])
    for r in got.collect():
        for n in (1, 2):
            assert r[f"r{n}"] == expected(r["x"], n), (r["x"], n)


def test_rounding_keeps_null(spark):
    null = F.lit(None).cast("double")
    for rounding in (S.round_exact, S.round_half_even, S.round_half_away):
        assert one(spark, rounding(null, 1)) is None
    assert one(spark, S.to_int(null)) is None


@pytest.mark.parametrize("x, n", [(2.5, 2), (3.5, 4), (-2.5, -2), (7.4, 7)])
def test_to_int_rounds_half_to_even(spark, x, n):
    assert one(spark, S.to_int(F.lit(x))) == n


@pytest.mark.parametrize("x, y", [(-0.2, 0.0), (0.4, 0.4), (1.3, 1.0), (None, None)])
def test_clip(spark, x, y):
    assert one(spark, S.clip01(F.lit(x).cast("double"))) == y


@pytest.mark.parametrize(
    "hours, awake, share", [(8.0, 24.0, 0.95), (1.0, 90.0, 0.0), (8.0, -10.0, 1.0), (8.0, None, None), (0.0, 0.0, None)]
)
def test_sleep_efficiency(spark, hours, awake, share):
    got = one(spark, S.sleep_efficiency(F.lit(hours), F.lit(awake).cast("double")))
    assert got == share


@pytest.mark.parametrize(
    "code, label", [(45, "Fuerza"), (53, "Running"), (58, "Senderismo"), (5, "Otro"), (99, "Otro"), (None, "Otro")]
)
def test_exercise_label(spark, code, label):
    assert one(spark, S.exercise_label(F.lit(code).cast("int"))) == label
    assert one(spark, S.exercise_label(F.lit(code).cast("int"), {})) == "Otro"


def test_repeat_rows_over_a_block_border(spark):
    counts = [1, 2, 1023, 1024, 1025, 65537, 200000]
    df = spark.createDataFrame([(n, n) for n in counts], "id int, copies long")
    got = {r["id"]: r["count"] for r in R.repeat_rows(df, "copies", ["id"]).groupBy("id").count().collect()}
    assert got == {n: n for n in counts}
