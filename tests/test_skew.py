"""A third of all rows in one user, one day, one session: right results, and no task or group
that holds them all."""

import pytest
from pyspark.sql import functions as F

from daymetrics.operators import gold, silver, weekly
from daymetrics.plans import report

N = 300_000
AS_OF = "2024-03-31"
KEYS = ["user_id"]


@pytest.fixture(scope="module")
def base(spark):
    """A third of the rows on user 0's first day, the rest spread over users and days."""
    hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        F.col("id").alias("row_id"),
        F.when(hot, 0).otherwise(F.col("id") % 1000).cast("long").alias("user_id"),
        F.when(hot, 19723).otherwise(19723 + F.col("id") % 60).cast("long").alias("local_date"),
        F.lit(4).alias("app_info_id"),
    )


@pytest.fixture(scope="module")
def raw(base):
    n = F.col("row_id")
    start = F.col("local_date") * 86_400_000
    return {
        "sleep_session_record_table": base.select("*", start.alias("start_time"), (start + 60_000).alias("end_time")),
        # a third of all stages in one session
        "sleep_stages_table": base.select(
            "user_id",
            F.when(F.col("local_date") == 19723, 0).otherwise(n).alias("parent_key"),
            F.lit(5).alias("stage_type"),
            start.alias("stage_start_time"),
            (start + 6_000).alias("stage_end_time"),
        ),
        "steps_record_table": base.withColumn("count", F.lit(1).cast("long")),
        "active_calories_burned_record_table": base.withColumn("energy", F.lit(2000.0)),
        "exercise_session_record_table": base.select(
            "*", (n % 2 * 8 + 45).cast("int").alias("exercise_type"), start.alias("start_time"), (start + 60_000).alias("end_time")
        ),
        "resting_heart_rate_record_table": base.withColumn("beats_per_minute", 50 + n % 60),
        "oxygen_saturation_record_table": base.withColumn("percentage", (80 + n % 21).cast("double")),
        # a hot day with many distinct weights, and empty readings among them
        "weight_record_table": base.withColumn("weight", F.when(n % 10 != 0, (60_000 + n % 20_000).cast("double"))),
    }


@pytest.fixture(scope="module")
def clean(raw):
    return silver.run(raw, AS_OF, KEYS, "row_id", iso=False)


def test_sums_of_the_hot_day(raw, clean):
    hot = F.col("user_id").eqNullSafe(0) & (F.col("local_date") == F.lit("2024-01-01").cast("date"))
    n = raw["steps_record_table"].where("user_id = 0 AND local_date = 19723").count()
    assert n >= N // 3
    assert clean["steps"].where(hot).first()["steps"] == n
    assert clean["calories"].where(hot).first()["active_kcal"] == 2.0 * n
    assert clean["exercise"].where(hot).first()["workouts"] == n
    stages = raw["sleep_stages_table"].where("user_id = 0 AND parent_key = 0").count()
    assert clean["sleep"].where(hot).first()["deep_minutes"] == round(stages * 0.1, 1)


def test_every_weight_row_is_kept(raw, clean):
    readings = raw["weight_record_table"].count()
    days = raw["weight_record_table"].groupBy("user_id").agg(F.countDistinct("local_date").alias("d"), F.min("local_date").alias("m"))
    gaps = days.agg(F.sum(F.lit(19813) - F.col("m") + 1 - F.col("d")).alias("g")).first()["g"]
    assert clean["weight"].count() == readings + gaps


def test_gold_keeps_the_fan_out(raw, clean):
    built = gold.build(clean, KEYS)
    spine = clean["steps"].select(*KEYS, "local_date").union(clean["sleep"].select(*KEYS, "local_date")).distinct()
    plain = spine.join(clean["weight"], [*KEYS, "local_date"], "left")
    columns = [*KEYS, F.col("local_date").cast("string").alias("local_date"), "weight_kg"]

    def counted(df):
        return df.select(*columns).groupBy(*KEYS, "local_date", "weight_kg").count()

    a, b = counted(built), counted(plain)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0
    assert built.count() == plain.count()
    week = weekly.week_rows(built, KEYS)
    assert week.groupBy(*KEYS).count().where("count <> 7").count() == 0
    assert report.run(built, KEYS).count() == weekly.anchor(built, KEYS).count()


def longest_group_in_a_window(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Window [") :]


def test_the_weight_window_sees_days_not_readings(clean):
    below = longest_group_in_a_window(clean["weight"])
    # window <- sort <- shuffle by key <- one row per (key, day)
    assert below.index("HashAggregate(keys=[user_id") < below.index("FileScan" if "FileScan" in below else "Range")


def test_no_cross_join_and_no_python(clean):
    text = gold.build(clean, KEYS)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def rows_per_task(df):
    counts = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    return sorted(r["count"] for r in counts)


@pytest.mark.parametrize("keys", [KEYS, []])
@pytest.mark.parametrize("empty", [False, True])
def test_no_task_writes_the_hot_day(spark, raw, keys, empty):
    """A third of all readings on one day with few distinct weights, or all empty: copies are
    written by every task alike."""
    hot = F.col("local_date") == 19723
    few = F.when(F.lit(empty) & hot, None).otherwise(F.when(hot, 70_000 + F.col("row_id") % 3).otherwise(60_000)).cast("double")
    records = {**raw, "weight_record_table": raw["weight_record_table"].withColumn("weight", few)}
    clean = silver.run(records, AS_OF, keys, "row_id", iso=False)
    counts = silver.weight_counts(records["weight_record_table"], AS_OF, keys, "row_id")
    for df in (clean["weight"], gold.build(clean, keys, counts=counts, as_of=AS_OF)):
        sizes = rows_per_task(df)
        assert len(sizes) == 8 and sizes[-1] <= 1.5 * sizes[4]


def test_gold_from_counts_equals_gold_from_silver(raw, clean):
    counts = silver.weight_counts(raw["weight_record_table"], AS_OF, KEYS, "row_id")
    a = gold.build(clean, KEYS, counts=counts, as_of=AS_OF)
    b = gold.build(clean, KEYS)
    columns = [*KEYS, "local_date", "weight_kg", "steps", "sleep_hours"]
    assert a.select(columns).exceptAll(b.select(columns)).count() == 0
    assert b.select(columns).exceptAll(a.select(columns)).count() == 0


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_raw_weights_are_aggregated_once(spark, raw, tmp_path):
    path = str(tmp_path / "weights")
    raw["weight_record_table"].write.parquet(path)
    plan = final_plan(silver.weight(spark.read.parquet(path), AS_OF, KEYS, "row_id"))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_sums_do_not_depend_on_the_partitioning(spark):
    """Fractions whose double sums differ with their order."""
    n = F.col("id")
    df = spark.range(60_000).select(
        F.lit(4).alias("app_info_id"), (19723 + n % 3).alias("local_date"),
        (n * 0.1 + 1e-3).alias("energy"), (85 + n % 15 + (n % 7) / 7.0).alias("percentage"),
    )
    results = set()
    for parts in (1, 3, 8, 17):
        split = df.orderBy(F.xxhash64("energy", F.lit(parts))).repartition(parts)
        sums = [tuple(r) for r in silver.calories(split).unionByName(silver.spo2(split), allowMissingColumns=True).collect()]
        results.add(tuple(sorted(sums, key=str)))
    assert len(results) == 1


def test_sums_of_any_doubles_are_exact_in_any_order(spark, frame):
    """Against exact fractions: signs, sizes from 1e-12 to 1e9, and what is not finite."""
    import math
    import random
    from fractions import Fraction

    from daymetrics.functions import scalars as S

    draw = random.Random(8)
    groups = {g: [draw.choice([-1, 1]) * draw.random() * 10 ** draw.randint(-9, 9) for _ in range(200)] for g in range(20)}
    groups[20] = [0.1] * 10 + [None]
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    for parts in (1, 3, 8, 17):
        draw.shuffle(rows)
        got = frame("g int, x double", rows).repartition(parts).groupBy("g").agg(S.exact_sum(F.col("x")).alias("s")).collect()
        for r in got:
            cut = [Fraction(math.floor(Fraction(x) * 2**60), 2**60) for x in groups[r["g"]] if x is not None]
            assert r["s"] == float(sum(cut))
    odd = {0: [1.0, math.nan], 1: [math.inf, 5.0], 2: [math.inf, -math.inf], 3: [None], 4: [-math.inf, 1e300], 5: [1e12, 0.5, -1e12]}
    got = dict(frame("g int, x double", [(g, x) for g, xs in odd.items() for x in xs]).groupBy("g").agg(S.exact_sum(F.col("x"))).collect())
    assert math.isnan(got[0]) and got[1] == math.inf and math.isnan(got[2]) and got[3] is None and got[4] == -math.inf and got[5] == 0.5


def test_a_reading_that_is_not_a_number_counts(frame):
    """NaN and 95 have no mean; the minimum is 95."""
    df = frame("local_date long, percentage double, app_info_id int, energy double", [(1, float("nan"), 4, float("nan")), (1, 95.0, 4, 10.0)])
    got = silver.spo2(df).first()
    assert got["spo2_avg"] != got["spo2_avg"] and got["spo2_min"] == 95.0
    assert silver.calories(df).first()["active_kcal"] != silver.calories(df).first()["active_kcal"]
