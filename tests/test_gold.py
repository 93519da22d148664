import pytest

from daymetrics.operators import gold, quality, silver
from daymetrics.sources import sample


@pytest.fixture
def two_days(frame):
    a, b = "2026-06-23", "2026-06-22"
    return {
        "steps": frame("local_date string, steps int", [(a, 8000), (b, 7500)]),
        "sleep": frame(
            "local_date string, sleep_hours double, light_minutes double, deep_minutes double, "
            "rem_minutes double, awake_minutes double, sleep_efficiency double",
            [(a, 7.5, 90.0, 60.0, 45.0, 20.0, 0.95), (b, 6.5, 80.0, 50.0, 40.0, 15.0, 0.96)],
        ),
        "calories": frame("local_date string, active_kcal double", [(a, 450.0), (b, 380.0)]),
        "exercise": frame(
            "local_date string, workouts int, workout_minutes double, workout_type string",
            [(a, 1, 60.0, "Fuerza"), (b, 0, 0.0, "Descanso")],
        ),
        "heart_rate": frame("local_date string, resting_hr int", [(a, 52), (b, 54)]),
        "spo2": frame("local_date string, spo2_avg double, spo2_min double", [(a, 97.5, 96.0), (b, 98.0, 97.0)]),
        "weight": frame("local_date string, weight_kg double", [(a, 78.5), (b, 78.5)]),
    }


def test_gold_is_built(two_days):
    assert gold.build(two_days).count() == 2


def test_gold_has_no_duplicates(two_days):
    assert quality.duplicate_count(gold.build(two_days)).first()["duplicate_days"] == 0


def test_rest_day(two_days):
    row = gold.build(two_days).where("local_date = '2026-06-22'").first()
    assert row["workout_type"] == "Descanso"
    assert row["is_workout_day"] == 0


def test_gold_row(two_days, rows):
    df = gold.build(two_days)
    assert rows(df)[1] == (
        "2026-06-23", 8000, 7.5, 90.0, 60.0, 45.0, 20.0, 0.95, 450.0, 1, 60.0, "Fuerza", 52, 97.5, 96.0, 78.5, 1,
    )
    assert [t for _, t in df.dtypes] == (
        ["string", "int"] + ["double"] * 7 + ["int", "double", "string", "int"] + ["double"] * 3 + ["int"]
    )


def test_only_days_with_steps_or_sleep(two_days, frame, rows):
    two_days["steps"] = frame("local_date string, steps int", [("2026-06-22", 7500), ("2026-06-20", 10)])
    two_days["sleep"] = two_days["sleep"].where("local_date = '2026-06-23'")
    two_days["calories"] = frame("local_date string, active_kcal double", [("2026-06-01", 1.0)])
    two_days["exercise"] = two_days["exercise"].where("false")
    two_days["weight"] = two_days["weight"].where("local_date = '2026-06-23'")
    got = rows(gold.build(two_days), "local_date", "steps", "sleep_hours", "active_kcal", "workouts",
               "workout_minutes", "workout_type", "weight_kg", "is_workout_day")
    assert got == [
        ("2026-06-20", 10, None, None, 0, 0.0, "Descanso", None, 0),
        ("2026-06-22", 7500, None, None, 0, 0.0, "Descanso", None, 0),
        ("2026-06-23", 0, 7.5, None, 0, 0.0, "Descanso", 78.5, 0),
    ]


def test_weights_of_a_day_fan_out(two_days, frame, rows):
    weights = [("2026-06-23", w) for w in (78.5, 78.5, 79.0, None)] + [("2026-06-22", 77.0)]
    two_days["weight"] = frame("local_date string, weight_kg double", weights)
    df = gold.build(two_days)
    assert rows(df, "local_date", "steps", "weight_kg") == [
        ("2026-06-22", 7500, 77.0),
        ("2026-06-23", 8000, None),
        ("2026-06-23", 8000, 78.5),
        ("2026-06-23", 8000, 78.5),
        ("2026-06-23", 8000, 79.0),
    ]
    assert rows(quality.duplicate_keys(df)) == [("2026-06-23", 4)]


def test_duplicates_in_silver_show_up_in_the_check(two_days, rows):
    two_days["steps"] = two_days["steps"].union(two_days["steps"].where("steps = 8000"))
    assert rows(quality.duplicate_keys(gold.build(two_days))) == [("2026-06-23", 2)]


def test_one_user_alone_equals_their_part_of_the_population(spark, rows):
    """The same series with and without a key column."""
    bronze = sample.bronze(spark, "/root/testdata/sf0.001")
    user = bronze["steps_record_table"].groupBy("user_id").count().orderBy("count", ascending=False).first()["user_id"]
    alone = {t: df.where(f"user_id = {user}").drop("user_id") for t, df in bronze.items()}
    single = gold.build(silver.run(alone, sample.AS_OF, (), "row_id"))
    everyone = gold.build(silver.run(bronze, sample.AS_OF, ["user_id"], "row_id"), ["user_id"])
    part = everyone.where(f"user_id = {user}").drop("user_id")
    assert single.count() > 10
    assert rows(single) == rows(part)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_gold_shuffles_the_spine_and_the_weights_only(spark):
    """Beyond what the Silver tables shuffle themselves, with no table small enough to broadcast:
    the spine, the weights' counts (twice) and the blocks of copies."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = silver.run(sample.bronze(spark, "/root/testdata/sf0.001"), sample.AS_OF, ["user_id"], iso=False)
        assert exchanges(gold.spine(clean, ["user_id"])) == exchanges(clean["steps"]) + exchanges(clean["sleep"])
        alone = sum(exchanges(df) for df in clean.values())
        assert exchanges(gold.build(clean, ["user_id"])) == alone + 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
