import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymetrics.operators import quality, silver

HOUR = 3_600_000
MINUTE = 60_000
SESSIONS = "row_id long, local_date long, start_time long, end_time long, app_info_id int"
STAGES = "parent_key long, stage_type int, stage_start_time long, stage_end_time long"
D = "2024-01-0{}".format  # epoch day 19723 is 2024-01-01


def test_sleep_by_hand(frame, rows):
    sessions = frame(
        SESSIONS,
        [
            (1, 19723, 0, 8 * HOUR, 4),
            (2, 19723, 0, HOUR, 2),  # another source: its stages count, its hours do not
            (3, 19724, 0, HOUR // 2, 4),  # exactly half an hour stays, no stages
            (4, 19725, 0, HOUR // 2 - 1, 4),  # a millisecond less goes
            (5, 19726, 0, 9 * HOUR, 2),  # no watch session that day
            (6, None, 0, 9 * HOUR, 4),
            (7, 19727, 0, 6 * HOUR, 4),
            (8, 19727, 0, None, 4),  # no end: adds nothing
        ],
    )
    stages = frame(
        STAGES,
        [
            (1, 4, 0, 100 * MINUTE),
            (1, 5, 0, 60 * MINUTE),
            (1, 6, 0, 45 * MINUTE),
            (1, 1, 0, 24 * MINUTE),
            (1, 2, 0, 999 * MINUTE),  # a kind that counts nowhere
            (2, 5, 0, 10 * MINUTE),
            (99, 5, 0, 10 * MINUTE),  # no such session
            (7, 1, 0, 7 * HOUR),  # more awake than in bed
        ],
    )
    assert rows(silver.sleep(sessions, stages)) == [
        (D(1), 8.0, 100.0, 70.0, 45.0, 24.0, 0.95),
        (D(2), 0.5, None, None, None, None, None),
        (D(5), 6.0, 0.0, 0.0, 0.0, 420.0, 0.0),
    ]
    watch_only = silver.sleep(sessions, stages, filter_stages=True)
    assert rows(watch_only)[0] == (D(1), 8.0, 100.0, 60.0, 45.0, 24.0, 0.95)
    assert quality.undated(sessions).first()["undated_rows"] == 1


def test_sleep_sums_before_it_filters_and_rounds(frame, rows):
    sessions = frame(SESSIONS, [(i, 19723, 0, 10 * MINUTE, 4) for i in range(3)])
    assert rows(silver.sleep(sessions, frame(STAGES, [])), "sleep_hours") == [(0.5,)]


def test_sleep_keeps_sessions_that_share_an_id_across_users(frame, rows):
    sessions = frame("user_id long, " + SESSIONS, [(u, 1, 19723, 0, u * HOUR, 4) for u in (1, 2)])
    stages = frame("user_id long, " + STAGES, [(u, 1, 5, 0, u * MINUTE) for u in (1, 2)])
    got = rows(silver.sleep(sessions, stages, ["user_id"]), "user_id", "sleep_hours", "deep_minutes")
    assert got == [(1, 1.0, 1.0), (2, 2.0, 2.0)]


def test_steps(frame, rows):
    df = frame(
        "local_date long, count long, app_info_id int",
        [
            (19723, 5000, 4), (19723, 3000, 4), (19723, 9999, 2),
            (19724, 0, 4), (19725, None, 4), (None, 10, 4), (19726, 7, None),
        ],
    )
    got = silver.steps(df)
    assert rows(got) == [(D(1), 8000)]
    assert dict(got.dtypes) == {"local_date": "string", "steps": "int"}
    assert silver.steps(df, iso=False).first()["local_date"] == dt.date(2024, 1, 1)


def test_calories(frame, rows):
    df = frame(
        "local_date long, energy double, app_info_id int",
        [(19723, 250_000.0, 4), (19723, 200_050.0, 4), (19723, 1e9, 1), (19724, None, 4)],
    )
    assert rows(silver.calories(df)) == [(D(1), 450.1), (D(2), None)]


def test_heart_rate_keeps_exactly_100(frame, rows):
    df = frame(
        "local_date long, beats_per_minute long",
        [(19723, 101), (19723, 58), (19723, 52), (19724, 100), (19725, 101), (19726, None)],
    )
    assert rows(silver.heart_rate(df)) == [(D(1), 52), (D(2), 100)]


def test_spo2_keeps_exactly_85(frame, rows):
    df = frame(
        "local_date long, percentage double",
        [(19723, 97.0), (19723, 98.0), (19723, 96.0), (19723, 84.9), (19724, 85.0), (19725, 84.0), (19726, 97.25), (19726, 97.0)],
    )
    assert rows(silver.spo2(df)) == [(D(1), 97.0, 96.0), (D(2), 85.0, 85.0), (D(4), 97.13, 97.0)]


def test_exercise(frame, rows):
    df = frame(
        "local_date long, start_time long, end_time long, exercise_type int",
        [
            # 45 has the longest single session, 53 the most minutes
            (19723, 0, 50 * MINUTE, 45), (19723, 0, 30 * MINUTE, 53), (19723, 0, 30 * MINUTE, 53),
            # a tie goes to the smaller code
            (19724, 0, 40 * MINUTE, 58), (19724, 0, 40 * MINUTE, 53),
            # 5 and 99 share a label and stay separate groups, so running wins
            (19725, 0, 30 * MINUTE, 5), (19725, 0, 30 * MINUTE, 99), (19725, 0, 35 * MINUTE, 53),
            # no code at all, and more minutes than the other
            (19726, 0, 30 * MINUTE, None), (19726, 0, 20 * MINUTE, 45),
            # no duration anywhere: minutes 0, smaller code
            (19727, 0, None, 58), (19727, 0, None, 45),
            # no duration loses against a negative one
            (19728, 0, None, 45), (19728, 10, 0, 53),
        ],
    )
    assert rows(silver.exercise(df)) == [
        (D(1), 3, 110.0, "Running"),
        (D(2), 2, 80.0, "Running"),
        (D(3), 3, 95.0, "Running"),
        (D(4), 2, 50.0, "Otro"),
        (D(5), 2, 0.0, "Fuerza"),
        (D(6), 2, -0.0, "Running"),
    ]
    assert rows(silver.exercise(df, {53: "Carrera"}), "workout_type")[0] == ("Carrera",)


WEIGHT = "row_id long, local_date long, weight double"


def test_weight_carries_on(frame, rows):
    df = frame(WEIGHT, [(1, 19723, 78_500.0), (2, 19726, 78_125.0), (3, 19800, 70_000.0)])
    got = rows(silver.weight(df, "2024-01-06"))
    assert got == [(D(1), 78.5), (D(2), 78.5), (D(3), 78.5), (D(4), 78.12), (D(5), 78.12), (D(6), 78.12)]


def test_weight_fans_out_or_keeps_the_last(frame, rows):
    df = frame(WEIGHT, [(5, 19723, 80_000.0), (9, 19723, 79_000.0), (7, 19723, 81_000.0)])
    fan = rows(silver.weight(df, "2024-01-02", tie_break="row_id"))
    assert fan == [(D(1), 79.0), (D(1), 80.0), (D(1), 81.0), (D(2), 79.0)]
    last = silver.weight(df, "2024-01-02", tie_break="row_id", dedupe="last")
    assert rows(last) == [(D(1), 79.0), (D(2), 79.0)]
    heaviest = silver.weight(df, "2024-01-02", dedupe="last")
    assert rows(heaviest) == [(D(1), 81.0), (D(2), 81.0)]
    with pytest.raises(ValueError):
        silver.weight(df, "2024-01-02", dedupe="first")


def test_weight_empty_readings(frame, rows):
    df = frame(
        WEIGHT,
        [(1, 19723, None), (2, 19724, 80_000.0), (3, 19724, None), (4, 19726, None), (5, 19726, None)],
    )
    assert rows(silver.weight(df, "2024-01-05", tie_break="row_id")) == [
        (D(1), None), (D(2), 80.0), (D(2), 80.0), (D(3), 80.0), (D(4), 80.0), (D(4), 80.0), (D(5), 80.0),
    ]


def test_weight_without_usable_readings(frame, rows):
    assert rows(silver.weight(frame(WEIGHT, []), "2024-01-05")) == []
    late = frame(WEIGHT, [(1, 19800, 80_000.0), (2, None, 80_000.0)])
    assert rows(silver.weight(late, "2024-01-05")) == []
    on_the_day = frame(WEIGHT, [(1, 19727, 80_000.0)])
    assert rows(silver.weight(on_the_day, dt.date(2024, 1, 5))) == [(D(5), 80.0)]


def test_weight_calendar_is_dense_per_key(spark):
    df = spark.range(400).selectExpr(
        "id AS row_id", "id % 7 AS user_id", "19723 + id * 37 % 90 AS local_date", "70000D + id AS weight"
    )
    got = silver.weight(df, "2024-05-01", ["user_id"], "row_id", dedupe="last")
    per_user = got.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.countDistinct("local_date").alias("days"),
        F.datediff(F.max(F.to_date("local_date")), F.min(F.to_date("local_date"))).alias("span"),
        F.count_if(F.col("weight_kg").isNull()).alias("nulls"),
        F.max("local_date").alias("last"),
    )
    for r in per_user.collect():
        assert (r["n"], r["days"], r["nulls"], r["last"]) == (r["span"] + 1, r["n"], 0, "2024-05-01")


def test_records_without_a_key_reach_no_table(frame):
    """They are counted, and leave no row, no absent week and no second row for a day."""
    from daymetrics.operators import gold, quality, weekly

    keys, day = ["user_id"], 19723
    raw = {
        "sleep_session_record_table": frame(
            "row_id long, user_id long, local_date long, start_time long, end_time long, app_info_id int",
            [(1, None, day, 0, 30_000_000, 4), (2, 7, day, 0, 30_000_000, 4)],
        ),
        "sleep_stages_table": frame(
            "user_id long, parent_key long, stage_type int, stage_start_time long, stage_end_time long",
            [(None, 1, 5, 0, 60_000), (7, 2, 5, 0, 120_000)],
        ),
        "steps_record_table": frame("user_id long, local_date long, count long, app_info_id int", [(None, day, 5, 4), (7, day, 6, 4)]),
        "active_calories_burned_record_table": frame("user_id long, local_date long, energy double, app_info_id int", [(None, day, 1.0, 4)]),
        "exercise_session_record_table": frame(
            "user_id long, local_date long, exercise_type int, start_time long, end_time long", [(None, day, 45, 0, 60_000)]
        ),
        "resting_heart_rate_record_table": frame("user_id long, local_date long, beats_per_minute long", [(None, day, 60)]),
        "oxygen_saturation_record_table": frame("user_id long, local_date long, percentage double", [(None, day, 95.0)]),
        "weight_record_table": frame("row_id long, user_id long, local_date long, weight double", [(1, None, day, 70_000.0)]),
    }
    clean = silver.run(raw, "2024-02-05", keys, "row_id", iso=False)
    assert {t: [r["user_id"] for r in df.collect()] for t, df in clean.items()} == {
        "sleep": [7], "steps": [7], "calories": [], "exercise": [], "heart_rate": [], "spo2": [], "weight": [],
    }
    assert clean["sleep"].first()["deep_minutes"] == 2.0
    built = gold.build(clean, keys)
    assert [(r["user_id"], r["steps"]) for r in built.collect()] == [(7, 6)]
    assert {r["user_id"] for r in weekly.week_rows(built, keys).collect()} == {7}
    counted = {r["source_table"]: r["keyless_rows"] for r in quality.keyless_by_table(raw, keys).collect()}
    assert set(counted.values()) == {1} and len(counted) == 8
