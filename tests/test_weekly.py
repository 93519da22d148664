import datetime as dt

import pytest

from daymetrics.operators import weekly
from daymetrics.plans import report

GOLD = (
    "local_date string, steps int, sleep_hours double, light_minutes double, deep_minutes double, "
    "rem_minutes double, awake_minutes double, sleep_efficiency double, active_kcal double, workouts int, "
    "workout_minutes double, workout_type string, resting_hr int, spo2_avg double, spo2_min double, "
    "weight_kg double, is_workout_day int"
)


def day(date, steps=0, sleep=None, deep=None, rem=None, kcal=None, minutes=0.0, kind="Descanso", hr=None, spo2=None, kg=None):
    return (date, steps, sleep, None, deep, rem, None, None, kcal, int(minutes > 0), minutes, kind, hr, spo2, None, kg, int(minutes > 0))


FORTNIGHT = [
    day("2026-06-10", steps=9999, sleep=5.0),  # a day too early for the prior week
    day("2026-06-11", steps=4000, sleep=7.01),
    day("2026-06-14", steps=0, sleep=7.02),  # sleep only: zero steps count in the mean
    day("2026-06-17", steps=7500),
    # the week: 18 to 24; 20 and 22 are missing
    day("2026-06-18", steps=8000, sleep=7.35, deep=60.5, rem=44.5, kcal=450.5, minutes=60.0, kind="Fuerza", hr=52, spo2=97.55, kg=78.0),
    day("2026-06-18", steps=8000, sleep=7.35, deep=60.5, rem=44.5, kcal=450.5, minutes=60.0, kind="Fuerza", hr=52, spo2=97.55, kg=79.0),
    day("2026-06-19", steps=500),
    day("2026-06-21", steps=0, sleep=6.25, minutes=30.4, kind="Otro"),
    day("2026-06-23", steps=12000, kcal=12345678.9, hr=55),
    day("2026-06-24", steps=700, sleep=8.0, deep=90.0, rem=50.0, minutes=45.0, kind="Running", hr=50, spo2=98.0),
    day("2026-06-25", steps=300),  # after the last night with sleep
    day("2026-06-26", steps=300, sleep=0.0),
]


@pytest.fixture
def gold(frame):
    return frame(GOLD, FORTNIGHT)


def test_anchor_is_the_last_day_with_sleep(gold, rows):
    assert rows(weekly.anchor(gold)) == [("2026-06-24",)]


def test_week_rows(gold, rows):
    absent = (None, None, None, 0, None, "-", 0.0, None, None)
    assert rows(weekly.week_rows(gold)) == [
        ("2026-06-18", "Jueves", 7.3, 60.0, 44.0, 8000, 450.0, "Fuerza", 60.0, 52.0, 97.5),
        ("2026-06-19", "Viernes", None, None, None, 500, None, "Descanso", 0.0, None, None),
        ("2026-06-20", "Sábado", *absent),
        ("2026-06-21", "Domingo", 6.2, None, None, 0, None, "Otro", 30.0, None, None),
        ("2026-06-22", "Lunes", *absent),
        ("2026-06-23", "Martes", None, None, None, 12000, 12345679.0, "Descanso", 0.0, 55.0, None),
        ("2026-06-24", "Miércoles", 8.0, 90.0, 50.0, 700, None, "Running", 45.0, 50.0, 98.0),
    ]


def test_rounding_is_that_of_the_stored_value():
    # what the expected values above rest on
    assert (round(7.35, 1), round(6.25, 1), round(97.55, 1), round(60.5), round(44.5)) == (7.3, 6.2, 97.5, 60, 44)


def test_stats(gold, rows):
    got = rows(weekly.stats(weekly.week_rows(gold)))
    nights, deep = 3, 60.0 + 90.0
    assert got == [
        (21200, 3, 135.0, round((7.3 + 6.2 + 8.0) / nights, 2), round(deep / nights, 1), round((52 + 55 + 50) / 3, 1))
    ]


def test_prior_week(gold, rows):
    # steps 4000, 0, 7500 and sleep 7.01, 7.02
    assert rows(weekly.prior_week(gold)) == [(3833.0, round(14.03 / 2 * 100) / 100)]


def test_prior_week_counts_duplicate_rows(frame, rows):
    twice = [day("2026-06-11", steps=100, sleep=6.0, kg=k) for k in (70.0, 71.0, 72.0)]
    df = frame(GOLD, [*twice, day("2026-06-12", steps=500, sleep=8.0), day("2026-06-24", sleep=8.0)])
    assert rows(weekly.prior_week(df)) == [(200.0, 6.5)]


def test_prior_week_without_data(frame, rows):
    df = frame(GOLD, [day("2026-06-24", sleep=8.0)])
    assert rows(weekly.prior_week(df)) == [(None, None)]
    assert rows(weekly.week_over_week(df), "prior_avg_steps", "avg_hr", "avg_sleep") == [(None, 0.0, 8.0)]


def test_no_sleep_no_week(frame, rows):
    df = frame(GOLD, [day("2026-06-24", steps=5)])
    for result in (
        weekly.anchor(df), weekly.week_rows(df), weekly.stats(weekly.week_rows(df)),
        weekly.prior_week(df), weekly.week_over_week(df), report.run(df),
    ):
        assert rows(result) == []


def test_keys_are_independent(spark, gold, rows):
    keyed = gold.selectExpr("1 AS user_id", "*").unionByName(
        gold.selectExpr("2 AS user_id", "*").where("local_date < '2026-06-22'")
    ).unionByName(gold.selectExpr("3 AS user_id", "*").where("sleep_hours IS NULL"))
    assert rows(weekly.anchor(keyed, ["user_id"])) == [(1, "2026-06-24"), (2, "2026-06-21")]
    week = weekly.week_rows(keyed, ["user_id"])
    assert {r["user_id"]: r["count"] for r in week.groupBy("user_id").count().collect()} == {1: 7, 2: 7}
    assert rows(week.where("user_id = 1").drop("user_id")) == rows(weekly.week_rows(gold))
    both = weekly.week_over_week(keyed, ["user_id"])
    parts = weekly.stats(week, ["user_id"]).join(weekly.prior_week(keyed, ["user_id"]), "user_id")
    assert rows(both) == rows(parts)


def test_dates_as_date_or_text(gold, rows):
    typed = gold.withColumn("local_date", gold["local_date"].cast("date"))
    assert isinstance(typed.first()["local_date"], dt.date)
    assert rows(weekly.week_rows(typed)) == rows(weekly.week_rows(gold))


EXPECTED_TABLE = """📅 RESUMEN DÍA A DÍA

🔵 Jueves (2026-06-18)
   💤 Sueño: 7.3h  |  🧠 Profundo: 60.0min  |  🌀 REM: 44.0min
   🚶 Pasos: 8000  |  🔥 Kcal: 450.0
   💪 Entreno: Fuerza — 60.0min
   ❤️ FC reposo: 52.0 bpm  |  🩸 SpO2: 97.5%

🔵 Viernes (2026-06-19)
   💤 Sueño: -h  |  🧠 Profundo: -min  |  🌀 REM: -min
   🚶 Pasos: 500  |  🔥 Kcal: -
   😴 Entreno: Descanso — 0.0min
   ❤️ FC reposo: sin datos  |  🩸 SpO2: sin datos

🟡 Sábado (2026-06-20)
   💤 Sueño: -h  |  🧠 Profundo: -min  |  🌀 REM: -min
   🚶 Pasos: 0  |  🔥 Kcal: -
   😴 Entreno: - — 0min
   ❤️ FC reposo: sin datos  |  🩸 SpO2: sin datos

🟡 Domingo (2026-06-21)
   💤 Sueño: 6.2h  |  🧠 Profundo: -min  |  🌀 REM: -min
   🚶 Pasos: 0  |  🔥 Kcal: -
   🏋️ Entreno: Otro — 30.0min
   ❤️ FC reposo: sin datos  |  🩸 SpO2: sin datos

🔵 Lunes (2026-06-22)
   💤 Sueño: -h  |  🧠 Profundo: -min  |  🌀 REM: -min
   🚶 Pasos: 0  |  🔥 Kcal: -
   😴 Entreno: - — 0min
   ❤️ FC reposo: sin datos  |  🩸 SpO2: sin datos

🔵 Martes (2026-06-23)
   💤 Sueño: -h  |  🧠 Profundo: -min  |  🌀 REM: -min
   🚶 Pasos: 12000  |  🔥 Kcal: 12345679.0
   😴 Entreno: Descanso — 0.0min
   ❤️ FC reposo: 55.0 bpm  |  🩸 SpO2: sin datos

🔵 Miércoles (2026-06-24)
   💤 Sueño: 8.0h  |  🧠 Profundo: 90.0min  |  🌀 REM: 50.0min
   🚶 Pasos: 700  |  🔥 Kcal: -
   🏃 Entreno: Running — 45.0min
   ❤️ FC reposo: 50.0 bpm  |  🩸 SpO2: 98.0%
"""

EXPECTED_SUMMARY = f"""DATOS DE LA SEMANA (2026-06-18 → 2026-06-24)

{EXPECTED_TABLE}

ESTADÍSTICAS:
- Total pasos: 21200
- Días de entrenamiento: 3/7
- Total minutos entrenados: 135.0
- Media sueño/noche: 7.17h
- Media sueño profundo/noche: 50.0min
- Media FC reposo: 52.3 bpm

SEMANA ANTERIOR:
- Media pasos: 3833.0
- Media sueño: {round(14.03 / 2 * 100) / 100}h
"""


def test_report_texts(gold):
    row = report.run(gold).first()
    assert row["tabla"] == EXPECTED_TABLE
    assert row["summary"] == EXPECTED_SUMMARY
    assert (row["fecha_inicio"], row["fecha_fin"]) == ("2026-06-18", "2026-06-24")
    assert report.week_text(weekly.week_rows(gold)).first()["tabla"] == EXPECTED_TABLE


def test_report_without_training_or_prior_week(frame):
    summary = report.summary_text(frame(GOLD, [day("2026-06-24", sleep=8.0)])).first()["summary"]
    assert "- Total minutos entrenados: 0\n" in summary
    assert "- Media pasos: N/A\n- Media sueño: N/Ah\n" in summary
    assert "- Media FC reposo: 0.0 bpm\n" in summary


def test_messages(gold):
    full = f"📊 INFORME SEMANAL\n2026-06-18 → 2026-06-24\n\n{EXPECTED_TABLE}"
    parts = report.messages(report.run(gold), size=100).orderBy("chunk_no").collect()
    assert [p["chunk"] for p in parts] == [full[i : i + 100] for i in range(0, len(full), 100)]
    assert report.messages(report.run(gold)).count() == 1


def test_analysis_message(frame):
    df = frame("id int, answer string", [(1, " **Bien** <b>hoy</b>\n\n\n\nfin ")])
    got = report.analysis_messages(df, "answer").first()
    assert (got["id"], got["chunk_no"], got["chunk"]) == (1, 0, "🤖 ANÁLISIS EXPERTO\n\nBien hoy\n\nfin")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("keys", [["user_id"], []])
def test_other_days_go_before_anything_is_aggregated(spark, frame, no_broadcast, keys):
    """Below the aggregate of Gold stands the join that bounds the days; nothing sorts to aggregate."""
    from daymetrics.plans import catalog, report

    gold = catalog.gold_plan(spark, "/root/testdata/sf0.001", keys)
    stored = spark.createDataFrame(gold.collect(), gold.schema)
    for df in (weekly.week_rows(stored, keys), weekly.week_over_week(stored, keys), report.run(stored, keys)):
        plan = plan_of(df)
        assert "SortAggregate" not in plan
        below = plan[plan.index("partial_count(1)") :]
        assert "ShuffledHashJoin" in below and "date_sub(anchor" in below


def test_text_is_made_after_the_rows_of_a_key_have_met(spark):
    from daymetrics.plans import catalog, report

    gold = catalog.gold_plan(spark, "/root/testdata/sf0.001")
    plan = plan_of(report.run(spark.createDataFrame(gold.collect(), gold.schema), ["user_id"]))
    assert "Pasos" in plan and "Pasos" not in plan[plan.index("Exchange") :]


def test_a_hot_day_is_not_gathered_for_its_week(spark):
    """Half of all Gold rows are copies of one day: they leave the join from several tasks."""
    from pyspark.sql import functions as F

    n = F.col("id")
    gold = spark.range(0, 80_000, 1, 16).select(
        (n % 2 * (n % 500)).alias("user_id"), F.when(n % 2 == 0, "2024-01-20").otherwise("2024-01-19").alias("local_date"),
        F.lit(5).alias("steps"), F.lit(7.0).alias("sleep_hours"), F.lit(1.0).alias("deep_minutes"), F.lit(1.0).alias("rem_minutes"),
        F.lit(None).cast("double").alias("active_kcal"), F.lit(0.0).alias("workout_minutes"), F.lit("Descanso").alias("workout_type"),
        F.lit(None).cast("int").alias("resting_hr"), F.lit(None).cast("double").alias("spo2_avg"),
    )
    week = weekly.week_rows(gold, ["user_id"])
    assert week.groupBy("user_id").count().where("count <> 7").count() == 0
    assert week.where("user_id = 0 AND fecha = '2024-01-20'").first()["steps"] == 5
