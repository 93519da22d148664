"""Raw tables derived from the `events` test table (FIXTURES.md, C), all rows of each kind.

Gives every operator a real input at each scale factor. All arithmetic is on whole numbers,
so another engine derives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-02-05"
KEYS = ["user_id"]
START = "local_date * 86400000"
# Sessions shorter than an hour are recorded without stages.
STAGED = "end_time - start_time >= 3600000"
# (stage code, its percentage of the session)
STAGE_SHARES = "array(struct(1, 5), struct(2, 5), struct(4, 50), struct(5, 20), struct(6, 20))"

SESSION = [
    "event_id AS row_id",
    "user_id",
    "local_date",
    "app_info_id",
    f"{START} AS start_time",
    f"{START} + cv * 6000 AS end_time",
]
# Table -> (kinds of event it takes, columns).
TABLES = {
    "sleep_session_record_table": (["signup"], SESSION),
    "steps_record_table": (
        ["view"],
        ["user_id", "local_date", "app_info_id", "if(cv % 11 = 0, 0, cv) AS count"],
    ),
    "active_calories_burned_record_table": (
        ["click"],
        ["user_id", "local_date", "app_info_id", "CAST(cv * 97 AS DOUBLE) AS energy"],
    ),
    "exercise_session_record_table": (
        ["purchase"],
        [
            "user_id",
            "local_date",
            "CASE event_id % 5 WHEN 0 THEN 45 WHEN 1 THEN 53 WHEN 2 THEN 58 WHEN 3 THEN 5 ELSE 99 END"
            " AS exercise_type",
            f"{START} AS start_time",
            f"{START} + cv * 600 AS end_time",
        ],
    ),
    "resting_heart_rate_record_table": (
        ["error"],
        ["user_id", "local_date", "40 + cv % 90 AS beats_per_minute"],
    ),
    "oxygen_saturation_record_table": (
        ["error", "view"],
        ["user_id", "local_date", "CAST(80 + cv % 21 AS DOUBLE) AS percentage"],
    ),
    "weight_record_table": (
        ["click"],
        ["event_id AS row_id", "user_id", "local_date", "CAST(60000 + cv % 30000 AS DOUBLE) AS weight"],
    ),
}


#: The same tables with what real exports hold besides: records without a user or date, or dated
#: after `AS_OF`, users who never sleep, empty measures, ties, values on a threshold, fractions.
EDGES = {
    "sleep_session_record_table": (
        ["signup"],
        [
            *SESSION[:-1],
            f"{START} + CASE event_id % 4 WHEN 0 THEN 1800000 WHEN 1 THEN 1799999 ELSE cv * 6000 END AS end_time",
        ],
        "user_id % 7 <> 3",
    ),
    "steps_record_table": (
        ["view"],
        ["user_id", "local_date", "app_info_id", "if(event_id % 11 = 0, NULL, cv) AS count"],
        "true",
    ),
    "active_calories_burned_record_table": (
        ["click"],
        ["user_id", "local_date", "app_info_id", "if(event_id % 23 = 0, NULL, cv * 97 / 10D) AS energy"],
        "true",
    ),
    "exercise_session_record_table": (
        ["purchase"],
        [
            "user_id",
            "local_date",
            "CASE event_id % 3 WHEN 0 THEN 45 WHEN 1 THEN 53 ELSE 58 END AS exercise_type",
            f"{START} AS start_time",
            f"{START} + 600000 AS end_time",
        ],
        "true",
    ),
    "resting_heart_rate_record_table": (
        ["error"],
        ["user_id", "local_date", "if(event_id % 9 = 0, NULL, 96 + cv % 10) AS beats_per_minute"],
        "true",
    ),
    "oxygen_saturation_record_table": (
        ["error", "view"],
        ["user_id", "local_date", "if(event_id % 9 = 0, NULL, 84 + cv % 20 / 7D) AS percentage"],
        "true",
    ),
    "weight_record_table": (
        ["click"],
        [
            "event_id AS row_id",
            "user_id",
            "local_date",
            "if(event_id % 3 = 0, NULL, CAST(60000 + cv % 30000 AS DOUBLE)) AS weight",
        ],
        "true",
    ),
}
#: The same for measures that are added up: not a number, infinite, and with twelve decimals.
EXTREMES = {
    "active_calories_burned_record_table": (
        "energy",
        "CASE WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 103 = 0 THEN CAST('Infinity' AS DOUBLE)"
        " WHEN event_id % 107 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE energy + event_id / 1000000000000D END",
    ),
    "oxygen_saturation_record_table": (
        "percentage",
        "CASE WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 103 = 0 THEN CAST('Infinity' AS DOUBLE)"
        " ELSE percentage + event_id / 1000000000000D END",
    ),
}
#: Users are few enough that several records fall on one day of one user.
EDGE_EVENTS = [
    "event_id",
    "if(event_id % 13 = 0, NULL, user_id % 40) AS user_id",
    "event_type",
    "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN local_date + 40 ELSE local_date END AS local_date",
    "cv",
    "app_info_id",
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(unix_date(CAST(ts AS DATE)) AS BIGINT) AS local_date",
        "CAST(floor(value * 100 + 0.5D) AS BIGINT) AS cv",
        "if(event_id % 5 = 0, 2, 4) AS app_info_id",
    )


def _derive(events: DataFrame, table: str) -> DataFrame:
    if table != "sleep_stages_table":
        kinds, columns = TABLES[table]
        wanted = ", ".join(f"'{k}'" for k in kinds)
        return events.where(f"event_type IN ({wanted})").selectExpr(*columns)
    return _stages(_derive(events, "sleep_session_record_table"))


def _stages(sessions: DataFrame) -> DataFrame:
    return (
        sessions.where(STAGED)
        .selectExpr("*", f"inline({STAGE_SHARES}) AS (stage_type, pct)")
        .selectExpr(
            "row_id AS parent_key",
            "user_id",
            "stage_type",
            "start_time AS stage_start_time",
            "start_time + (end_time - start_time) * pct DIV 100 AS stage_end_time",
        )
    )


def edges(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw tables, with edge cases."""
    events = _events(spark, sf_dir).selectExpr(*EDGE_EVENTS)
    made = {}
    for table, (kinds, columns, rule) in EDGES.items():
        wanted = ", ".join(f"'{k}'" for k in kinds)
        # A record without a user satisfies no rule about users; it stays.
        made[table] = events.where(f"event_type IN ({wanted}) AND coalesce({rule}, true)").selectExpr(*columns)
    made["sleep_stages_table"] = _stages(made["sleep_session_record_table"])
    return made


def extremes(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A raw table with edge cases whose measure is at times not finite or has many decimals."""
    kinds, columns, _ = EDGES[table]
    name, measure = EXTREMES[table]
    wanted = ", ".join(f"'{k}'" for k in kinds)
    found = _events(spark, sf_dir).selectExpr(*EDGE_EVENTS).where(f"event_type IN ({wanted})")
    return found.selectExpr("event_id", *columns).withColumn(name, F.expr(measure)).drop("event_id")


def bronze(
    spark: SparkSession,
    sf_dir: str,
    names: Sequence[str] = (*TABLES, "sleep_stages_table"),
) -> dict[str, DataFrame]:
    events = _events(spark, sf_dir)
    return {name: _derive(events, name) for name in names}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bronze(spark, sf_dir, [name])[name]
