"""Columns each raw table must have. Anything else a source holds passes through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


BRONZE = {
    "sleep_session_record_table": _struct(
        row_id=LONG, local_date=LONG, start_time=LONG, end_time=LONG, app_info_id=INT
    ),
    "sleep_stages_table": _struct(
        parent_key=LONG, stage_type=INT, stage_start_time=LONG, stage_end_time=LONG
    ),
    "steps_record_table": _struct(local_date=LONG, count=LONG, app_info_id=INT),
    "active_calories_burned_record_table": _struct(local_date=LONG, energy=DOUBLE, app_info_id=INT),
    "exercise_session_record_table": _struct(
        local_date=LONG, start_time=LONG, end_time=LONG, exercise_type=INT
    ),
    "resting_heart_rate_record_table": _struct(local_date=LONG, beats_per_minute=LONG),
    "oxygen_saturation_record_table": _struct(local_date=LONG, percentage=DOUBLE),
    "weight_record_table": _struct(local_date=LONG, weight=DOUBLE),
}

SILVER = {
    "sleep": _struct(
        local_date=STRING,
        sleep_hours=DOUBLE,
        light_minutes=DOUBLE,
        deep_minutes=DOUBLE,
        rem_minutes=DOUBLE,
        awake_minutes=DOUBLE,
        sleep_efficiency=DOUBLE,
    ),
    "steps": _struct(local_date=STRING, steps=INT),
    "calories": _struct(local_date=STRING, active_kcal=DOUBLE),
    "exercise": _struct(
        local_date=STRING, workouts=INT, workout_minutes=DOUBLE, workout_type=STRING
    ),
    "heart_rate": _struct(local_date=STRING, resting_hr=INT),
    "spo2": _struct(local_date=STRING, spo2_avg=DOUBLE, spo2_min=DOUBLE),
    "weight": _struct(local_date=STRING, weight_kg=DOUBLE),
}


def missing_columns(df: DataFrame, required: T.StructType) -> list[str]:
    return [f.name for f in required if f.name not in df.columns]


def conform(df: DataFrame, required: T.StructType) -> DataFrame:
    """Cast the required columns to their declared types; text formats carry none of their own."""
    lacking = missing_columns(df, required)
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    types = {f.name: f.dataType for f in required}
    return df.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )
