"""Gold: all Silver metrics of a day in one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymetrics import constants as K
from daymetrics.functions import rows
from daymetrics.functions import scalars as S
from daymetrics.operators import silver as silver_ops
from daymetrics.operators.silver import DAY

SLEEP = [
    "sleep_hours",
    "light_minutes",
    "deep_minutes",
    "rem_minutes",
    "awake_minutes",
    "sleep_efficiency",
]
# Tables joined to the days that have steps or sleep, and what they add.
ADDED = {
    "calories": ["active_kcal"],
    "exercise": ["workouts", "workout_minutes", "workout_type"],
    "heart_rate": ["resting_hr"],
    "spo2": ["spo2_avg", "spo2_min"],
}

#: Column that stored Gold is partitioned by: the month of the day, for instance 202403.
MONTH = "gold_month"


def by_month(gold: DataFrame) -> DataFrame:
    """Gold with the column that it is to be stored by, so that the weekly operators read only the
    months they need."""
    return gold.withColumn(MONTH, S.month_number(S.day_column(gold)))


def _daily(df: DataFrame, keys: Sequence[str], *measures: str) -> DataFrame:
    return silver_ops.keyed(df, keys).select(*keys, S.day_column(df).alias(DAY), *measures)


def spine(silver: Mapping[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """The days that have steps or sleep; a day of sleep alone has 0 steps."""
    steps = _daily(silver["steps"], keys, "steps")
    sleep = _daily(silver["sleep"], keys, *SLEEP)
    return steps.join(sleep, [*keys, DAY], "full_outer").select(
        *keys, DAY, F.coalesce("steps", F.lit(0)).alias("steps"), *SLEEP
    )


def _carried(days: DataFrame, counts: DataFrame, as_of: date | str, keys: Sequence[str]) -> DataFrame:
    """`days` with the weight carried on to them: their rows and the days of a reading, in one window.

    A window partition holds a key's days, not readings, and no calendar is made.
    """
    measures = [c for c in days.columns if c not in (*keys, DAY)]
    asked = days.select(
        *keys, DAY, F.struct(*measures).alias("_day"), F.lit(None).cast("double").alias("closing")
    )
    read = silver_ops.closing_weights(counts, keys).select(
        *keys, DAY, F.lit(None).cast(asked.schema["_day"].dataType).alias("_day"), "closing"
    )
    # Without a row frame the current row's peers count: the day's own readings are in.
    known = F.last("closing", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(DAY))
    upto = F.when(F.col(DAY) <= S.day_literal(as_of), known)
    return (
        asked.unionByName(read)
        .withColumn("weight_kg", upto)
        .where("_day IS NOT NULL")
        .select(*keys, DAY, "_day.*", "weight_kg")
    )


def build(
    silver: Mapping[str, DataFrame],
    keys: Sequence[str] = (),
    iso: bool = True,
    counts: DataFrame | None = None,
    as_of: date | str | None = None,
) -> DataFrame:
    """One row per key and day with steps or sleep; several where the day has several weights.

    Every input is already one row per day, so the joins are even however the raw records
    are spread; Silver built in the same plan with `iso=False` arrives partitioned by
    (keys, day), and only the spine is shuffled again. The joins carry no hint: Spark
    broadcasts a table only while it is under its size threshold.

    The weights are the exception. Equal weights of a day are one row with their number up to
    the join, and are written out after it by many tasks (`rows.repeat_rows`). With `counts`
    (`silver.weight_counts`) and `as_of` they come straight from the counted readings, and
    only the days of Gold are filled; without them from the Silver table.
    """
    on = [*keys, DAY]
    joined = spine(silver, keys)
    for table, measures in ADDED.items():
        joined = joined.join(_daily(silver[table], keys, *measures), on, "left")
    if counts is not None:
        built = silver_ops.weighed(_carried(joined, counts, as_of, keys), counts, keys)
    else:
        weights = (
            _daily(silver["weight"], keys, "weight_kg")
            .groupBy(*on, "weight_kg")
            .agg(F.count(F.lit(1)).alias("_copies"))
        )
        joined = joined.join(weights, on, "left").withColumn("_copies", F.coalesce("_copies", F.lit(1).cast("long")))
        built = rows.repeat_rows(joined, "_copies", [*on, "weight_kg"])
    day = S.iso(F.col(DAY)).alias(DAY) if iso else F.col(DAY)
    return built.select(
        *keys,
        day,
        "steps",
        *SLEEP,
        "active_kcal",
        F.coalesce("workouts", F.lit(0)).alias("workouts"),
        F.coalesce("workout_minutes", F.lit(0.0)).alias("workout_minutes"),
        F.coalesce("workout_type", F.lit(K.REST_DAY)).alias("workout_type"),
        "resting_hr",
        "spo2_avg",
        "spo2_min",
        "weight_kg",
        F.when(F.col("workouts") > 0, 1).otherwise(0).alias("is_workout_day"),
    )
