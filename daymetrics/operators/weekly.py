"""The seven days that end on a key's last day with sleep, and the seven before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics import constants as K
from daymetrics.functions import rows
from daymetrics.functions import scalars as S
from daymetrics.operators.gold import MONTH
from daymetrics.operators.silver import DAY, keyed

#: Tasks that a key's rows may be dealt to before they are reduced.
_SALTS = 16
# Gold columns the week needs.
USED = [
    "steps",
    "sleep_hours",
    "deep_minutes",
    "rem_minutes",
    "active_kcal",
    "workout_minutes",
    "workout_type",
    "resting_hr",
    "spo2_avg",
]
WEEK = ["fecha", "dia", "sleep_h", "deep_min", "rem_min", "steps", "kcal", "workout", "w_min", "hr", "spo2"]


def _anchors(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        keyed(gold, keys)
        .where("sleep_hours > 0")
        .select(*keys, S.day_column(gold).alias("anchor"))
        .groupBy(*keys)
        .agg(F.max("anchor").alias("anchor"))
        .where("anchor IS NOT NULL")
    )


def anchor(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Each key's last day with sleep. A key that never slept has no row, hence no week."""
    return _anchors(gold, keys).select(*keys, S.iso(F.col("anchor")).alias("anchor"))


def _months(gold: DataFrame, anchors: DataFrame, first: int, last: int) -> DataFrame:
    """Gold of the months that any key's days anchor-first to anchor-last touch.

    Where Gold is stored by month, the scan then opens no other folder (dynamic partition
    pruning). The list is broadcast: it has a row for each calendar month at most.
    """
    if MONTH not in gold.columns:
        return gold
    begin, end = (F.trunc(F.date_sub("anchor", n), "month") for n in (first, last))
    wanted = (
        anchors.select(begin.alias("begin"), end.alias("end"))
        .distinct()
        .select(F.explode(F.sequence("begin", "end", F.expr("INTERVAL 1 MONTH"))).alias("month"))
        .select(S.month_number(F.col("month")).alias(MONTH))
        .distinct()
    )
    return gold.join(F.broadcast(wanted), MONTH, "left_semi")


def _one_row_per_day(gold: DataFrame, anchors: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Gold of the days anchor-first to anchor-last, without its weight, which is all that tells
    the rows of one day apart. `copies` keeps their number.

    All other days are dropped by the join with the anchors, before anything is aggregated or
    sorted. If Spark does not broadcast the anchors, a key's rows go to as many tasks as there
    are salts, by the task that read them: neither a hot key nor a hot day is gathered in one.
    The label is a grouping column, as it is the same in all rows of a day; the rest are
    numbers, which a hash aggregate holds.
    """
    salts = F.sequence(F.lit(0), F.lit(_SALTS - 1))
    bounds = anchors.withColumn("_salt", F.explode(salts)).hint("shuffle_hash")
    near = (
        keyed(_months(gold, anchors, first, last), keys)
        .select(*keys, S.day_column(gold).alias(DAY), *USED, F.pmod(F.spark_partition_id(), F.lit(_SALTS)).alias("_salt"))
        .join(bounds, [*keys, "_salt"])
        .where(F.col(DAY).between(F.date_sub("anchor", first), F.date_sub("anchor", last)))
    )
    numbers = [c for c in USED if c != "workout_type"]
    return near.groupBy(*keys, DAY, "workout_type").agg(
        *[F.max(c).alias(c) for c in numbers], F.count(F.lit(1)).alias("copies")
    )


def _days(gold: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Days anchor-first to anchor-last of each key, with the day's metrics where it has any."""
    anchors = _anchors(gold, keys)
    wanted = anchors.withColumn(
        DAY,
        F.explode(
            rows.days_between(F.date_sub("anchor", first), F.date_sub("anchor", last))
        ),
    )
    return wanted.join(_one_row_per_day(gold, anchors, keys, first, last), [*keys, DAY], "left")


def _as_week(days: DataFrame, keys: Sequence[str], *extra: str) -> DataFrame:
    """The published week columns. A missing day differs from a rest day: '-' and 0."""

    def rounded(name: str, digits: int) -> Column:
        return S.round_exact(F.col(name).cast("double"), digits)

    present = F.col("copies").isNotNull()
    return days.select(
        *keys,
        *extra,
        S.iso(F.col(DAY)).alias("fecha"),
        S.weekday_name(F.col(DAY)).alias("dia"),
        rounded("sleep_hours", 1).alias("sleep_h"),
        rounded("deep_minutes", 0).alias("deep_min"),
        rounded("rem_minutes", 0).alias("rem_min"),
        F.coalesce(F.col("steps").cast("int"), F.lit(0)).alias("steps"),
        rounded("active_kcal", 0).alias("kcal"),
        F.when(present, F.coalesce("workout_type", F.lit(K.REST_DAY)))
        .otherwise(K.ABSENT)
        .alias("workout"),
        F.coalesce(rounded("workout_minutes", 0), F.lit(0.0)).alias("w_min"),
        rounded("resting_hr", 1).alias("hr"),
        rounded("spo2_avg", 1).alias("spo2"),
    )


def week_rows(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exactly seven rows per anchored key, oldest first by `fecha`."""
    return _as_week(_days(gold, keys, 6, 0), keys)


def fortnight(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Both weeks in one pass over Gold: week rows of 14 days, `recent` marking the last seven.

    The unrounded steps and sleep and the count of Gold rows stay along for the prior week.
    """
    days = (
        _days(gold, keys, 13, 0)
        .withColumn("recent", F.col(DAY) >= F.date_sub("anchor", 6))
        .withColumn("gold_steps", F.col("steps"))
        .withColumn("gold_sleep", F.col("sleep_hours"))
    )
    return _as_week(days, keys, "recent", "gold_steps", "gold_sleep", "copies")


# --- statistics ------------------------------------------------------------------------

def _total(x: Column, digits: int) -> Column:
    """Sum through a decimal: exact, so it does not depend on the order of rows."""
    return F.sum(x.cast(f"decimal({16 + digits},{digits})")).cast("double")


def _mean_over(total: Column, n: Column, digits: int) -> Column:
    """Total per counted day, 0.0 where there is none."""
    return S.round_exact(F.coalesce(total, F.lit(0.0)) / F.greatest(n, F.lit(1)), digits)


def week_aggregates(of: Column) -> list[Column]:
    """Statistics of the rounded week rows for which `of` holds."""

    def only(name: str) -> Column:
        return F.when(of, F.col(name))

    slept = only("sleep_h")
    trained = of & ~F.col("workout").isin(K.ABSENT, K.REST_DAY)
    nights = F.count(slept)
    walked = F.sum(F.when(of & (F.col("steps") > 0), F.col("steps").cast("long")))
    return [
        F.coalesce(walked, F.lit(0)).cast("long").alias("total_steps"),
        F.count_if(trained).alias("training_days"),
        F.coalesce(_total(only("w_min"), 0), F.lit(0.0)).alias("training_minutes"),
        _mean_over(_total(slept, 1), nights, 2).alias("avg_sleep"),
        # Deep sleep is averaged over nights with sleep, not over nights with deep sleep.
        _mean_over(_total(F.when(slept.isNotNull(), F.col("deep_min")), 0), nights, 1).alias("avg_deep"),
        _mean_over(_total(only("hr"), 1), F.count(only("hr")), 1).alias("avg_hr"),
    ]


def prior_aggregates(of: Column) -> list[Column]:
    """Means over the Gold rows of the days for which `of` holds; NULL where there are none.

    Summed with six decimals; Gold has two at most.
    """

    def mean(name: str, digits: int) -> Column:
        value = F.when(of, F.col(name)).cast("decimal(18,6)")
        n = F.sum(F.when(value.isNotNull(), F.col("copies")))
        total = F.sum(value * F.col("copies").cast("decimal(18,0)")).cast("double")
        return S.round_half_even(total / n, digits)

    return [
        mean("gold_steps", 0).alias("prior_avg_steps"),
        mean("gold_sleep", 2).alias("prior_avg_sleep"),
    ]


def _grouped(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    # A global aggregate has a row even over nothing; without a week there is none.
    out = df.groupBy(*keys).agg(*aggregates, F.count(F.lit(1)).alias("_n"))
    return out.where("_n > 0").drop("_n")


def stats(week: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weekly totals and means, from the already rounded week rows."""
    return _grouped(week, keys, week_aggregates(F.lit(True)))


def prior_week(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean steps and sleep of the seven days before the week, over the rows that exist."""
    days = _days(gold, keys, 13, 7).select(
        *keys,
        F.col("steps").alias("gold_steps"),
        F.col("sleep_hours").alias("gold_sleep"),
        "copies",
    )
    return _grouped(days, keys, prior_aggregates(F.lit(True)))


def week_over_week(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Statistics of the week next to the means of the week before, in one pass."""
    recent = F.col("recent")
    return _grouped(
        fortnight(gold, keys), keys, [*week_aggregates(recent), *prior_aggregates(~recent)]
    )
