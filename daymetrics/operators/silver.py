"""Silver: raw records to one clean daily table per metric.

Every operator groups by `keys` plus the day. `keys=()` treats the whole table as one
person's series; `keys=["user_id"]` runs a population. Durations are summed as whole
milliseconds and divided once, so no result depends on the order of rows.

The day stays a DATE up to the last projection. With `iso=True` (the default) it is
published as 'YYYY-MM-DD' text; `iso=False` keeps the DATE, and with it the hash
partitioning on (keys, day) that Gold builds on without another shuffle.

Records without a date or without a key belong to no series and are dropped, in every
operator alike (`quality.undated` and `quality.keyless` count them).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymetrics import constants as K
from daymetrics.functions import rows
from daymetrics.functions import scalars as S

DAY = "local_date"


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The records that have every key."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def _dated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keyed(df, keys).where(F.col(DAY).isNotNull()).withColumn(DAY, S.epoch_day(F.col(DAY)))


def _publish(df: DataFrame, keys: Sequence[str], iso: bool, **measures: Column) -> DataFrame:
    day = S.iso(F.col(DAY)).alias(DAY) if iso else F.col(DAY)
    return df.select(*keys, day, *[c.alias(n) for n, c in measures.items()])


def from_source(df: DataFrame, source_id: int) -> DataFrame:
    return df.where(F.col("app_info_id") == source_id)


def _duration(start: str, end: str) -> Column:
    return F.col(end) - F.col(start)


# --- sleep -----------------------------------------------------------------------------

STAGES = {
    "light": K.STAGE_LIGHT,
    "deep": K.STAGE_DEEP,
    "rem": K.STAGE_REM,
    "awake": K.STAGE_AWAKE,
}


def stage_totals(stages: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Milliseconds per stage kind and session: the conditional-sum pivot, before any join."""
    ms = _duration("stage_start_time", "stage_end_time")
    return keyed(stages, keys).groupBy(*keys, "parent_key").agg(
        *[
            F.sum(F.when(F.col("stage_type") == code, ms).otherwise(0)).alias(f"{name}_ms")
            for name, code in STAGES.items()
        ]
    )


def with_sessions(
    children: DataFrame, sessions: DataFrame, keys: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Rows that name a session in `parent_key`, next to their dated session.

    `how="left"` keeps sessions without such a row.
    """
    parents = _dated(sessions, keys).withColumnRenamed("row_id", "parent_key")
    return parents.join(keyed(children, keys), [*keys, "parent_key"], how)


def sessions_with_stages(
    sessions: DataFrame, stages: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Every dated session with its stage totals, NULL where it has none.

    Stages shrink to one row per session first; that aggregate leaves them partitioned the
    way the join needs them, so the stage table crosses the network once, pre-aggregated.
    """
    return with_sessions(stage_totals(stages, keys), sessions, keys, "left")


def _asleep(of: Column) -> Column:
    return F.sum(F.when(of, _duration("start_time", "end_time")))


def sleep_by_source(sessions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Milliseconds asleep per day and recording source."""
    return _dated(sessions, keys).groupBy(*keys, DAY, "app_info_id").agg(_asleep(F.lit(True)).alias("sleep_ms"))


def sleep_days(
    sessions: DataFrame,
    stages: DataFrame,
    keys: Sequence[str] = (),
    source_id: int = K.WATCH_SOURCE_ID,
    filter_stages: bool = False,
) -> DataFrame:
    """Milliseconds asleep and per stage, one row per day, nothing rounded or filtered yet.

    Only the watch's sessions count as sleep, but stages of any source's session on that day
    are added unless `filter_stages`. One pass serves both: a day the watch did not record
    has a NULL sleep sum and falls to the minimum-sleep filter.
    """
    watch = F.col("app_info_id") == source_id
    joined = sessions_with_stages(sessions, stages, keys)
    if filter_stages:
        joined = joined.where(watch)
    return joined.groupBy(*keys, DAY).agg(
        _asleep(watch).alias("sleep_ms"),
        *[F.sum(f"{name}_ms").alias(f"{name}_ms") for name in STAGES],
    )


def sleep(
    sessions: DataFrame,
    stages: DataFrame,
    keys: Sequence[str] = (),
    source_id: int = K.WATCH_SOURCE_ID,
    min_hours: float = K.MIN_SLEEP_HOURS,
    filter_stages: bool = False,
    iso: bool = True,
) -> DataFrame:
    """Hours asleep, minutes per stage and efficiency; days under `min_hours` drop out."""
    hours = S.ms_to_hours(F.col("sleep_ms"))
    minutes = {name: S.ms_to_minutes(F.col(f"{name}_ms")) for name in STAGES}
    days = sleep_days(sessions, stages, keys, source_id, filter_stages)
    return _publish(
        days.where(hours >= min_hours),
        keys,
        iso,
        sleep_hours=S.round_half_away(hours, 2),
        light_minutes=S.round_half_away(minutes["light"], 1),
        deep_minutes=S.round_half_away(minutes["deep"], 1),
        rem_minutes=S.round_half_away(minutes["rem"], 1),
        awake_minutes=S.round_half_away(minutes["awake"], 1),
        sleep_efficiency=S.sleep_efficiency(hours, minutes["awake"]),
    )


# --- single-table sums and extremes ------------------------------------------------------

def steps(
    df: DataFrame,
    keys: Sequence[str] = (),
    source_id: int = K.WATCH_SOURCE_ID,
    iso: bool = True,
) -> DataFrame:
    """Steps per day from the watch; a day of zero steps is a day not worn."""
    days = _dated(from_source(df, source_id), keys).groupBy(*keys, DAY).agg(F.sum("count").alias("n"))
    return _publish(days.where("n > 0"), keys, iso, steps=S.to_int(F.col("n")))


def calories(
    df: DataFrame,
    keys: Sequence[str] = (),
    source_id: int = K.WATCH_SOURCE_ID,
    iso: bool = True,
) -> DataFrame:
    """Active energy per day from the watch, in thousands of the raw unit.

    The sum does not depend on the order of rows; a reading that is not a number makes the day's
    energy none, as it does in SQL.
    """
    energy = S.exact_sum(F.col("energy"))
    days = _dated(from_source(df, source_id), keys).groupBy(*keys, DAY).agg(energy.alias("e"))
    return _publish(
        days, keys, iso, active_kcal=S.round_half_away(S.thousandth(F.col("e")), 1)
    )


def plausible_rates(df: DataFrame, max_bpm: float = K.MAX_RESTING_BPM) -> DataFrame:
    return df.where(F.col("beats_per_minute") <= max_bpm)


def plausible_oxygen(df: DataFrame, min_pct: float = K.MIN_SPO2_PERCENT) -> DataFrame:
    return df.where(F.col("percentage") >= min_pct)


def heart_rate(
    df: DataFrame,
    keys: Sequence[str] = (),
    max_bpm: float = K.MAX_RESTING_BPM,
    iso: bool = True,
) -> DataFrame:
    """Lowest plausible resting rate of the day."""
    low = F.min("beats_per_minute").alias("low")
    days = _dated(plausible_rates(df, max_bpm), keys).groupBy(*keys, DAY).agg(low)
    return _publish(days, keys, iso, resting_hr=S.to_int(F.col("low")))


def spo2(
    df: DataFrame,
    keys: Sequence[str] = (),
    min_pct: float = K.MIN_SPO2_PERCENT,
    iso: bool = True,
) -> DataFrame:
    """Mean (two decimals) and minimum (as read) of the plausible oxygen readings.

    A reading that is not a number is above every minimum, counts, and makes the mean none.
    """
    pct = F.col("percentage")
    mean = S.exact_sum(pct) / F.count(pct)
    days = (
        _dated(plausible_oxygen(df, min_pct), keys)
        .groupBy(*keys, DAY)
        .agg(mean.alias("mean"), F.min(pct).alias("low"))
    )
    return _publish(
        days, keys, iso, spo2_avg=S.round_half_away(F.col("mean"), 2), spo2_min=F.col("low")
    )


# --- exercise --------------------------------------------------------------------------

def exercise_by_type(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Workouts and milliseconds per day and exercise code."""
    return (
        _dated(df, keys)
        .groupBy(*keys, DAY, "exercise_type")
        .agg(
            F.count(F.lit(1)).alias("workouts"),
            F.sum(_duration("start_time", "end_time")).alias("ms"),
        )
    )


def _dominance() -> Column:
    """Orders the codes of a day: most minutes first, then the smaller code.

    Packed into one decimal because a number, unlike a struct, keeps max_by in the hash
    aggregate. A code without any duration comes last, a missing code after every code.
    """
    ms = F.coalesce("ms", F.lit(-(2**63))).cast("decimal(20,0)")
    code = F.coalesce(F.col("exercise_type").cast("long"), F.lit(2**31)).cast("decimal(12,0)")
    return ms * F.lit(2**33).cast("decimal(12,0)") - code


def exercise_days(by_type: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Workouts, milliseconds and the code with the most minutes, one row per day."""
    return by_type.groupBy(*keys, DAY).agg(
        F.sum("workouts").alias("workouts"),
        F.coalesce(F.sum("ms"), F.lit(0)).alias("ms"),
        F.max_by("exercise_type", _dominance()).alias("top_type"),
    )


def exercise(
    df: DataFrame,
    labels: Mapping[int, str] = K.EXERCISE_LABELS,
    keys: Sequence[str] = (),
    iso: bool = True,
) -> DataFrame:
    """Workouts, minutes and the label of the day's dominant kind. Every source counts."""
    return _publish(
        exercise_days(exercise_by_type(df, keys), keys),
        keys,
        iso,
        workouts=S.to_int(F.col("workouts")),
        workout_minutes=S.round_half_away(S.ms_to_minutes(F.col("ms")), 1),
        workout_type=S.exercise_label(F.col("top_type"), labels),
    )


# --- weight ----------------------------------------------------------------------------

def weight_counts(
    df: DataFrame, as_of: date | str, keys: Sequence[str] = (), tie_break: str | None = None
) -> DataFrame:
    """Equal readings of a day as one row: weight_kg (NULL for empty ones), `copies`, `_order`.

    The one aggregate over the raw readings, combined before its shuffle. `_order` is the
    greatest `tie_break` (default: weight) among them.
    """
    kg = S.round_half_even(S.thousandth(F.col("weight")), 2)
    counts = (
        _dated(df, keys)
        .where(F.col(DAY) <= S.day_literal(as_of))
        .groupBy(*keys, DAY, kg.alias("weight_kg"))
        .agg(F.count(F.lit(1)).alias("copies"), F.max(tie_break or "weight").alias("_order"))
    )
    # Always true, yet it keeps both columns in every use of the counts: their plans are then
    # the same, and Spark runs the aggregate and its scan once.
    return counts.where((F.col("copies") > 0) | F.col("_order").isNotNull())


def closing_weights(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per day with a reading: its last weight, NULL if all are empty."""
    last = F.when(F.col("weight_kg").isNotNull(), F.col("_order"))
    return counts.groupBy(*keys, DAY).agg(F.max_by("weight_kg", last).alias("closing"))


def _fill(counts: DataFrame, as_of: date | str, keys: Sequence[str]) -> DataFrame:
    series = Window.partitionBy(*keys).orderBy(DAY)
    carried = F.last("closing", ignorenulls=True).over(
        series.rowsBetween(Window.unboundedPreceding, 0)
    )
    end = F.date_add(S.day_literal(as_of), 1)
    next_day = F.coalesce(F.lead(DAY).over(series), end)
    return closing_weights(counts, keys).select(
        *keys, DAY, carried.alias("weight_kg"), next_day.alias("next_day")
    )


def weight_fill(
    df: DataFrame, as_of: date | str, keys: Sequence[str] = (), tie_break: str | None = None
) -> DataFrame:
    """One row per day that has a reading: the weight to carry on, and the next such day.

    `weight_kg` is the day's last reading, or the last one before it where the day holds only
    empty readings; `next_day` ends the carry (the day after `as_of` for the last row).
    Readings shrink to one row per day before the window, so a window partition is as long
    as the key's count of days, however many readings it has.
    """
    return _fill(weight_counts(df, as_of, keys, tie_break), as_of, keys)


def _calendar(counts: DataFrame, as_of: date | str, keys: Sequence[str]) -> DataFrame:
    return (
        _fill(counts, as_of, keys)
        .withColumn("_day", F.explode(rows.days_between(F.col(DAY), F.date_sub("next_day", 1))))
        .select(*keys, F.col("_day").alias(DAY), "weight_kg", (F.col("_day") == F.col(DAY)).alias("has_reading"))
    )


def weight_calendar(
    df: DataFrame, as_of: date | str, keys: Sequence[str] = (), tie_break: str | None = None
) -> DataFrame:
    """Every day from a key's first reading to `as_of`, one row each, with the carried weight."""
    return _calendar(weight_counts(df, as_of, keys, tie_break), as_of, keys)


def weighed(days: DataFrame, counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`days` (one row a day, weight_kg carried on) with the day's own readings, each row `copies`
    times: a day without a reading has its carried weight once, an empty reading takes it."""
    own = counts.select(*keys, DAY, F.col("weight_kg").alias("_own"), "copies", "_order")
    joined = days.join(own, [*keys, DAY], "left").withColumns(
        {
            "weight_kg": F.coalesce("_own", "weight_kg"),
            "_copies": F.coalesce("copies", F.lit(1).cast("long")),
        }
    )
    return rows.repeat_rows(
        joined.drop("_own", "copies", "_order"), "_copies", [*keys, DAY, "weight_kg"]
    )


def weight(
    df: DataFrame,
    as_of: date | str,
    keys: Sequence[str] = (),
    tie_break: str | None = None,
    dedupe: str | None = None,
    iso: bool = True,
) -> DataFrame:
    """Kilograms for every day from the first reading to `as_of`, the last known one carried on.

    Several readings in a day give several rows, as read; `dedupe="last"` keeps the day's last.
    `tie_break` names the column that orders readings within a day and is unique there;
    without it the heaviest reading is the last. An empty reading takes the day's last weight.
    """
    counts = weight_counts(df, as_of, keys, tie_break)
    daily = _calendar(counts, as_of, keys).select(*keys, DAY, "weight_kg")
    if dedupe is None:
        daily = weighed(daily, counts, keys)
    elif dedupe != "last":
        raise ValueError(f"dedupe is 'last' or None, not {dedupe!r}")
    return _publish(daily, keys, iso, weight_kg=F.col("weight_kg"))


# --- all seven -------------------------------------------------------------------------

def plans(
    bronze: Mapping[str, DataFrame],
    as_of: date | str,
    keys: Sequence[str] = (),
    tie_break: str | None = None,
    iso: bool = True,
) -> dict[str, Callable[[], DataFrame]]:
    """How to make each of the seven tables, so that one that fails leaves the others."""
    return {
        "sleep": lambda: sleep(
            bronze["sleep_session_record_table"], bronze["sleep_stages_table"], keys, iso=iso
        ),
        "steps": lambda: steps(bronze["steps_record_table"], keys, iso=iso),
        "calories": lambda: calories(bronze["active_calories_burned_record_table"], keys, iso=iso),
        "exercise": lambda: exercise(bronze["exercise_session_record_table"], keys=keys, iso=iso),
        "heart_rate": lambda: heart_rate(bronze["resting_heart_rate_record_table"], keys, iso=iso),
        "spo2": lambda: spo2(bronze["oxygen_saturation_record_table"], keys, iso=iso),
        "weight": lambda: weight(bronze["weight_record_table"], as_of, keys, tie_break, iso=iso),
    }


def run(
    bronze: Mapping[str, DataFrame],
    as_of: date | str,
    keys: Sequence[str] = (),
    tie_break: str | None = None,
    iso: bool = True,
) -> dict[str, DataFrame]:
    """The seven Silver tables of a set of raw tables."""
    return {t: make() for t, make in plans(bronze, as_of, keys, tie_break, iso).items()}
