"""The weekly report as text columns, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics import constants as K
from daymetrics.functions import scalars as S
from daymetrics.functions import text as X
from daymetrics.operators import weekly


def _or(x: Column, default: str) -> Column:
    return F.coalesce(x, F.lit(default))


def _day_block(day: Column | None = None) -> Column:
    """The text of one week row, given as a struct or as the columns of the same names."""

    def col(name: str) -> Column:
        return F.col(name) if day is None else day[name]

    num = {c: X.number_text(col(c)) for c in ["sleep_h", "deep_min", "rem_min", "kcal", "w_min", "hr", "spo2"]}
    weekend = col("dia").isin(K.WEEKEND_NAMES)
    values = {
        "day_symbol": F.when(weekend, K.WEEKEND_SYMBOL).otherwise(K.WEEKDAY_SYMBOL),
        "dia": col("dia"),
        "fecha": col("fecha"),
        "sleep_h": _or(num["sleep_h"], K.ABSENT),
        "deep_min": _or(num["deep_min"], K.ABSENT),
        "rem_min": _or(num["rem_min"], K.ABSENT),
        "steps": col("steps").cast("string"),
        "kcal": _or(num["kcal"], K.ABSENT),
        "workout_symbol": S.lookup(col("workout"), K.WORKOUT_SYMBOLS, K.DEFAULT_WORKOUT_SYMBOL),
        "workout": col("workout"),
        # A missing day shows the whole number 0, a rest day 0.0.
        "w_min": F.when(col("workout") == K.ABSENT, "0").otherwise(num["w_min"]),
        "hr": _or(F.concat(num["hr"], F.lit(" bpm")), K.NO_READING),
        "spo2": _or(F.concat(num["spo2"], F.lit("%")), K.NO_READING),
    }
    return X.template(K.DAY_BLOCK, values)


def day_text(week: DataFrame) -> DataFrame:
    """Each week row with its text block."""
    return week.withColumn("text", _day_block())


def _week_days(of: Column) -> Column:
    """The week rows of a key as values, oldest first; seven of them, so the list is bounded."""
    return F.sort_array(F.collect_list(F.when(of, F.struct(*weekly.WEEK))))


def _table(days: Column) -> Column:
    """Title and day blocks: text is made only here, after the rows of a key have met."""
    return F.concat_ws("\n", F.lit(K.DAY_TABLE_TITLE), F.transform(days, _day_block))


def _bounds(of: Column) -> list[Column]:
    fecha = F.when(of, F.col("fecha"))
    return [F.min(fecha).alias("fecha_inicio"), F.max(fecha).alias("fecha_fin")]


def week_text(week: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The seven blocks of a key joined under the title, with the week's bounds."""
    every = F.lit(True)
    out = week.groupBy(*keys).agg(*_bounds(every), _week_days(every).alias("_days"))
    return out.where("fecha_fin IS NOT NULL").select(
        *keys, "fecha_inicio", "fecha_fin", _table(F.col("_days")).alias("tabla")
    )


def _summary_block() -> Column:
    minutes = F.col("training_minutes")
    values = {c: F.col(c) for c in ["fecha_inicio", "fecha_fin", "tabla"]}
    values |= {c: F.col(c).cast("string") for c in ["total_steps", "training_days"]}
    values |= {c: X.number_text(F.col(c)) for c in ["avg_deep", "avg_hr"]}
    values |= {
        "avg_sleep": X.number_text(F.col("avg_sleep"), 2),
        "training_minutes": F.when(minutes == 0, "0").otherwise(X.number_text(minutes)),
        "prior_avg_steps": _or(X.number_text(F.col("prior_avg_steps")), K.NOT_AVAILABLE),
        "prior_avg_sleep": _or(X.number_text(F.col("prior_avg_sleep"), 2), K.NOT_AVAILABLE),
    }
    return X.template(K.SUMMARY_BLOCK, values)


def run(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Week bounds, day table and summary text of every key, from one pass over Gold."""
    recent = F.col("recent")
    out = (
        weekly.fortnight(gold, keys)
        .groupBy(*keys)
        .agg(
            *_bounds(recent),
            _week_days(recent).alias("_days"),
            *weekly.week_aggregates(recent),
            *weekly.prior_aggregates(~recent),
        )
        .where("fecha_fin IS NOT NULL")
        .withColumn("tabla", _table(F.col("_days")))
    )
    return out.select(
        *keys, "fecha_inicio", "fecha_fin", "tabla", _summary_block().alias("summary")
    )


def summary_text(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The week's data, statistics and comparison as one text per key."""
    return run(gold, keys).select(*keys, "summary")


def messages(report: DataFrame, keys: Sequence[str] = (), size: int = K.MESSAGE_SIZE) -> DataFrame:
    """The week table under its header, cut into numbered parts of at most `size` characters."""
    values = {c: F.col(c) for c in ["fecha_inicio", "fecha_fin", "tabla"]}
    full = report.select(*keys, X.template(K.WEEK_MESSAGE, values).alias("message"))
    return X.chunk(full, "message", size)


def analysis_messages(df: DataFrame, col: str, size: int = K.MESSAGE_SIZE) -> DataFrame:
    """An expert's answer, cleaned of markup, under its header and cut into parts."""
    answer = {"analysis": X.strip_markup(F.col(col))}
    return X.chunk(df.withColumn(col, X.template(K.ANALYSIS_MESSAGE, answer)), col, size)
