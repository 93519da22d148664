"""Every operator as a named query over a test-data folder."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymetrics import session
from daymetrics.functions import scalars as S
from daymetrics.functions import text as X
from daymetrics.operators import gold, quality, silver, weekly
from daymetrics.plans import daily_run, report
from daymetrics.sources import bronze, sample, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEYS = sample.KEYS
AS_OF = sample.AS_OF
DAY = silver.DAY


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


raw = sample.table


def sleep_inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    names = ["sleep_session_record_table", "sleep_stages_table"]
    return list(sample.bronze(spark, sf_dir, names).values())


def gold_plan(spark: SparkSession, sf_dir: str, keys=KEYS) -> DataFrame:
    """Gold straight from the raw tables: Silver stays in the plan, partitioned by (keys, day)."""
    return gold_of(sample.bronze(spark, sf_dir), keys)


def gold_of(records, keys=KEYS) -> DataFrame:
    clean = silver.run(records, AS_OF, keys, "row_id", iso=False)
    counts = silver.weight_counts(records["weight_record_table"], AS_OF, keys, "row_id")
    return gold.build(clean, keys, counts=counts, as_of=AS_OF)


def gold_table(spark: SparkSession, sf_dir: str, keys=KEYS) -> DataFrame:
    """Gold stored and read back, as a run does: the week reads it twice."""
    root = session.work_dir(spark)
    tables.overwrite(gold_plan(spark, sf_dir, keys), root, "gold", "daily_metrics")
    return tables.read(spark, root, "gold", "daily_metrics")


def stored_sources(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    """The raw tables written as an export, for the ingest operators."""
    root = session.work_dir(spark)
    frames = sample.bronze(spark, sf_dir)
    paths = {name: tables.path(root, "export", name) for name in frames}
    with ThreadPoolExecutor(len(frames)) as pool:
        list(pool.map(lambda name: frames[name].write.parquet(paths[name]), frames))
    return root, paths


# --- scalars ---------------------------------------------------------------------------

@query
def epoch_day_to_iso(spark, sf_dir):
    steps = raw(spark, sf_dir, "steps_record_table")
    return steps.select("user_id", "local_date", S.epoch_day_to_iso(F.col(DAY)).alias("day"), "count")


@query
def unit_and_rounding(spark, sf_dir):
    kg = S.thousandth(F.col("weight"))
    return raw(spark, sf_dir, "weight_record_table").select(
        "row_id",
        kg.alias("kg"),
        S.round_half_away(kg, 2).alias("half_away"),
        S.round_half_even(kg, 2).alias("half_even"),
        S.round_exact(S.round_half_even(kg, 2), 1).alias("exact"),
        S.to_int(kg * 2.0).alias("whole"),
    )


@query
def duration_units(spark, sf_dir):
    ms = F.col("end_time") - F.col("start_time")
    return raw(spark, sf_dir, "sleep_session_record_table").select(
        "row_id",
        S.ms_to_hours(ms).alias("hours"),
        S.ms_to_minutes(ms).alias("minutes"),
        S.round_exact(S.ms_to_hours(ms), 1).alias("hours_1"),
        S.round_half_away(S.ms_to_minutes(ms), 1).alias("minutes_1"),
    )


@query
def code_label(spark, sf_dir):
    exercise = raw(spark, sf_dir, "exercise_session_record_table")
    label = S.exercise_label(F.col("exercise_type")).alias("label")
    return exercise.select("user_id", "local_date", "start_time", "end_time", "exercise_type", label)


@query
def weekday_name(spark, sf_dir):
    steps = raw(spark, sf_dir, "steps_record_table")
    day = S.epoch_day(F.col(DAY))
    return steps.select("user_id", S.iso(day).alias("day"), S.weekday_name(day).alias("dia"), "count")


# --- filters and joins -----------------------------------------------------------------

@query
def source_filter(spark, sf_dir):
    steps = raw(spark, sf_dir, "steps_record_table")
    return silver.from_source(steps, silver.K.WATCH_SOURCE_ID).select("user_id", "local_date", "count")


@query
def sensor_filter_bpm(spark, sf_dir):
    return silver.plausible_rates(raw(spark, sf_dir, "resting_heart_rate_record_table"))


@query
def sensor_filter_spo2(spark, sf_dir):
    return silver.plausible_oxygen(raw(spark, sf_dir, "oxygen_saturation_record_table"))


@query
def stage_session_join(spark, sf_dir):
    sessions, stages = sleep_inputs(spark, sf_dir)
    return silver.with_sessions(stages, sessions, KEYS).select(
        "user_id", "parent_key", S.iso(F.col(DAY)).alias(DAY), "app_info_id", "stage_type", "stage_start_time", "stage_end_time"
    )


@query
def stage_minutes_pivot(spark, sf_dir):
    days = silver.sleep_days(*sleep_inputs(spark, sf_dir), KEYS).where("light_ms IS NOT NULL")
    return days.select(
        "user_id",
        S.iso(F.col(DAY)).alias("local_date"),
        *[S.ms_to_minutes(F.col(f"{n}_ms")).alias(f"{n}_minutes") for n in silver.STAGES],
    )


@query
def sleep_session_hours(spark, sf_dir):
    by_source = silver.sleep_by_source(raw(spark, sf_dir, "sleep_session_record_table"), KEYS)
    hours = S.ms_to_hours(F.col("sleep_ms")).alias("sleep_hours")
    return by_source.select("user_id", S.iso(F.col(DAY)).alias(DAY), "app_info_id", hours)


@query
def sleep_efficiency(spark, sf_dir):
    sleep = silver.sleep(*sleep_inputs(spark, sf_dir), KEYS)
    return sleep.select("user_id", "local_date", "sleep_efficiency")


# --- Silver ----------------------------------------------------------------------------

@query
def silver_sleep(spark, sf_dir):
    return silver.sleep(*sleep_inputs(spark, sf_dir), KEYS)


@query
def silver_sleep_watch_stages(spark, sf_dir):
    return silver.sleep(*sleep_inputs(spark, sf_dir), KEYS, filter_stages=True)


@query
def silver_steps(spark, sf_dir):
    return silver.steps(raw(spark, sf_dir, "steps_record_table"), KEYS)


@query
def silver_calories(spark, sf_dir):
    return silver.calories(raw(spark, sf_dir, "active_calories_burned_record_table"), KEYS)


@query
def silver_exercise(spark, sf_dir):
    return silver.exercise(raw(spark, sf_dir, "exercise_session_record_table"), keys=KEYS)


@query
def silver_heart_rate(spark, sf_dir):
    return silver.heart_rate(raw(spark, sf_dir, "resting_heart_rate_record_table"), KEYS)


@query
def silver_spo2(spark, sf_dir):
    return silver.spo2(raw(spark, sf_dir, "oxygen_saturation_record_table"), KEYS)


@query
def silver_weight(spark, sf_dir):
    return silver.weight(raw(spark, sf_dir, "weight_record_table"), AS_OF, KEYS, "row_id")


@query
def silver_weight_last(spark, sf_dir):
    weight = raw(spark, sf_dir, "weight_record_table")
    return silver.weight(weight, AS_OF, KEYS, "row_id", dedupe="last")


@query
def exercise_by_type(spark, sf_dir):
    by_type = silver.exercise_by_type(raw(spark, sf_dir, "exercise_session_record_table"), KEYS)
    return by_type.select(
        "user_id",
        S.iso(F.col(DAY)).alias("local_date"),
        "exercise_type",
        "workouts",
        S.ms_to_minutes(F.col("ms")).alias("workout_minutes"),
    )


@query
def dominant_workout(spark, sf_dir):
    by_type = silver.exercise_by_type(raw(spark, sf_dir, "exercise_session_record_table"), KEYS)
    top = F.col("top_type")
    return silver.exercise_days(by_type, KEYS).select(
        "user_id", S.iso(F.col(DAY)).alias("local_date"), top, S.exercise_label(top).alias("workout_type")
    )


@query
def weight_calendar(spark, sf_dir):
    weight = raw(spark, sf_dir, "weight_record_table")
    days = silver.weight_calendar(weight, AS_OF, KEYS, "row_id")
    return days.select("user_id", S.iso(F.col(DAY)).alias("local_date"), "has_reading")


@query
def weight_ffill(spark, sf_dir):
    weight = raw(spark, sf_dir, "weight_record_table")
    days = silver.weight_fill(weight, AS_OF, KEYS, "row_id")
    return days.select(
        "user_id",
        S.iso(F.col(DAY)).alias("local_date"),
        "weight_kg",
        S.iso(F.col("next_day")).alias("next_day"),
    )


# --- Gold ------------------------------------------------------------------------------

@query
def gold_spine(spark, sf_dir):
    clean = silver.run(sample.bronze(spark, sf_dir), AS_OF, KEYS, "row_id", iso=False)
    return gold.spine(clean, KEYS).select("user_id", S.iso(F.col(DAY)).alias("local_date"), "steps", "sleep_hours")


@query
def gold_daily_metrics(spark, sf_dir):
    return gold_plan(spark, sf_dir)


@query
def gold_single_series(spark, sf_dir):
    return gold_plan(spark, sf_dir, ())


@query
def gold_duplicate_days(spark, sf_dir):
    return quality.duplicate_keys(gold_plan(spark, sf_dir), KEYS)


@query
def gold_duplicate_count(spark, sf_dir):
    return quality.duplicate_count(gold_plan(spark, sf_dir), KEYS)


@query
def undated_rows(spark, sf_dir):
    return quality.undated_by_table(sample.edges(spark, sf_dir))


@query
def keyless_rows(spark, sf_dir):
    return quality.keyless_by_table(sample.edges(spark, sf_dir), KEYS)


# --- the same operators over records with edge cases -----------------------------------

def _silver_edges(table: str) -> Query:
    def run(spark, sf_dir):
        return silver.plans(sample.edges(spark, sf_dir), AS_OF, KEYS, "row_id")[table]()

    run.__name__ = f"silver_{table}_edges"
    return run


for _table in ("sleep", "steps", "calories", "exercise", "heart_rate", "spo2", "weight"):
    query(_silver_edges(_table))


@query
def silver_calories_extremes(spark, sf_dir):
    return silver.calories(sample.extremes(spark, sf_dir, "active_calories_burned_record_table"), KEYS)


@query
def silver_spo2_extremes(spark, sf_dir):
    return silver.spo2(sample.extremes(spark, sf_dir, "oxygen_saturation_record_table"), KEYS)


@query
def dominant_workout_ties(spark, sf_dir):
    by_type = silver.exercise_by_type(sample.edges(spark, sf_dir)["exercise_session_record_table"], KEYS)
    top = F.col("top_type")
    return silver.exercise_days(by_type, KEYS).select(
        "user_id", S.iso(F.col(DAY)).alias(DAY), top, S.exercise_label(top).alias("workout_type")
    )


@query
def gold_edges(spark, sf_dir):
    return gold_of(sample.edges(spark, sf_dir))


def _edges_table(spark, sf_dir) -> DataFrame:
    root = session.work_dir(spark)
    tables.overwrite(gold_edges(spark, sf_dir), root, "gold", "daily_metrics")
    return tables.read(spark, root, "gold", "daily_metrics")


@query
def week_rows_edges(spark, sf_dir):
    return weekly.week_rows(_edges_table(spark, sf_dir), KEYS)


@query
def week_over_week_edges(spark, sf_dir):
    return weekly.week_over_week(_edges_table(spark, sf_dir), KEYS)


@query
def report_summary_edges(spark, sf_dir):
    return report.summary_text(_edges_table(spark, sf_dir), KEYS)


# --- stored Gold -----------------------------------------------------------------------

@query
def stored_gold_order(spark, sf_dir):
    """Rows of stored Gold, and how many of its files begin before the one before them ends."""
    root = session.work_dir(spark)
    tables.overwrite(gold_plan(spark, sf_dir), root, "gold", "daily_metrics", [*KEYS, DAY])
    return quality.file_order(tables.read(spark, root, "gold", "daily_metrics"), [*KEYS, DAY])


@query
def gold_sql_view(spark, sf_dir):
    tables.as_views({"daily_metrics": gold_table(spark, sf_dir)}, "gold_")
    return spark.sql(
        "SELECT local_date, count(*) AS rows, sum(steps) AS steps, sum(is_workout_day) AS workouts"
        " FROM gold_daily_metrics GROUP BY local_date"
    )


# --- week ------------------------------------------------------------------------------

@query
def week_anchor(spark, sf_dir):
    return weekly.anchor(gold_plan(spark, sf_dir), KEYS)


@query
def week_rows(spark, sf_dir):
    return weekly.week_rows(gold_table(spark, sf_dir), KEYS)


@query
def week_stats(spark, sf_dir):
    return weekly.stats(weekly.week_rows(gold_table(spark, sf_dir), KEYS), KEYS)


@query
def prior_week_stats(spark, sf_dir):
    return weekly.prior_week(gold_table(spark, sf_dir), KEYS)


@query
def week_over_week(spark, sf_dir):
    return weekly.week_over_week(gold_table(spark, sf_dir), KEYS)


@query
def week_rows_single_series(spark, sf_dir):
    return weekly.week_rows(gold_table(spark, sf_dir, ()))


# --- report ----------------------------------------------------------------------------

@query
def report_day_text(spark, sf_dir):
    week = weekly.week_rows(gold_table(spark, sf_dir), KEYS)
    return report.day_text(week).select("user_id", "fecha", "text")


@query
def report_week_text(spark, sf_dir):
    return report.week_text(weekly.week_rows(gold_table(spark, sf_dir), KEYS), KEYS)


@query
def report_summary_text(spark, sf_dir):
    return report.summary_text(gold_table(spark, sf_dir), KEYS)


@query
def report_messages(spark, sf_dir):
    """Parts of 400 characters, so that a week's message takes several."""
    return report.messages(report.run(gold_table(spark, sf_dir), KEYS), KEYS, size=400)


# --- text ------------------------------------------------------------------------------

@query
def text_strip_markup(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", X.strip_markup(F.col("html")).alias("content"))


@query
def text_strip_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", X.strip_markup(F.col("text")).alias("content"))


@query
def text_strip_edges(spark, sf_dir):
    """The documents in a code fence, followed by blank lines, a tag and bold marks."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tail = F.concat(F.lit("\n```\n\n \t\n\n**<b>"), F.col("doc_id"), F.lit("</b>** \n\n\n"))
    fenced = F.concat(F.lit("```python\n"), F.col("text"), tail)
    return documents.select("doc_id", X.strip_markup(fenced).alias("content"))


@query
def text_chunks(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return X.chunk(documents, "text")


@query
def analysis_messages(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return report.analysis_messages(documents, "text")


# --- ingest and the whole run ----------------------------------------------------------

@query
def bronze_status(spark, sf_dir):
    root, sources = stored_sources(spark, sf_dir)
    return bronze.load(spark, sources, root).drop("malformed")


@query
def bronze_malformed_rows(spark, sf_dir):
    """Steps from CSV and energy from JSON with damaged records among them: what was loaded, and what not."""
    root = session.work_dir(spark)
    damaged = (F.col("user_id") + F.col(DAY)) % 10 == 0
    steps, energy = raw(spark, sf_dir, "steps_record_table"), raw(spark, sf_dir, "active_calories_burned_record_table")
    line = F.concat_ws(",", "user_id", DAY, "app_info_id", F.concat(F.when(damaged, "x").otherwise(""), "count"))
    steps.select(line.alias("value")).write.text(f"{root}/export/steps")
    whole = F.format_string('{"user_id":%d,"local_date":%d,"app_info_id":%d,"energy":%d', "user_id", DAY, "app_info_id", F.col("energy").cast("long"))
    energy.select(F.concat(whole, F.when(damaged, "").otherwise("}")).alias("value")).write.text(f"{root}/export/energy")
    sources = {
        "steps_record_table": bronze.Source(f"{root}/export/steps", "csv", {}, steps.schema),
        "active_calories_burned_record_table": bronze.Source(f"{root}/export/energy", "json", {}, energy.schema),
    }
    status = bronze.load(spark, sources, root).where("error IS NULL").select("source_table", "rows", "malformed")
    return status.join(bronze.malformed(spark, root), "source_table", "left")


@query
def bronze_status_broken(spark, sf_dir):
    """Three of the sources fail: one is not there, one lacks columns, one is not named."""
    root, sources = stored_sources(spark, sf_dir)
    sources["sleep_stages_table"] = sources["steps_record_table"]
    sources["steps_record_table"] = f"{root}/nowhere"
    del sources["weight_record_table"]
    failed = F.col("error").isNotNull().alias("failed")
    return bronze.load(spark, sources, root).select("source_table", "rows", failed)


@query
def bronze_text_formats(spark, sf_dir):
    """Steps from a CSV export and calories from a JSON export, each read with its schema."""
    root = session.work_dir(spark)
    sources = {}
    for name, fmt, options in (
        ("steps_record_table", "csv", {"header": "true"}),
        ("active_calories_burned_record_table", "json", {}),
    ):
        frame = raw(spark, sf_dir, name)
        frame.write.format(fmt).options(**options).save(f"{root}/export/{name}")
        sources[name] = bronze.Source(f"{root}/export/{name}", fmt, options, frame.schema)
    bronze.load(spark, sources, root)
    loaded = bronze.read(spark, root)
    steps = silver.steps(loaded["steps_record_table"], KEYS)
    calories = silver.calories(loaded["active_calories_burned_record_table"], KEYS)
    return steps.join(calories, [*KEYS, DAY], "full_outer")


@query
def latest_snapshot(spark, sf_dir):
    """Steps of the newer of two exports: first the other sources' records, then all of them."""
    steps = raw(spark, sf_dir, "steps_record_table")
    exports = f"{session.work_dir(spark)}/exports"
    steps.where(F.col("app_info_id") != silver.K.WATCH_SOURCE_ID).write.parquet(f"{exports}/week_1")
    steps.write.parquet(f"{exports}/week_2")
    newest = bronze.latest_path(spark, exports, "*.parquet", folders=True)
    return silver.steps(spark.read.parquet(newest), KEYS)


def _full_run(spark, sf_dir) -> daily_run.Result:
    root, sources = stored_sources(spark, sf_dir)
    return daily_run.run(spark, sources, root, AS_OF, KEYS, "row_id")


@query
def full_run_report(spark, sf_dir):
    return _full_run(spark, sf_dir).report


@query
def full_run_status(spark, sf_dir):
    return _full_run(spark, sf_dir).status


@query
def run_lenient_status(spark, sf_dir):
    """A source is missing and nothing was stored before: an empty table stands in, and says so."""
    root, sources = stored_sources(spark, sf_dir)
    del sources["oxygen_saturation_record_table"]
    result = daily_run.run(spark, sources, root, AS_OF, KEYS, "row_id", strict=False)
    failed = F.col("error").isNotNull().alias("failed")
    return result.status.select("layer", "table_name", "rows", failed, "stood_in")
