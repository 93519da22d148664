"""The whole weekly job: raw tables to Bronze, Silver, Gold and the report."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from daymetrics import schemas
from daymetrics.operators import gold, quality, silver
from daymetrics.plans import report
from daymetrics.sources import bronze, tables

logger = logging.getLogger(__name__)

STATUS = "layer STRING, table_name STRING, rows BIGINT, error STRING, stood_in STRING"
#: What stands in for a table that failed in a lenient run.
LAST_RUN, EMPTY = "last run", "empty"


@dataclass(frozen=True)
class Result:
    """What a run leaves: a status row per table, the checks, the report per key."""

    status: DataFrame
    duplicates: DataFrame
    undated: DataFrame
    report: DataFrame


def _empty_silver(spark: SparkSession, table: str, raw: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    schema = schemas.SILVER[table]
    typed = next(iter(raw.values())).select(*keys).schema if keys else []
    return spark.createDataFrame([], type(schema)([*typed, *schema]))


def run(
    spark: SparkSession,
    sources: Mapping[str, bronze.Source | str],
    target: str,
    as_of: date | str,
    keys: Sequence[str] = (),
    tie_break: str | None = None,
    strict: bool = True,
    parallel: int = 8,
) -> Result:
    """Load, clean, join and report; every layer is stored below `target` and rewritten in full.

    `strict` stops at the first table that fails. Otherwise the failure goes into the status,
    and the last published version of that table, or an empty one, stands in; `stood_in` says
    which. A layer's new versions are published together once all its tables are written.
    """
    status: list[tuple[str, str, int | None, str | None, str | None]] = []

    def check() -> None:
        failed = [f"{layer}.{t}: {error}" for layer, t, _, error, _ in status if error]
        if strict and failed:
            raise RuntimeError("; ".join(failed))

    # Eight rows at most.
    loaded = bronze.load(spark, sources, target, parallel).collect()
    raw = bronze.read(spark, target)
    for r in loaded:
        there = LAST_RUN if r.source_table in raw else EMPTY
        status.append(("bronze", r.source_table, r.rows, r.error, there if r.error else None))
        if r.malformed:
            logger.warning("%d malformed records in %s", r.malformed, r.source_table)
    check()
    if not raw:
        raise RuntimeError("no raw table has been loaded yet")

    def store(layer: str, made: Mapping[str, Callable[[], DataFrame]], sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()):
        """Write a layer's tables a few at a time, publish them, and return their current paths."""

        def one(table: str):
            try:
                return table, tables.write(made[table](), target, layer, table, sort_by, partition_by), None
            except Exception as error:  # noqa: BLE001 - isolated per table, reported
                return table, None, bronze.first_line(error)

        with ThreadPoolExecutor(parallel) as pool:
            done = list(pool.map(one, made))
        tables.publish(spark, target, [version for _, version, _ in done if version])
        now = tables.current(spark, target, layer)
        for table, version, error in done:
            there = LAST_RUN if (layer, table) in now else EMPTY
            status.append((layer, table, version.rows if version else None, error, there if error else None))
        check()
        return {table: now[layer, table] for table in made if (layer, table) in now}

    plans = silver.plans(raw, as_of, keys, tie_break)
    stored = store("silver", plans, [*keys, "local_date"])
    clean = {t: spark.read.parquet(stored[t]) if t in stored else _empty_silver(spark, t, raw, keys) for t in plans}
    made = {"daily_metrics": lambda: gold.by_month(gold.build(clean, keys))}
    stored = store("gold", made, [*keys, "local_date"], [gold.MONTH])
    if not stored:
        raise RuntimeError("Gold has never been built")
    daily = spark.read.parquet(stored["daily_metrics"])
    repeated = quality.duplicate_count(daily, keys).first()["duplicate_days"]
    if repeated:
        logger.warning("%d days have several rows in Gold", repeated)
    stored = store("report", {"weekly": lambda: report.run(daily, keys)})
    if not stored:
        raise RuntimeError("the report has never been built")
    return Result(
        spark.createDataFrame(status, STATUS),
        quality.duplicate_keys(daily, keys),
        quality.undated_by_table(raw),
        spark.read.parquet(stored["weekly"]),
    )
