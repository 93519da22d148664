import time

import pytest
from pyspark.sql import functions as F

from daymetrics import constants as K
from daymetrics import session
from daymetrics.operators import gold, silver, weekly
from daymetrics.plans import daily_run, report
from daymetrics.sources import bronze, sample, tables

SF = "/root/testdata/sf0.001"
KEYS = ["user_id"]


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    """The raw tables as an export: one folder per table."""
    root = str(tmp_path_factory.mktemp("export"))
    for name, df in sample.bronze(spark, SF).items():
        df.write.parquet(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in K.RAW_TABLES}


def status_of(df):
    return {r[0]: (r["rows"], r["error"]) for r in df.collect()}


def test_load_keeps_tables_unchanged(spark, export, tmp_path, rows):
    status = status_of(bronze.load(spark, export, str(tmp_path)))
    assert list(status) == K.RAW_TABLES
    for name, df in bronze.read(spark, str(tmp_path)).items():
        assert status[name] == (df.count(), None)
        assert rows(df) == rows(spark.read.parquet(export[name]))


def test_load_isolates_failures_and_keeps_the_last_version(spark, export, tmp_path, rows):
    bronze.load(spark, export, str(tmp_path))
    before = rows(tables.read(spark, str(tmp_path), "bronze", "steps_record_table"))
    broken = {**export, "steps_record_table": f"{tmp_path}/nowhere"}
    del broken["weight_record_table"]
    broken["sleep_stages_table"] = export["steps_record_table"]  # lacks its columns
    status = status_of(bronze.load(spark, broken, str(tmp_path)))
    failed = {t for t, (_, error) in status.items() if error}
    assert failed == {"steps_record_table", "weight_record_table", "sleep_stages_table"}
    assert "missing columns: parent_key" in status["sleep_stages_table"][1]
    assert rows(tables.read(spark, str(tmp_path), "bronze", "steps_record_table")) == before


def test_a_failing_write_leaves_the_table(spark, tmp_path, rows):
    good = spark.range(3)
    tables.overwrite(good, str(tmp_path), "silver", "t")
    bad = spark.range(10).select(F.when(F.col("id") > 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.overwrite(bad, str(tmp_path), "silver", "t")
    stored = tables.read(spark, str(tmp_path), "silver", "t")
    assert rows(stored) == rows(good)
    # a job may rewrite what it reads
    assert tables.overwrite(stored.selectExpr("id + 1 AS id"), str(tmp_path), "silver", "t", ["id"]) == 3
    assert rows(tables.read(spark, str(tmp_path), "silver", "t")) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("fmt, options", [("csv", {"header": "true"}), ("json", {}), ("orc", {})])
def test_other_formats(spark, tmp_path, rows, fmt, options):
    steps = sample.table(spark, SF, "steps_record_table")
    steps.write.format(fmt).options(**options).save(f"{tmp_path}/steps")
    got = bronze.scan(spark, bronze.Source(f"{tmp_path}/steps", fmt, options), "steps_record_table")
    typed = dict(got.dtypes)
    assert (typed["local_date"], typed["count"], typed["app_info_id"]) == ("bigint", "bigint", "int")
    assert rows(silver.steps(got)) == rows(silver.steps(steps))


def test_latest_snapshot(spark, tmp_path):
    for name in ("a.zip", "c.zip", "b.zip", "d.txt"):
        (tmp_path / name).write_bytes(b"x")
        time.sleep(0.02)
    assert bronze.latest_path(spark, str(tmp_path)).endswith("/b.zip")
    assert bronze.latest_snapshot(spark, str(tmp_path)).count() == 1
    with pytest.raises(FileNotFoundError):
        bronze.latest_path(spark, str(tmp_path), "*.gz")
    assert bronze.latest_snapshot(spark, str(tmp_path), "*.gz").count() == 0


def test_latest_snapshot_of_folders(spark, tmp_path):
    for n in (2, 1):
        spark.range(n).repartition(n).write.parquet(f"{tmp_path}/export_{n}")
        time.sleep(0.02)
    assert bronze.latest_path(spark, str(tmp_path), "*.parquet", folders=True).endswith("/export_1")


def test_run_twice_gives_the_same(spark, export, tmp_path, rows):
    first = daily_run.run(spark, export, str(tmp_path), sample.AS_OF, KEYS, "row_id")
    results = [rows(df) for df in (first.status, first.duplicates, first.undated, first.report)]
    second = daily_run.run(spark, export, str(tmp_path), sample.AS_OF, KEYS, "row_id")
    assert [rows(df) for df in (second.status, second.duplicates, second.undated, second.report)] == results
    assert {r["layer"]: r["n"] for r in second.status.groupBy("layer").agg(F.count("*").alias("n")).collect()} == {
        "bronze": 8, "silver": 7, "gold": 1, "report": 1,
    }
    gold_table = tables.read(spark, str(tmp_path), "gold", "daily_metrics")
    assert rows(second.report) == rows(report.run(gold_table, KEYS))
    tables.as_views({"daily_metrics": gold_table}, "gold_")
    assert spark.sql("SELECT count(*) FROM gold_daily_metrics").first()[0] == gold_table.count()


def test_strict_run_stops_and_lenient_run_reports(spark, export, tmp_path):
    broken = {k: v for k, v in export.items() if k != "oxygen_saturation_record_table"}
    with pytest.raises(RuntimeError, match="oxygen_saturation"):
        daily_run.run(spark, broken, str(tmp_path / "a"), sample.AS_OF, KEYS)
    result = daily_run.run(spark, broken, str(tmp_path / "b"), sample.AS_OF, KEYS, strict=False)
    failed = {(r["layer"], r["table_name"]) for r in result.status.where("error IS NOT NULL").collect()}
    assert failed == {("bronze", "oxygen_saturation_record_table"), ("silver", "spo2")}
    gold_table = tables.read(spark, str(tmp_path / "b"), "gold", "daily_metrics")
    assert gold_table.count() > 0
    assert gold_table.where("spo2_avg IS NOT NULL").count() == 0
    with pytest.raises(RuntimeError, match="no raw table"):
        daily_run.run(spark, {}, str(tmp_path / "c"), sample.AS_OF, KEYS, strict=False)


def test_run_for_one_person(spark, export, tmp_path, caplog):
    result = daily_run.run(spark, export, str(tmp_path), sample.AS_OF, (), "row_id")
    assert result.report.count() == 1
    assert f"{result.duplicates.count()} days have several rows" in caplog.text


def test_work_dir_is_below_the_shared_folder(spark):
    a, b = session.work_dir(spark), session.work_dir(spark)
    assert a != b
    assert a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_filters_and_columns_reach_the_scan(spark, export):
    steps = spark.read.parquet(export["steps_record_table"])
    plan = silver.steps(steps, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(app_info_id,4)" in plan
    rates = spark.read.parquet(export["resting_heart_rate_record_table"])
    plan = silver.heart_rate(rates)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(beats_per_minute,100)" in plan
    assert "ReadSchema: struct<local_date:bigint,beats_per_minute:bigint>" in plan


def test_a_run_that_stops_between_write_and_switch_leaves_the_table(spark, tmp_path, rows):
    root = str(tmp_path)
    tables.overwrite(spark.range(3), root, "silver", "t")
    tables.write(spark.range(9), root, "silver", "t")  # the process ends here
    assert rows(tables.read(spark, root, "silver", "t")) == [(0,), (1,), (2,)]
    tables.overwrite(spark.range(1), root, "silver", "t")
    assert rows(tables.read(spark, root, "silver", "t")) == [(0,)]


def test_two_writes_at_once_leave_one_whole_table(spark, tmp_path, rows):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path)
    frames = [spark.range(k * 1000, k * 1000 + 500).repartition(3) for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(lambda df: tables.overwrite(df, root, "gold", "t", ["id"]), frames)) == [500] * 4
    assert rows(tables.read(spark, root, "gold", "t")) in [rows(df) for df in frames]


def test_old_versions_can_be_emptied(spark, tmp_path, rows):
    root = str(tmp_path)
    for n in range(1, 5):
        tables.overwrite(spark.range(n), root, "silver", "t")
    assert tables.clean(spark, root) == 2 and tables.clean(spark, root) == 0
    assert tables.read(spark, root, "silver", "t").count() == 4


def test_tables_in_the_catalog(spark, tmp_path):
    root = str(tmp_path)
    tables.overwrite(spark.range(4), root, "gold", "numbers")
    assert tables.register(spark, root, "gold") == ["default.gold_numbers"]
    assert spark.sql("SELECT count(*) FROM gold_numbers").first()[0] == 4
    spark.sql("DROP TABLE gold_numbers")


def test_a_declared_schema_needs_no_look_at_the_data(spark, tmp_path):
    steps = sample.table(spark, SF, "steps_record_table")
    steps.write.json(f"{tmp_path}/steps")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("declared", "scan with a schema")
    got = bronze.scan(spark, bronze.Source(f"{tmp_path}/steps", "json", {}, steps.schema), "steps_record_table")
    assert not tracker.getJobIdsForGroup("declared")
    spark.sparkContext.setJobGroup("inferred", "scan without")
    bronze.scan(spark, bronze.Source(f"{tmp_path}/steps", "json"), "steps_record_table")
    assert tracker.getJobIdsForGroup("inferred")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got.dtypes == steps.dtypes


def test_malformed_records_are_kept_apart(spark, tmp_path, rows):
    """A bad number, a short and a long line; half an object and a wrong type."""
    (tmp_path / "steps.csv").write_text("user_id,local_date,app_info_id,count\n1,19723,4,10\n1,x,4,10\n2,19723\n3,19723,4,5,6\n4,19724,4,7\n")
    (tmp_path / "energy.json").write_text(
        '{"local_date": 19723, "energy": 1.5, "app_info_id": 4}\n{"local_date": 19723, "ene\n{"local_date": "monday", "energy": 2, "app_info_id": 4}\n'
    )
    steps, energy = "steps_record_table", "active_calories_burned_record_table"
    sources = {
        steps: bronze.Source(str(tmp_path / "steps.csv"), "csv", {"header": "true"}),
        energy: bronze.Source(str(tmp_path / "energy.json"), "json", {}, "local_date long, energy double, app_info_id int"),
    }
    root = str(tmp_path / "out")
    status = {r["source_table"]: (r["rows"], r["malformed"]) for r in bronze.load(spark, sources, root).collect()}
    assert status[steps] == (2, 3) and status[energy] == (1, 2)
    loaded = bronze.read(spark, root)
    assert rows(loaded[steps], "local_date", "count") == [(19723, 10), (19724, 7)] and bronze.MALFORMED not in loaded[steps].columns
    assert sorted(r["record"] for r in bronze.malformed(spark, root).where(F.col("source_table") == steps).collect()) == [
        "1,x,4,10", "2,19723", "3,19723,4,5,6",
    ]
    with pytest.raises(Exception, match="(?i)malformed"):
        bronze.scan(spark, sources[steps], steps).collect()


def scanned(spark, metric):
    """A metric of the file scans of the last query, smallest first."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    last = runs.apply(runs.size() - 1).executionId()
    values, found = store.executionMetrics(last), []
    nodes = store.planGraph(last).allNodes().iterator()
    while nodes.hasNext():
        node = nodes.next()
        metrics = node.metrics().iterator()
        while metrics.hasNext():
            m = metrics.next()
            if node.name().startswith("Scan parquet") and m.name() == metric and values.contains(m.accumulatorId()):
                found.append(int(values.apply(m.accumulatorId()).replace(",", "")))
    return sorted(found)


@pytest.mark.parametrize("keys", [KEYS, []])
def test_a_week_opens_the_same_folders_however_long_the_history(spark, tmp_path, rows, keys):
    """One and four years of Gold by month, in turn: the scan of the days opens March alone."""
    opened, results = [], []
    for years in (1, 4):
        n, days = F.col("id"), 366 * years
        made = spark.range(days * 3).select(
            (n % 3).alias("user_id"), F.date_sub(F.lit("2024-03-09").cast("date"), (n / 3).cast("int")).alias("local_date"),
            (n % 9000).alias("steps"), F.lit(7.5).alias("sleep_hours"), F.lit("Rest").alias("workout_type"),
            *[F.lit(1.0).alias(c) for c in ("deep_minutes", "rem_minutes", "active_kcal", "workout_minutes", "resting_hr", "spo2_avg")],
        )
        made = made if keys else made.where("user_id = 0").drop("user_id")
        root = str(tmp_path / str(years))
        tables.overwrite(gold.by_month(made), root, "gold", "daily_metrics", [*keys, "local_date"], [gold.MONTH])
        stored = tables.read(spark, root, "gold", "daily_metrics")
        assert stored.select(gold.MONTH).distinct().count() in (13, 49)
        got = weekly.week_rows(stored, keys).collect()
        opened.append(scanned(spark, "number of partitions read")[0])
        results.append(sorted(map(tuple, got)))
        assert sorted(map(tuple, weekly.week_rows(made, keys).collect())) == results[-1]
        # The prior week begins in February.
        assert rows(weekly.week_over_week(stored, keys)) == rows(weekly.week_over_week(made, keys))
    assert opened == [1, 1]  # 3 to 9 March
    assert results[0] == results[1] and len(results[0]) == 7 * (3 if keys else 1)
