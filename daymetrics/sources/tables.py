"""Stored layer tables: versions of Parquet below <root>/<layer>/<table>, and one list of what is current.

A write makes a new version next to the old ones. It becomes the table when a file that names
it appears below <root>/_versions; Spark's commit of that one small file is the switch. A
write that fails, or a run that stops between the two steps, leaves the table as it was; two
runs at once each write their own versions, and the one published later counts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSIONS = "layer STRING, table_name STRING, version STRING, rows BIGINT, at BIGINT"


@dataclass(frozen=True)
class Version:
    layer: str
    table: str
    version: str
    rows: int


def path(root: str, layer: str, table: str, version: str = "") -> str:
    return "/".join([root.rstrip("/"), layer, table, *([version] if version else [])])


def _list(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """All versions ever published below `root`; no row if there is none."""
    try:
        return spark.read.schema(VERSIONS).option("recursiveFileLookup", "true").parquet(_list(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def current(spark: SparkSession, root: str, layer: str | None = None) -> dict[tuple[str, str], str]:
    """Path of each table's current version: one row a table comes to the driver."""
    listed = versions(spark, root)
    if layer:
        listed = listed.where(F.col("layer") == layer)
    newest = listed.groupBy("layer", "table_name").agg(F.max_by("version", F.struct("at", "version")).alias("version"))
    return {(r["layer"], r["table_name"]): path(root, *r) for r in newest.collect()}


def exists(spark: SparkSession, root: str, layer: str, table: str) -> bool:
    return (layer, table) in current(spark, root, layer)


def read(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    found = current(spark, root, layer).get((layer, table))
    if found is None:
        raise FileNotFoundError(f"no table {layer}.{table} below {root}")
    return spark.read.parquet(found)


def write(
    df: DataFrame, root: str, layer: str, table: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> Version:
    """A new version that nobody reads yet; its row count comes from the write itself.

    `sort_by` ranges the rows over the files and orders them within, so that files and row
    groups can be skipped on those columns. Rows that agree in them may lie in several files:
    a hot value is spread, by the number of the row. `partition_by` makes a folder for each value;
    as the ranges go by it first, a task writes to few folders, and a table has about as many
    files as it has ranges and values together.
    """
    counted, out, by = Observation(), df, [*partition_by, *sort_by]
    if by:
        spread = F.pmod(F.monotonically_increasing_id(), F.lit(64))
        out = out.withColumn("_spread", spread).repartitionByRange(*by, "_spread")
        out = out.sortWithinPartitions(*by).drop("_spread")
    # Observed after the ranges, which look at a sample of the rows first.
    out = out.observe(counted, F.count(F.lit(1)).alias("rows"))
    version = f"run-{time.time_ns():020d}-{uuid.uuid4().hex}"
    out.write.partitionBy(*partition_by).parquet(path(root, layer, table, version))
    return Version(layer, table, version, counted.get["rows"])


def publish(spark: SparkSession, root: str, made: Sequence[Version]) -> None:
    """Switch the tables to these versions, all in one commit."""
    if made:
        rows = [(v.layer, v.table, v.version, v.rows, time.time_ns()) for v in made]
        # A folder of its own: writers that append to the same one clear each other's files.
        folder = f"{_list(root)}/{time.time_ns():020d}-{uuid.uuid4().hex}"
        spark.createDataFrame(rows, VERSIONS).coalesce(1).write.parquet(folder)


def overwrite(
    df: DataFrame, root: str, layer: str, table: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> int:
    """Replace a table and return its row count. A job may rewrite a table it reads."""
    made = write(df, root, layer, table, sort_by, partition_by)
    publish(df.sparkSession, root, [made])
    return made.rows


def clean(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Empty all but the `keep` newest versions of each table; how many were emptied.

    Done by overwriting them with no rows, which needs nothing but Spark's own writer. Not for
    a version that some job may still read.
    """
    listed = versions(spark, root)
    age = F.sort_array(F.collect_set(F.struct("at", "version", "rows")), asc=False)
    old = (
        listed.groupBy("layer", "table_name")
        .agg(F.slice(age, keep + 1, 1 << 20).alias("old"))
        .select("layer", "table_name", F.explode("old").alias("old"))
        .select("layer", "table_name", "old.version")
    )
    emptied = 0
    for layer, table, version in old.collect():
        where = path(root, layer, table, version)
        frame = spark.read.parquet(where)
        if frame.limit(1).count():
            spark.createDataFrame([], frame.schema).write.mode("overwrite").parquet(where)
            emptied += 1
    return emptied


def as_views(frames: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Offer the frames to SQL under their names, for instance silver_steps."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)


def register(spark: SparkSession, root: str, layer: str, database: str = "default") -> list[str]:
    """Current tables of a layer as external catalog tables `<database>.<layer>_<table>`, for SQL in
    this and, with a persistent catalog, in later sessions. Run it again after a run."""
    names = []
    for (_, table), where in sorted(current(spark, root, layer).items()):
        name = f"`{database}`.`{layer}_{table}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(f"{database}.{layer}_{table}", where, "parquet")
        names.append(f"{database}.{layer}_{table}")
    return names
