"""Bronze: raw tables as the source holds them, and the choice of the newest export."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymetrics import constants as K
from daymetrics import schemas
from daymetrics.sources import tables

STATUS = "source_table STRING, rows BIGINT, error STRING, malformed BIGINT"
# Formats whose columns carry no types of their own.
TEXT_FORMATS = {"csv", "json"}
#: Holds a record as read where it does not fit the schema.
MALFORMED = "_malformed"


@dataclass(frozen=True)
class Source:
    """Where a raw table is and how to read it.

    `options` go to the reader (csv header; jdbc url, and partitionColumn, lowerBound, upperBound
    and numPartitions so that a large table is read by many tasks). Without a `schema` Spark
    infers one from text formats, which reads their data twice.
    """

    path: str | None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None


def _text_schema(spark: SparkSession, src: Source, required: T.StructType) -> T.StructType:
    """The declared schema, or the inferred one with declared types where only text was seen."""
    if src.schema is not None:
        return T.StructType.fromDDL(src.schema) if isinstance(src.schema, str) else T.StructType(list(src.schema))
    seen = spark.read.format(src.format).options(**src.options).load(src.path).schema
    types = {f.name: f.dataType for f in required}
    text = T.StringType()
    return T.StructType([T.StructField(f.name, types.get(f.name, text) if f.dataType == text else f.dataType) for f in seen])


def scan(spark: SparkSession, source: Source | str, table: str, keep_malformed: bool = False) -> DataFrame:
    """The whole source table, all columns; the required ones must be there.

    A record of a text format that does not fit its schema ends the query; with `keep_malformed` it
    stays, with the record as read in the column MALFORMED, which is null in all others.
    """
    src = Source(source) if isinstance(source, str) else source
    reader = spark.read.format(src.format).options(**src.options)
    required = schemas.BRONZE[table]
    if src.format in TEXT_FORMATS:
        schema = _text_schema(spark, src, required)
        if keep_malformed:
            schema = schema.add(MALFORMED, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("mode", "PERMISSIVE")
        elif "mode" not in src.options:
            reader = reader.option("mode", "FAILFAST")
        return schemas.conform(reader.schema(schema).load(src.path), required)
    if src.schema is not None:
        reader = reader.schema(src.schema)
    df = reader.load(src.path) if src.path else reader.load()
    lacking = schemas.missing_columns(df, required)
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df


def load(
    spark: SparkSession, sources: Mapping[str, Source | str], target: str, parallel: int = 8
) -> DataFrame:
    """Store every raw table under <target>/bronze and report rows or error per table.

    A table that cannot be read keeps its last stored version, and the others go on; the
    status says so, for the caller to decide. Malformed records of text formats are stored next to
    the others and counted apart, in the same pass; `read` leaves them out, `malformed` has them.
    The writes are independent Spark jobs and run a few at a time.
    """

    def store(table: str) -> tuple[str, tables.Version | None, int | None, str | None]:
        try:
            if table not in sources:
                raise KeyError(f"no source for {table}")
            df = scan(spark, sources[table], table, keep_malformed=True)
            bad = F.count_if(F.col(MALFORMED).isNotNull()) if MALFORMED in df.columns else F.lit(0).cast("long")
            counted = Observation()
            made = tables.write(df.observe(counted, F.count(F.lit(1)).alias("n"), bad.alias("bad")), target, "bronze", table)
            return table, made, counted.get["bad"], None
        except Exception as error:  # noqa: BLE001 - isolated per table, reported
            return table, None, None, first_line(error)

    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(store, K.RAW_TABLES))
    tables.publish(spark, target, [made for _, made, _, _ in done if made])
    status = [(table, made.rows - bad if made else None, error, bad) for table, made, bad, error in done]
    return spark.createDataFrame(status, STATUS)


def first_line(error: Exception) -> str:
    lines = str(error).strip().splitlines()
    return f"{type(error).__name__}: {lines[0] if lines else ''}"


def _stored(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    stored = tables.current(spark, target, "bronze")
    return {t: spark.read.parquet(stored["bronze", t]) for t in K.RAW_TABLES if ("bronze", t) in stored}


def read(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The stored raw tables that exist, without their malformed records."""
    found = _stored(spark, target)
    return {
        t: df.where(F.col(MALFORMED).isNull()).drop(MALFORMED) if MALFORMED in df.columns else df for t, df in found.items()
    }


def malformed(spark: SparkSession, target: str) -> DataFrame:
    """(source_table, record): the malformed records of all stored raw tables, as they were read."""
    out = spark.createDataFrame([], "source_table STRING, record STRING")
    for table, df in _stored(spark, target).items():
        if MALFORMED in df.columns:
            kept = df.where(F.col(MALFORMED).isNotNull())
            out = out.unionByName(kept.select(F.lit(table).alias("source_table"), F.col(MALFORMED).alias("record")))
    return out


def snapshots(spark: SparkSession, folder: str, glob: str = "*.zip", folders: bool = False) -> DataFrame:
    """The exports below a folder with their modification time.

    An export is a file, or with `folders=True` a folder whose newest file counts, which is
    how Spark itself writes one. Only the listing is read, never the content.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "modificationTime")
    )
    if not folders:
        return files
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(parent.alias("path")).agg(F.max("modificationTime").alias("modificationTime"))


def latest_snapshot(
    spark: SparkSession, folder: str, glob: str = "*.zip", folders: bool = False
) -> DataFrame:
    """The newest export, one row; the later path on equal times. No row if there is none."""
    newest = F.max(F.struct("modificationTime", "path"))
    return (
        snapshots(spark, folder, glob, folders)
        .agg(newest.alias("newest"))
        .where("newest IS NOT NULL")
        .select("newest.path", "newest.modificationTime")
    )


def latest_path(spark: SparkSession, folder: str, glob: str = "*.zip", folders: bool = False) -> str:
    """Path of the newest export; an empty folder is an error."""
    row = latest_snapshot(spark, folder, glob, folders).first()
    if row is None:
        raise FileNotFoundError(f"no {glob} in {folder}")
    return row["path"]
