"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymetrics import session

#: A word is a run of characters other than the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: its plan starts there.

    A lost executor costs a re-read. The folder is the one that `spark.checkpoint.dir` names.
    """
    spark = df.sparkSession
    folder = session.work_dir(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Bits that say which keys may be among the dropped ones: 8 MB in rows of 4 kB.
_SLOTS = 1 << 26


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """`rows` whose `key` (a long that no two rows share) is not among those of `dropped`, a stored table.

    A bit for each slot that a dropped key's hash falls on is broadcast: 8 MB whatever the input.
    Rows on other slots stay without meeting the dropped ones; only the rest, about as many as are
    dropped, cross the network with all their columns. With many more keys than slots that is all
    rows: an ordinary anti-join.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(_SLOTS)) + 1
    bits = stored(
        dropped.groupBy(F.bitmap_bucket_number(slot).alias("_at")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")
        )
    )
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substr("_bits", F.call_function("div", place, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.coalesce(F.getbit(byte.cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))
    marked = rows.join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col("_at"), "left").withColumn("_set", is_set)
    clear = marked.where(~F.col("_set")).select(*rows.columns)
    perhaps = marked.where("_set").select(*rows.columns)
    return clear.unionByName(perhaps.join(dropped, key, "left_anti"))
