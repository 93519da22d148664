"""Row generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies that are written next to each other.
_BLOCK = 1024


def days_between(first: Column, last: Column) -> Column:
    """Every DATE from first to last, both included; last must not be before first."""
    return F.sequence(first, last, F.expr("INTERVAL 1 DAY"))


def repeat_rows(df: DataFrame, copies: str, spread: Sequence[str]) -> DataFrame:
    """Each row `copies` times (1 or more), and the count column dropped.

    A row becomes blocks of at most 1,024 copies, the blocks are dealt out by hash of their
    number and the `spread` columns, and only then written out: the copies of one row come
    from many tasks, and no array is longer than a block, or than the number of blocks. The
    number of partitions is given, as adaptive execution would merge them by the size they
    have before the copies are written.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = F.col(copies)
    rest = n - F.col("_block") * F.lit(_BLOCK)
    kept = [c for c in df.columns if c != copies]
    return (
        df.withColumn("_block", F.explode(F.sequence(F.lit(0), ((n - 1) / _BLOCK).cast("int"))))
        .repartition(parts, *spread, "_block")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(rest, F.lit(_BLOCK)).cast("int"))))
        .select(*kept)
    )
