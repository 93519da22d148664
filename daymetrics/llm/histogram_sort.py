"""Sharding by histogram sort: exact byte counts below candidate boundaries, then one exchange."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymetrics.llm.common import stored

#: Sort key: hash of the group, then the row's id, then its number in the stored table.
KEY = ("_h", "_i", "_n")


@dataclass(frozen=True)
class Cut:
    """A boundary and what lies below it, exactly; a row with this very key lies above."""

    key: tuple[int, int, int]
    bytes: int
    rows: int


def packed(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Signed 64-bit columns as byte strings of the same order."""
    unsigned = np.stack([np.asarray(c, np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns], axis=1)
    return unsigned.astype(">u8").view(f"S{8 * len(columns)}").ravel()


def packed_keys(keys: Sequence[tuple[int, ...]]) -> np.ndarray:
    return packed([np.array(c, np.int64) for c in zip(*keys, strict=True)]) if keys else np.empty(0, f"S{8 * len(KEY)}")


def counts_between(rows: DataFrame, probes: Sequence[tuple[int, ...]]) -> list[tuple[int, int]]:
    """Bytes and rows in each interval that the sorted probes make; summed per task first."""
    sent = packed_keys(probes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, number = np.zeros(len(sent) + 1, np.int64), np.zeros(len(sent) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(sent, packed([b[k].to_numpy() for k in KEY]), side="right")
            np.add.at(size, at, b["_size"].to_numpy())
            np.add.at(number, at, 1)
        yield pd.DataFrame({"at": np.arange(len(sent) + 1), "bytes": size, "rows": number})

    per_task = rows.select(*KEY, "_size").mapInPandas(count, "at long, bytes long, rows long")
    sums = per_task.groupBy("at").agg(F.sum("bytes"), F.sum("rows")).collect()
    found = {at: (size, number) for at, size, number in sums}
    return [found.get(i, (0, 0)) for i in range(len(sent) + 1)]


def candidates(rows: DataFrame, brackets: Sequence[tuple[tuple, tuple]], per_bracket: int) -> list[tuple]:
    """Actual keys strictly inside the open brackets, at most `per_bracket` of each, drawn by hash.

    A bracket's rows fall into `per_bracket` hash cells, of which each gives its smallest hash:
    combined before the shuffle, so a task sends at most brackets x cells rows.
    """
    low, high = packed_keys([a for a, _ in brackets]), packed_keys([b for _, b in brackets])

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            key = packed([b[k].to_numpy() for k in KEY])
            at = np.searchsorted(low, key, side="left") - 1
            ok = (at >= 0) & (key < high[np.maximum(at, 0)])
            yield b.loc[ok, list(KEY)].assign(at=at[ok])

    draw = F.xxhash64(*KEY)
    drawn = (
        rows.select(*KEY)
        .mapInPandas(inside, "_h long, _i long, _n long, at long")
        .groupBy("at", F.pmod(F.hash(*KEY), F.lit(per_bracket)).alias("cell"))
        .agg(F.min(F.struct(draw.alias("draw"), *KEY)).alias("best"))
    )
    return [tuple(r["best"][1:]) for r in drawn.collect()]


def find_cuts(rows: DataFrame, shards: int, tolerance: float, per_round: int = 16, rounds: int = 40) -> list[Cut]:
    """Boundaries between the shards: each has its share of all bytes below it, within `tolerance`
    of one shard's share, or is the row boundary next to it.

    What the driver holds is bounded by shards x `per_round` keys, at any size of the table.
    """
    first, last = (-(2**63), -(2**63), -(2**63)), (2**63 - 1, 2**63 - 1, 2**63 - 1)
    total, number = counts_between(rows, [])[0]
    goals = [total * (k + 1) / shards for k in range(shards - 1)]
    slack = tolerance * total / shards
    known = {first: Cut(first, 0, 0), last: Cut(last, total, number)}
    best: dict[int, Cut] = {}
    for _ in range(rounds):
        ordered = sorted(known.values(), key=lambda c: c.key)
        keys = np.array([c.bytes for c in ordered])
        brackets = {}
        for k, goal in enumerate(goals):
            at = int(np.searchsorted(keys, goal, side="right")) - 1
            below, above = ordered[at], ordered[min(at + 1, len(ordered) - 1)]
            best[k] = below if goal - below.bytes <= above.bytes - goal else above
            if abs(best[k].bytes - goal) > slack and above.rows - below.rows > 1:
                brackets[(below.key, above.key)] = None
        if not brackets:
            break
        probes = sorted(set(candidates(rows, sorted(brackets), per_round)) - set(known))
        if not probes:
            break  # nothing but the brackets' own ends is left between them
        size = count = 0
        for probe, (more, n) in zip(probes, counts_between(rows, probes), strict=False):
            size, count = size + more, count + n
            known[probe] = Cut(probe, size, count)
    return [best[k] for k in range(len(goals))]


def shard(
    df: DataFrame,
    group: Column,
    row_id: Column,
    size: Column,
    shards: int,
    tolerance: float = 0.01,
    split_bytes: int = 256 << 20,
) -> DataFrame:
    """Adds shard (0 to `shards` - 1) and slot (gapless from 0 in the shard) to every row.

    Rows are sorted by (hash of `group`, `row_id`); rows of a group are neighbours, and a group
    is cut only where a boundary falls into it, so a group of any size spreads over shards. Law:
    the sizes of the shards are equal up to `tolerance` of one share plus one row's size on
    either side. Null ids sort first; null groups hash alike; rows that are equal in everything
    keep apart by their place in the stored table, which is written once and so survives
    retries; fewer rows than shards leave shards empty; an empty table gives an empty one.

    The boundaries also cut each shard into pieces of about `split_bytes`, so that the one
    exchange and the sort within it work on pieces, however large a shard is. A slot is the
    exact number of rows before the piece plus the place in it.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    new = {"shard", "slot", *KEY, "_size", "_piece"}
    kept = [c for c in df.columns if c.lower() not in new]
    rows = stored(
        df.select(
            *kept,
            F.xxhash64(group).alias("_h"),
            F.coalesce(row_id.cast("long"), F.lit(-(2**63))).alias("_i"),
            F.monotonically_increasing_id().alias("_n"),
            size.cast("long").alias("_size"),
        )
    )
    total = rows.agg(F.sum("_size")).first()[0] or 0
    per_shard = max(1, math.ceil(total / shards / split_bytes))
    cuts = find_cuts(rows, shards * per_shard, tolerance)
    bounds = packed_keys([c.key for c in cuts])
    starts = [0, *(c.rows for c in cuts)]
    base = [starts[p] - starts[p // per_shard * per_shard] for p in range(len(starts))]

    @F.pandas_udf("long")
    def piece(h: pd.Series, i: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, packed([h.to_numpy(), i.to_numpy(), n.to_numpy()]), side="right"))

    order = Window.partitionBy("_piece").orderBy(*KEY)
    before = F.element_at(F.array(*map(F.lit, base)).cast("array<long>"), (F.col("_piece") + 1).cast("int"))
    return (
        rows.withColumn("_piece", piece(*KEY))
        .withColumn("slot", before + F.row_number().over(order) - 1)
        .select(*kept, F.floor(F.col("_piece") / per_shard).cast("int").alias("shard"), "slot")
    )
