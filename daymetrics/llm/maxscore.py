"""Exact top-k by inner product: MaxScore over signed components, shard by shard."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymetrics.llm.common import stored

#: The score column is a long: a score beyond it takes the nearest end.
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def integer_components(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of finite doubles (row, dimension): float64, or Python's integers where a
    component is beyond those that `modest` admits."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * scale)
    if modest(scaled).all():
        return scaled
    exact = np.empty(vectors.shape, object)
    factor = Fraction(scale)
    exact.flat = [math.floor(Fraction(x) * factor) for x in vectors.ravel().tolist()]
    return exact


def modest(components: np.ndarray) -> np.ndarray:
    """Rows whose inner products with each other, and every sum on the way, stay below 2^53: doubles
    add these exactly."""
    dimension = components.shape[1]
    return (np.abs(components) <= math.isqrt((1 << 50) // max(1, dimension))).all(axis=1)


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all components finite."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


class Shard:
    """Postings of one shard: every component is a term, and a row's impact on it is its distance
    from the end that is worst for the query, so that impacts are never negative. Components are
    float64 where those add exactly, else Python's integers, and queries are of the same type."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.terms = ids[order], np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.terms.min(axis=1), self.terms.max(axis=1)

    def top(self, query_id: int, query: np.ndarray, k: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, best first, ties to the smaller id.

        With q the query, a row's score is `least` plus its impacts |q_d| (v_d - worst end), each
        at most bound_d = |q_d| (high_d - low_d). Terms are ordered by bound. The essential ones
        are those that a row needs to beat the k-th best score so far; their postings are
        traversed, and the other terms are probed only for rows that can still compete.
        """
        q, kind = query, self.terms.dtype
        worst = np.where(q >= 0, self.low, self.high)
        bound = np.abs(q) * (self.high - self.low)
        by = np.argsort(-bound, kind="stable")
        by = by[q[by] != 0]
        least = q @ worst
        # What the terms after the i-th can still add.
        rest = np.concatenate([np.cumsum(bound[by][::-1])[::-1], np.zeros(1, kind)])
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(self.ids), block):
            ids = self.ids[at : at + block]
            rows = np.flatnonzero(ids != query_id)
            floor = int(best[-1]) if len(best) == k else -np.inf
            # From `essential` on, even the best impacts on all terms lift no row above the floor.
            essential = int(np.searchsorted(-(least + rest), -floor, side="left")) if len(best) == k else len(by)
            first = max(1, min(essential, len(by))) if len(by) else 0
            score = np.full(len(rows), least, kind)
            done = 0
            step = first
            while done < len(by) and len(rows):
                terms = by[done : done + step]
                impacts = self.terms[terms, at : at + block]
                if len(rows) < len(ids):
                    impacts = impacts[:, rows]
                score = score + q[terms] @ impacts - q[terms] @ worst[terms]
                done += step
                competitive = score + rest[min(done, len(by))] > floor  # an equal score has a larger id
                rows, score = rows[competitive], score[competitive]
                step = 8
            best_ids, best = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, _longs(score)])
            keep = np.lexsort((best_ids, ~best))[:k]
            best_ids, best = best_ids[keep], best[keep]
        return best_ids, best


def _of_kind(components: np.ndarray, kind: type) -> np.ndarray:
    """As float64, or as Python's integers."""
    if components.dtype == kind:
        return components
    exact = np.empty(components.shape, object)
    exact.flat = [int(x) for x in components.ravel().tolist()]
    return exact


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(_MOST, max(_LEAST, s)) for s in scores], np.int64)
    return np.rint(scores).astype(np.int64)


def top(asked: pd.DataFrame, held: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    """(query_id, id, score): the k best of the rows `held`, for each row that is asked.

    Rows with components too large for sums in doubles make a shard of their own, in exact
    integers; a query with such components meets all rows in integers.
    """
    if not len(asked) or not len(held):
        return pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype=np.int64)
    ids, rows = held["id"].to_numpy(), np.stack(held["v"].to_list()).astype(np.float64)
    query_ids, queries = asked["id"].to_numpy(), np.stack(asked["v"].to_list()).astype(np.float64)
    with np.errstate(over="ignore"):
        plain, easy = modest(np.floor(rows * scale)), modest(np.floor(queries * scale))
    found = []
    for mild in (True, False):
        these = np.flatnonzero(easy == mild)
        if not len(these):
            continue
        shards = [
            (Shard(ids[part], _of_kind(integer_components(rows[part], scale), kind)), kind)
            for part, kind in ([(plain, np.float64), (~plain, object)] if mild else [(plain | True, object)])
            if part.any()
        ]
        # An integer shard needs the query as integers too.
        exact = {kind: _of_kind(integer_components(queries[these], scale), kind) for _, kind in shards}
        for shard, kind in shards:
            for query_id, query in zip(query_ids[these], exact[kind], strict=True):
                best, scores = shard.top(query_id, query, k)
                found.append(pd.DataFrame({"query_id": query_id, "id": best, "score": scores}))
    return pd.concat(found)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    row_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 8192,
    query_rows: int = 32_768,
) -> DataFrame:
    """(query_id, rank, `row_id`, score): the `k` best rows for each row that `is_query` marks.

    Scores are exact inner products of the components floor(scale * x); one beyond a long takes the
    nearest end of its range, and ranks as that. Candidates are all rows but those with
    the query's own id; ties go to the smaller id; fewer than k candidates give fewer ranks.
    Vectors that are null, empty or hold a null or non-finite component take no part, nor do
    rows with a null id; a query meets candidates of its own dimension only. Repeated rows are
    candidates as often as they occur. An empty table gives an empty one.

    Rows are dealt by hash of their id into shards of about `shard_rows`, queries into blocks of
    about `query_rows`; a task takes one block and one shard, finds its k best, and the shards'
    lists are merged. A task's memory is that of one shard and one block whatever the input.
    """
    held = F.col(vector) if vectors.schema[vector].dataType.simpleString() == "array<float>" else F.col(vector).cast("array<double>")
    rows = stored(
        vectors.where(usable(F.col(vector)) & F.col(row_id).isNotNull()).select(
            F.col(row_id).cast("long").alias("id"),
            held.alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
    )
    counted = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = (max(1, -(-n // size)) for n, size in zip(counted, (shard_rows, query_rows), strict=True))
    dimension = F.size("v").alias("dim")
    candidates = rows.select(
        "id", "v", dimension, F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    # From 2^53 on doubles are whole.
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)
    components = F.transform("v", lambda x: whole(x.cast("double") * scale))
    asked = rows.where("asks").select("id", "v", components.alias("_components")).dropDuplicates(["id", "_components"])
    queries = asked.select(
        "id", "v", dimension, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
    )

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        return top(asked, held, k, scale)

    at = ["dim", "block", "shard"]
    lists = queries.groupBy(*at).cogroup(candidates.groupBy(*at)).applyInPandas(meet, "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        lists.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(row_id), "score")
    )


def sql(k: int = 5, scale: float = 256.0) -> str:
    """DuckDB SQL: every query against every other row, in doubles: exact for scores below 2^53."""
    return f"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
