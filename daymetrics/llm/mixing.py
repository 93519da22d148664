"""Mixing to target weights: iterative proportional fitting on cells of source, language and topic."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics.llm.common import WORD, stored

#: Topics by the first pattern that a text contains; fixed values, in order of precedence.
TOPICS = {
    "legal": r"(?i)\b(licen[sc]ed?|copyright|all rights reserved|warranty)\b",
    "contact": r"[\w.+-]+@[\w-]+\.\w|https?://|\+?\d[\d ()-]{8,}\d",
    "table": r"\S \| \S",
    "numeric": r"\d[\d.,]*\D+\d[\d.,]*\D+\d",
}
OTHER = "general"
#: How far a marginal may be off its target.
TOLERANCE = 1e-6

logger = logging.getLogger(__name__)


def topic_of(text: Column, topics: Mapping[str, str] = TOPICS) -> Column:
    found = F.lit(OTHER)
    for name, pattern in reversed(topics.items()):
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def tempered(shares: DataFrame, key: str, exponent: float) -> DataFrame:
    """(`key`, target): shares of the column `tokens`, to the power `exponent`, scaled to 1."""
    power = F.pow("tokens", F.lit(exponent))
    total = shares.agg(F.sum(power).alias("t")).first()["t"]
    return shares.select(key, (power / F.lit(float(total or 1.0))).alias("target"))


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    tolerance: float = TOLERANCE,
    rounds: int = 60,
    cap: float | None = None,
) -> tuple[DataFrame, float]:
    """(`cells` with weight, largest deviation of a marginal from its target).

    `cells` has one row per combination of the keys of `targets`, with its tokens; a target
    frame has (key, target), target sums to 1. weight x tokens has the targets as its marginals
    once it has converged: factors of one key at a time are set to target / current sum. The
    cells are counts, not documents; they stay a distributed table that is aggregated (combined
    before the shuffle) and joined once a step, and stored once a round, so no plan grows. Cells
    whose key has no target, or a target of 0, get weight 0. Keys are compared null-safe.

    With `cap` no weight is above it: cells at the cap count as fixed where a sum has to grow, so
    the free ones make up for them within the same value, and the other marginals are raked on.
    A column `weight` of `cells` is where raking starts.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    columns = [c for c in cells.columns if c != "weight"]
    now = cells if "weight" in cells.columns else stored(cells.withColumn("weight", F.lit(1.0 / max(total, 1))))
    bound = F.lit(float("inf") if cap is None else cap)
    bounded, free = F.least("weight", bound) * F.col("tokens"), F.col("weight") < bound
    mass, worst = F.col("weight") * F.col("tokens"), 0.0
    for _ in range(rounds):
        deviations = []
        for key, target in targets.items():
            sums = now.groupBy(key).agg(
                F.sum(bounded).alias("sum"), F.coalesce(F.sum(F.when(free, mass)), F.lit(0.0)).alias("free")
            )
            goal = target.select(F.col(key).alias("_key"), "target")
            aim = F.coalesce("target", F.lit(0.0))
            factor = sums.join(goal, F.col(key).eqNullSafe(F.col("_key")), "left").select(
                F.col(key).alias("_key"),
                F.when((aim > F.col("sum")) & (F.col("free") > 0), (aim - F.col("sum")) / F.col("free") + 1.0)
                .when(F.col("sum") > 0, aim / F.col("sum")).otherwise(0.0).alias("factor"),
                F.abs(F.col("sum") - aim).alias("off"),
            )
            factor = stored(factor)
            deviations.append(factor.agg(F.max("off")).first()[0] or 0.0)
            now = now.join(factor.drop("off"), F.col(key).eqNullSafe(F.col("_key")), "left").select(
                *columns, (F.col("weight") * F.col("factor")).alias("weight")
            )
        now, worst = stored(now), max(deviations, default=0.0)
        if worst <= tolerance:
            break
    return now.select(*columns, F.least("weight", bound).alias("weight")), worst


def plan(
    cells: DataFrame, targets: Mapping[str, DataFrame], rate: float, max_copies: int | None, tolerance: float = TOLERANCE
) -> tuple[DataFrame, float, float]:
    """(`cells` with weight and probability, the rate that they have, their largest deviation).

    probability = rate x weight x all tokens, at most `max_copies`. Where the targets cannot be
    had at `rate` with that bound, the rate is lowered: first to what the scarcest value's tokens
    allow, with the weights raked under the bound; should that not converge, until the largest
    probability of the unbounded weights is the bound. The marginals are those of the unbounded
    weights at least, and the targets where raking converges.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    weighted, worst = rake(cells, targets, tolerance)
    most = (weighted.agg(F.max("weight")).first()[0] or 0.0) * total
    if max_copies is not None and rate * most > max_copies:
        whole, bounded, off = max_copies / most, weighted, worst
        if worst <= tolerance:
            for key, target in targets.items():
                held = cells.groupBy(key).agg(F.sum("tokens").alias("tokens"))
                goal = target.where("target > 0").select(F.col(key).alias("_key"), "target")
                scarce = held.join(goal, F.col(key).eqNullSafe(F.col("_key"))).agg(F.min(F.col("tokens") / F.col("target")))
                rate = min(rate, max_copies * (scarce.first()[0] or 0.0) / total)
            bounded, off = rake(weighted, targets, tolerance, cap=max_copies / (rate * total))
        if off <= tolerance:
            weighted, worst = bounded, off
        else:
            rate = min(rate, whole)
    probability = F.col("weight") * F.lit(rate * total)
    if max_copies is not None:
        probability = F.least(F.lit(float(max_copies)), probability)  # for the last bit of the product
    return weighted.withColumn("probability", probability), rate, worst


def mix(
    documents: DataFrame,
    keys: Mapping[str, Column] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    exponents: Mapping[str, float] | None = None,
    rate: float = 0.5,
    max_copies: int | None = 1,
    text: str = "text",
    row_id: str = "doc_id",
    seed: int = 11,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Adds n_tokens, topic, weight, probability, copies and deviation to `columns` (default: all) of every row.

    Tokens are words of the whole text. Cells of source, language and topic (`keys`) are raked to
    the targets; by default each marginal is its own token shares to the power `exponents` (0.7),
    which lifts rare values over frequent ones. probability = `rate` x weight x all tokens is the
    expected number of copies, so the expected tokens of the sample are `rate` of all and have the
    target marginals. With `max_copies` None that holds whatever the cells. Else no document is
    expected more often than that: cells are raked under the bound, and where the targets cannot
    be had at `rate`, a lower one is taken (see `plan`), so the marginals hold all the same; what
    was taken is sum(probability x n_tokens) / sum(n_tokens). A document gets floor(probability)
    copies and one more with the chance of the rest, decided by a hash of its id and `seed`: the
    same rows at any partitioning. Targets that the cells cannot have together are met as far as raking
    comes in its rounds; `deviation` is how far a marginal of the weights is off, and a warning says so.

    Rows that carry their texts along are read twice, so that no text is written here; others are
    stored with what was found.

    Null keys are values of their own. Documents without a word have weight as any other of
    their cell but no tokens; a cell without any token gets probability 0. Repeated rows get the
    same decision; an empty table gives an empty one. Input columns of the new names are replaced.
    The cells join the documents as a stored table, broadcast by Spark if that is below the
    session's threshold; a hot source is one cell row per language and topic.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keys = dict(keys or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(whole)})
    names = {k: f"_{k}" for k in keys}
    new = {"n_tokens", "topic", "weight", "probability", "copies", "deviation", *names.values(), *(f"_{n}" for n in names.values())}
    kept = [c for c in (columns or documents.columns) if c.lower() not in new]
    rows = documents.select(
        *kept, *(c.alias(names[k]) for k, c in keys.items()), F.regexp_count(whole, F.lit(WORD)).cast("long").alias("n_tokens")
    )
    if text not in kept:
        rows = stored(rows)
    cells = rows.groupBy(*names.values()).agg(F.sum("n_tokens").alias("tokens"))
    cells = stored(cells.where("tokens > 0"))
    if targets is None:
        powers = exponents or {}
        goals = {
            n: tempered(cells.groupBy(n).agg(F.sum("tokens").alias("tokens")), n, powers.get(k, 0.7))
            for k, n in names.items()
        }
    else:
        goals = {names[k]: t.withColumnRenamed(k, names[k]) for k, t in targets.items()}
    weighted, _, deviation = plan(cells, goals, rate, max_copies)
    if deviation > TOLERANCE:
        logger.warning("raking did not settle: a marginal is %.3g off its target", deviation)
    table = stored(
        weighted.select(*(F.col(n).alias(f"_{n}") for n in names.values()), "weight", "probability")
    )
    same = None
    for n in names.values():
        one = F.col(n).eqNullSafe(F.col(f"_{n}"))
        same = one if same is None else same & one
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    probability = F.coalesce("probability", F.lit(0.0))
    whole_part = F.floor(probability)
    copies = whole_part + F.when(chance < probability - whole_part, 1).otherwise(0)
    topic = [F.col(names["topic"]).alias("topic")] if "topic" in keys else []
    return rows.join(table, same, "left").select(
        *kept, "n_tokens", *topic, F.coalesce("weight", F.lit(0.0)).alias("weight"),
        probability.alias("probability"), copies.cast("int").alias("copies"), F.lit(deviation).alias("deviation"),
    )
