"""Filter interaction audit: what each filter removes at each place of every order of the filters.

A document counts only through the set of filters that it fails, its part and its labels, so the
table shrinks to one cell for each part and failing set: 32 a part, however many documents. Each
cell is folded over all 120 orders by higher-order functions, and the folds of a part's cells are
added element by element.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymetrics.llm.common import UPPER

FILTERS = "ABCDE"
#: All orders of the filters, and the same as arrays of their bits.
ORDERS = ["".join(order) for order in permutations(FILTERS)]
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
COPY = BIT["E"]
BLANKS = r"[\x20\x09-\x0D]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
#: Tasks that rows without an id are dealt to.
_SALTS = 1024


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text (not null) fails."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    tests = {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": upper.cast("long") * 100 > F.length(text).cast("long") * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }
    mask = F.lit(0)
    for name, fails in tests.items():
        mask = mask + F.when(fails, BIT[name]).otherwise(0)
    return mask


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they fail.

    A text is looked at once; from then on it is a digest of 32 bytes. Rows meet by id for their
    labels and by digest for their copies only after they are counted, so a text, an id or a part
    with a third of all rows is a few rows in any task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        failures(text).alias("mask"),
    )
    each = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic"))
        .withColumn("_salt", F.lit(0).cast("long"))
    )
    # Rows without an id find no label; the second key keeps them from meeting in one task.
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(_SALTS))).otherwise(F.lit(0).cast("long"))
    marked = each.withColumn("_salt", salt).join(marks, ["doc_id", "_salt"], "left")
    good, toxic = F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False))
    texts = marked.groupBy("digest", "part", "mask", good.alias("good"), toxic.alias("toxic")).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_no_id"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    # As many rows a digest as its documents have parts and labels.
    smallest = F.min("first").over(Window.partitionBy("digest"))
    original = F.when(F.col("first") == smallest, F.col("n_first")).otherwise(0)
    copies = F.col("n") - F.col("n_no_id") - original
    split = texts.withColumn("_copies", copies).select(
        "part", "good", "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask"), (F.col("n") - F.col("_copies")).alias("n")),
                F.struct((F.col("mask") + COPY).alias("mask"), F.col("_copies").alias("n")),
            )
        ),
    )
    weigh = lambda name: F.coalesce(F.sum(F.when(F.col(name), F.col("n"))), F.lit(0)).alias(name)
    return split.where("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("n"), weigh("good"), weigh("toxic"))


def _struct(values: dict[str, Column]) -> Column:
    return F.struct(*(v.cast("long").alias(k) for k, v in values.items()))


def fold(cell: Column, orders: Column) -> Column:
    """What a cell adds to each step of each order: an array of a struct a step, order after order."""
    mask = cell["mask"]

    def step(state: Column, bit: Column) -> Column:
        fails, gone = mask.bitwiseAND(bit) != 0, state["gone"]
        lost = fails & ~gone
        weight = {
            "kept": F.when(gone | fails, 0).otherwise(cell["n"]),
            "removed": F.when(lost, cell["n"]).otherwise(0),
            "redundant": F.when(fails & gone, cell["n"]).otherwise(0),
            "unique_fails": F.when(mask == bit, cell["n"]).otherwise(0),
            "good_lost": F.when(lost, cell["good"]).otherwise(0),
            "toxic_lost": F.when(lost, cell["toxic"]).otherwise(0),
        }
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(_struct(weight))).alias("steps"))

    none = F.filter(F.array(_struct({c: F.lit(0) for c in COUNTS})), lambda x: F.lit(False))
    start = F.struct(F.lit(False).alias("gone"), none.alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row for every source, every order of the five filters and every step of it, zeros included.
    A null text or source counts as an empty one. A copy is a row whose text some smaller id has; a
    row without an id is no copy and makes none, and has no label. Rows that repeat an id count
    each; several labels of an id count as any of them. Labels of no document are not looked at. An
    empty table gives an empty one. Columns besides the named ones are not looked at.

    A part's cells, 32 at most, meet in one row; 600 structs a part are made there.
    """
    orders = F.array(*(F.array(*(F.lit(BIT[name]) for name in order)) for order in ORDERS))
    steps = len(ORDERS) * len(FILTERS)
    zeros = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda _: _struct({c: F.lit(0) for c in COUNTS}))

    def add(total: Column, cell: Column) -> Column:
        return F.zip_with(total, fold(cell, orders), lambda a, b: _struct({c: a[c] + b[c] for c in COUNTS}))

    cell = F.struct("mask", "n", "good", "toxic")
    parts = cells(documents, labels).groupBy("part").agg(F.collect_list(cell).alias("cells"))
    folded = parts.select("part", F.aggregate("cells", zeros, add).alias("steps"))
    rows = folded.select("part", F.posexplode("steps").alias("at", "step_counts")).select(
        "part",
        F.element_at(F.lit(ORDERS), (F.col("at") / len(FILTERS)).cast("int") + 1).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"),
        "step_counts.*",
    )
    # 600 rows a part.
    same_filter = Window.partitionBy("part", F.substr("filter_order", "step", F.lit(1)))
    return rows.withColumn("shapley", F.sum("removed").over(same_filter))


def sql() -> str:
    """The same for DuckDB, counted document by document."""
    letters = ", ".join(f"('{name}', {bit})" for name, bit in BIT.items())
    names = "abcde"
    joined = " CROSS JOIN ".join(f"letters {x}" for x in names)
    apart = " AND ".join(f"{x}.bit <> {y}.bit" for i, x in enumerate(names) for y in names[i + 1 :])
    steps = " UNION ALL ".join(
        f"SELECT filter_order, {i + 1} AS step, bits[{i + 1}] AS bit, list_sum(bits[1:{i}]) AS earlier FROM orders"
        for i in range(len(names))
    )
    return rf"""
    WITH letters(name, bit) AS (VALUES {letters}),
    orders AS (
      SELECT {" || ".join(f"{x}.name" for x in names)} AS filter_order, [{", ".join(f"{x}.bit" for x in names)}] AS bits
      FROM {joined} WHERE {apart}),
    steps AS ({steps}),
    d AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
      FROM documents),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    m AS (
      SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > first THEN 16 ELSE 0 END) AS mask
      FROM d LEFT JOIN l USING (doc_id)),
    counted AS (
      SELECT part, filter_order, step, bit,
        count(*) FILTER (mask & (coalesce(earlier, 0)::INT | bit) = 0) AS kept,
        count(*) FILTER (mask & bit <> 0 AND mask & coalesce(earlier, 0)::INT = 0) AS removed,
        count(*) FILTER (mask & bit <> 0 AND mask & coalesce(earlier, 0)::INT <> 0) AS redundant,
        count(*) FILTER (mask = bit) AS unique_fails,
        count(*) FILTER (good AND mask & bit <> 0 AND mask & coalesce(earlier, 0)::INT = 0) AS good_lost,
        count(*) FILTER (toxic AND mask & bit <> 0 AND mask & coalesce(earlier, 0)::INT = 0) AS toxic_lost
      FROM m CROSS JOIN steps GROUP BY part, filter_order, step, bit)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
      CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM counted
    """
