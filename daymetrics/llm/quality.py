"""Quality rules: word statistics and cutoffs that labelled documents certify per stratum."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics.llm.common import UPPER, stored

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Terms of the binomial tail that are added up one by one; the rest is bounded from above.
_TERMS = 1000


@dataclass(frozen=True)
class Rule:
    """A document fails if `part` per `whole` is above the cutoff. Cutoffs ascend; the last is the mildest."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols", "n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0)),
    Rule("exclamations", "n_exclamations", "n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0)),
    Rule("capitals", "n_capitals", "word_chars", (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
    Rule("repeats", "n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.42, 0.45, 0.48)),
)
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_exclamations", "n_capitals",
)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(_without(text, chars))).cast("long")


def statistics(documents: DataFrame, text: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """Adds STATISTICS and base_failed to `columns` (default: all) of every row; one pass, no shuffle.

    Words are runs of other than ASCII blanks in the whole text (null: none). n_repeat_words:
    words in windows of three that occur twice or more in the text, the first time included;
    windows are compared by a 64-bit hash. base_failed: under 50 words, or over half of them
    repeated.
    """
    new = {*STATISTICS, "base_failed", "_words", "_lines", "_windows", "_repeated"}
    kept = [c for c in (columns or documents.columns) if c.lower() not in new]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.translate(whole, BLANKS[1:], " " * (len(BLANKS) - 1)), " "), "")
    lines = F.filter(F.split(whole, "\n"), lambda line: _without(line, BLANKS) != "")
    w, windows, repeated = F.col("_words"), F.col("_windows"), F.col("_repeated")
    def hashed(i: Column) -> Column:
        return F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))

    sorted_windows = F.when(
        F.size(w) >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), hashed))
    )

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get(windows, i - 1)["h"], F.get(windows, i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    # A repeated window covers three words, fewer if the next one begins before they end.
    covered = F.aggregate(
        F.transform(repeated, lambda i, at: F.least(F.lit(3), F.coalesce(F.get(repeated, at + 1) - i, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    return (
        documents.select(
            *kept,
            words.alias("_words"),
            lines.alias("_lines"),
            F.length(_without(whole, BLANKS)).cast("long").alias("word_chars"),
            _count(whole, SYMBOLS).alias("n_symbols"),
            _count(whole, "!").alias("n_exclamations"),
            _count(whole, UPPER).alias("n_capitals"),
        )
        .withColumns(
            {
                "_windows": sorted_windows,
                "n_words": F.size(w).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            }
        )
        .withColumn("_repeated", F.sort_array(F.transform(F.filter(windows, twice), lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
        .select(
            *kept, *STATISTICS, ((n_words < 50) | (100 * n_repeat > 50 * n_words)).alias("base_failed")
        )
    )


def _log_gamma(x: Column) -> Column:
    """Stirling's series after eight steps of the recurrence: 12 digits for x >= 1."""
    steps = F.lit(0.0)
    for i in range(8):
        steps = steps + F.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p); 1 where k >= n p, as no small value can come of that.

    Summed downwards from the largest term. Beyond `_TERMS` terms the rest is replaced by its
    geometric bound, which errs on the safe side.
    """
    k, n = k.cast("double"), n.cast("double")
    largest = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = lambda i: (k - i) * (1 - p) / ((n - k + i + 1) * p)
    state = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term"))
    summed = F.aggregate(
        F.sequence(F.lit(0), F.least(k, F.lit(_TERMS - 1.0)).cast("int")),
        state,
        lambda s, i: F.struct((s["sum"] + s["term"]).alias("sum"), (s["term"] * ratio(i.cast("double"))).alias("term")),
        lambda s: s["sum"] + s["term"] / (1 - F.least(ratio(F.lit(0.0)), F.lit(0.999999))),
    )
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(largest) * summed)


def certify(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str,
    rules: Sequence[Rule] = RULES,
    max_loss: float = 0.05,
    risk: float = 0.05,
    price: float = 5.0,
    row_id: str = "doc_id",
) -> DataFrame:
    """One row per stratum: `cutoffs`, an array with each rule's cutoff or null, stored.

    Guarantee: with probability 1 - `risk`, in no stratum do the rules together reject more than
    `max_loss` of the good documents (quality 1), the labelled ones being a random holdout. Each
    of R rules may spend `max_loss` / R, and each of the R x S pairs of rule and stratum is tested
    at `risk` / (R S) (Bonferroni). Within a pair, cutoffs are tested from the mildest on and the
    first failure ends the sequence, which needs no further correction. A cutoff passes if the
    exact binomial probability of as few rejections as were seen, under a loss of `max_loss` / R,
    is at most that level. Of the cutoffs that pass, the one with the best share of bad documents
    (quality 0) rejected less `price` times the share of good ones counts (ties: the milder); if
    none gains anything, the rule stays off there, as in strata with too few labels.

    Only sums per stratum and rule are shuffled, combined before. Labels are null-safe: other
    values than 0 and 1 are left out; a null stratum is one of its own; labels without a document
    count nothing.
    """
    shares = [F.col(r.part) / F.greatest(F.col(r.whole), F.lit(1)) for r in rules]
    above = [F.array(*(s > c for c in r.cutoffs)) for r, s in zip(rules, shares, strict=True)]
    labelled = measured.where(~F.col("base_failed")).join(
        labels.where("quality IN (0, 1)").select(F.col(row_id).alias("_id"), "quality"), F.col(row_id) == F.col("_id")
    )
    longest = max(len(r.cutoffs) for r in rules)
    rows = labelled.select(
        F.col(stratum).alias("stratum"),
        "quality",
        F.posexplode(F.array(*above)).alias("rule", "above"),
    )
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    count = lambda who, j: F.count_if(who & F.get("above", F.lit(j)))
    sums = rows.groupBy("stratum", "rule").agg(
        F.count_if(good).alias("n_good"),
        F.count_if(bad).alias("n_bad"),
        F.array(*(count(good, j) for j in range(longest))).alias("good"),
        F.array(*(count(bad, j) for j in range(longest))).alias("bad"),
    )
    sums = stored(sums)
    strata = sums.select("stratum").distinct().count()
    level = risk / (len(rules) * max(1, strata))
    allowed = max_loss / len(rules)
    grid = F.array(*(F.array(*(F.lit(c) for c in r.cutoffs)) for r in rules))
    own = F.get(grid, F.col("rule"))
    # From the mildest (last) cutoff on, up to the first that fails.
    passes = F.transform(
        F.sequence(F.lit(0), F.size(own) - 1),
        lambda j: (binomial_tail(F.get("good", j), F.col("n_good"), allowed) <= level) & (F.col("n_good") > 0),
    )
    valid = lambda j: F.forall(F.slice(F.col("_passes"), j + 1, F.size("_passes")), lambda ok: ok)
    gain = lambda j: F.get("bad", j) / F.greatest("n_bad", F.lit(1)) - price * F.get("good", j) / F.col("n_good")
    options = F.transform(
        F.sequence(F.lit(0), F.size(own) - 1),
        lambda j: F.when(valid(j) & (gain(j) > 0), F.struct(gain(j).alias("gain"), F.get(own, j).alias("cutoff"))),
    )
    chosen = sums.withColumn("_passes", passes).select(
        "stratum", "rule", F.array_max(F.filter(options, lambda o: o.isNotNull()))["cutoff"].alias("cutoff")
    )
    by_rule = [F.max(F.when(F.col("rule") == i, F.col("cutoff"))) for i in range(len(rules))]
    return stored(chosen.groupBy("stratum").agg(F.array(*by_rule).alias("cutoffs")))


def judge(
    documents: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: Sequence[Rule] = RULES,
    max_loss: float = 0.05,
    risk: float = 0.05,
    text: str = "text",
    row_id: str = "doc_id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Adds STATISTICS, base_failed, failed_rules (names) and kept to `columns` (default: all, must
    hold `row_id` and `stratum`) of every row of `documents`.

    kept is false if base_failed, else true unless a certified rule of the row's stratum fails.
    Null and empty texts have no word and fail the base; strata without certified cutoffs keep
    what passes the base; repeated rows repeat their verdict; an empty table gives an empty one,
    and empty labels certify nothing. Input columns of the new names are replaced.

    The cutoffs are a stored table of one row a stratum; Spark broadcasts it if its size is below
    the session's threshold and else joins by shuffle. The rows with their statistics are stored
    once, so texts are read once; they are stored only if `columns` holds them.
    """
    kept = [c for c in (columns or documents.columns) if c.lower() not in {"failed_rules", "kept", "_stratum", "_cutoffs"}]
    rows = stored(statistics(documents, text, kept))
    cutoffs = certify(rows, labels, stratum, rules, max_loss, risk, row_id=row_id)
    fails = F.array(
        *(
            F.when(F.col(r.part) / F.greatest(F.col(r.whole), F.lit(1)) > F.get("_cutoffs", F.lit(i)), F.lit(r.name))
            for i, r in enumerate(rules)
        )
    )
    found = rows.join(
        cutoffs.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs")),
        F.col(stratum).eqNullSafe(F.col("_stratum")),
        "left",
    )
    return found.withColumn("failed_rules", F.coalesce(F.array_compact(fails), F.array().cast("array<string>"))).select(
        *rows.columns, "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept")
    )


def sql(rules: Sequence[Rule] = RULES, max_loss: float = 0.05, risk: float = 0.05, price: float = 5.0) -> str:
    """DuckDB SQL for `judge` by lang, with word windows as texts and the tail summed in full."""
    blanks = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
    without = lambda s, chars: f"translate({s}, {chars}, '')"
    count = lambda chars: f"length(t) - length({without('t', chars)})"
    allowed = max_loss / len(rules)
    ratio = lambda r: f"{r.part}::DOUBLE / greatest({r.whole}, 1)"
    grid = ", ".join(f"({i}, {j}, {c}::DOUBLE)" for i, r in enumerate(rules) for j, c in enumerate(r.cutoffs))
    by_rule = " ".join(f"WHEN {i} THEN {ratio(r)}" for i, r in enumerate(rules))
    fails = " OR ".join(
        f"coalesce({ratio(r)} > (SELECT cutoff FROM best b WHERE b.lang IS NOT DISTINCT FROM m.lang AND b.rule = {i}), false)"
        for i, r in enumerate(rules)
    )
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS t FROM documents),
    w AS (SELECT row, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
    x AS (
      SELECT row, unnest(range(1, len(w) - 1)) AS i,
             unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s
      FROM w WHERE len(w) >= 3),
    r AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, s) AS n FROM x) WHERE n > 1),
    n AS (
      SELECT row, CAST(sum(least(3, coalesce(after - i, 3))) AS BIGINT) AS n
      FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS after FROM r) GROUP BY row),
    l AS (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d),
    dup AS (
      SELECT row, count(*) - count(DISTINCT line) AS n FROM l WHERE {without("line", blanks)} <> '' GROUP BY row),
    s AS (
      SELECT row, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length({without("t", blanks)}) AS word_chars,
             {count("'" + SYMBOLS + "'")} AS n_symbols, {count("'!'")} AS n_exclamations,
             {count("'" + UPPER + "'")} AS n_capitals, coalesce(dup.n, 0) AS n_dup_lines, coalesce(n.n, 0) AS n_repeat_words
      FROM d JOIN w USING (row) LEFT JOIN dup USING (row) LEFT JOIN n USING (row)),
    m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
    grid(rule, j, cutoff) AS (VALUES {grid}),
    lab AS (SELECT m.*, quality FROM m JOIN labels ON labels.doc_id = m.doc_id WHERE NOT base_failed AND quality IN (0, 1)),
    c AS (
      SELECT lang, rule, j, cutoff, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 0) AS n_bad,
             count(*) FILTER (quality = 1 AND v > cutoff) AS good, count(*) FILTER (quality = 0 AND v > cutoff) AS bad
      FROM (SELECT *, CASE rule {by_rule} END AS v FROM lab, grid) GROUP BY ALL),
    p AS (
      SELECT *, CASE WHEN n_good = 0 OR good >= n_good * {allowed} THEN 1.0 ELSE
        list_sum(list_transform(range(0, good + 1), lambda k: exp(lgamma(n_good + 1) - lgamma(k + 1)
          - lgamma(n_good - k + 1) + k * ln({allowed}) + (n_good - k) * ln(1 - {allowed})))) END AS p
      FROM c),
    v AS (
      SELECT *, bool_and(p <= {risk / len(rules)} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM lab)))
        OVER (PARTITION BY lang, rule ORDER BY j DESC) AS valid,
        bad::DOUBLE / greatest(n_bad, 1) - {price} * good::DOUBLE / n_good AS gain
      FROM p),
    best AS (
      SELECT lang, rule, arg_max(cutoff, [gain, cutoff]) AS cutoff FROM v WHERE valid AND gain > 0 GROUP BY lang, rule)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({fails}) AS kept
    FROM m"""
