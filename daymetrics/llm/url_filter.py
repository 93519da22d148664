"""URL filter: host rules first, then a weighted vocabulary counted by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics.llm.common import LOWER, UPPER

#: One of these is enough to reject a URL.
STRICT_TERMS = (
    "adult", "camgirls", "casino", "escort", "hentai", "nsfw", "porn", "porno", "sex", "viagra", "warez", "xxx",
)
#: These reject a URL together: `min_soft` different ones.
SOFT_TERMS = (
    "ads", "bet", "bets", "bonus", "cheap", "crack", "dating", "farm", "free", "jackpot", "loan", "nude", "pills",
    "poker", "spam", "torrent", "track", "win",
)


@dataclass(frozen=True)
class Rule:
    """`pattern` is a host, a slash and a path prefix; it holds for the host's subdomains too."""

    verdict: str
    pattern: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, ASCII lower case. Path: from
    there up to `?`, `#` or the end. Both are empty for a URL that is null or has no `://`."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does.

    The rules are a parameter of the job, so they are literals in the plan: no join.
    """
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        domain, slash, rest = rule.pattern.partition("/")
        ok = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        hit = F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fits = F.when(ok, hit).otherwise(fits)
    return fits


def automaton(strict: Iterable[str], soft: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):  # a term of both kinds is strict
        for term in terms:
            found.add_word(term, (kind, term))
    found.make_automaton()
    return found


def hits(text: str, terms: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms that stand alone, i.e. no ASCII letter or digit beside them."""
    strict: set[str] = set()
    soft: set[str] = set()
    for last, (kind, term) in terms.iter(text):
        first = last - len(term) + 1
        before, after = text[first - 1 : first] if first else "", text[last + 1 : last + 2]
        if not any(c.isascii() and c.isalnum() for c in (before, after) if c):
            (strict if kind == "strict" else soft).add(term)
    return strict, soft


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    min_soft: int = 2,
    url: str = "url",
) -> DataFrame:
    """Adds host, path, rule, strict_hits, soft_hits and verdict to every row of `pages`.

    A fitting rule decides; else one strict or `min_soft` different soft terms anywhere in the
    URL block it. Null and empty URLs, and URLs without `://`, have an empty host and path; the
    latter's terms still count. Rows are judged one by one, so repeated rows and ties repeat
    their verdict and an empty table gives an empty one. Input columns of the new names are
    replaced. Map-only: no shuffle, memory of one Arrow batch.
    """
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("struct<strict:array<string>,soft:array<string>>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = automaton(strict, soft)  # once a task
        for urls in batches:
            found = [hits(u, terms) if u else (set(), set()) for u in urls]
            yield pd.DataFrame({"strict": [sorted(a) for a, _ in found], "soft": [sorted(b) for _, b in found]})

    host, path = host_and_path(F.col(url))
    new = {"host", "path", "rule", "strict_hits", "soft_hits", "verdict", "_rule", "_terms"}
    kept = [c for c in pages.columns if c.lower() not in new]
    fits, terms = F.col("_rule"), F.col("_terms")
    by_terms = (F.size(terms["strict"]) >= 1) | (F.size(terms["soft"]) >= min_soft)
    return (
        pages.select(*kept, host.alias("host"), path.alias("path"))
        .withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
        .withColumn("_terms", count(F.translate(F.col(url), UPPER, LOWER)))
        .select(
            *kept,
            "host",
            "path",
            fits["rule"].alias("rule"),
            terms["strict"].alias("strict_hits"),
            terms["soft"].alias("soft_hits"),
            F.coalesce(fits["verdict"], F.when(by_terms, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        )
    )


def sql(rules: Sequence[Rule], strict: Sequence[str], soft: Sequence[str], min_soft: int) -> str:
    """DuckDB SQL for the same verdicts over `pages`."""
    lower = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    alone = lambda t: f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')"
    fits = "NULL"
    verdict = "NULL"
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        domain, slash, rest = rule.pattern.partition("/")
        ok = f"((host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + rest}'))"
        fits = f"CASE WHEN {ok} THEN '{rule.pattern}' ELSE {fits} END"
        verdict = f"CASE WHEN {ok} THEN '{rule.verdict}' ELSE {verdict} END"
    n_strict = reduce(lambda a, b: f"{a} OR {b}", (alone(t) for t in strict))
    n_soft = " + ".join(f"CAST({alone(t)} AS INTEGER)" for t in soft)
    return f"""
    WITH r AS (
      SELECT page_id, {lower} AS u,
             CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    p AS (
      SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM r)
    SELECT page_id, host, path, {fits} AS rule,
           coalesce({verdict}, CASE WHEN {n_strict} OR ({n_soft}) >= {min_soft} THEN 'block' ELSE 'allow' END) AS verdict
    FROM p"""
