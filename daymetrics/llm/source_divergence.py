"""Source divergence audit: how far the term shares of a language's sources lie apart.

Of all terms, a source has few. A pair of sources is therefore compared as if both had none of
them, and corrected for those that it has: for terms of one of the two by counts of equal terms,
for terms of both by a frequent-pattern tree. The tree holds each term's row, its sources in order
with what they have of it; rows that begin alike share nodes, and a node is compared once with
each of its ancestors, weighted by the terms below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymetrics.llm.common import LOWER, UPPER, stored

#: A term is a run of these: ASCII letters, in lower case, and all bytes of other characters.
_BYTES = bytes(b if b >= 0x80 or chr(b) in LOWER else b + 32 if chr(b) in UPPER else 0x20 for b in range(256))
SCALE = 1_000_000_000
#: Rows of counts or sums (some 50 bytes each) that a task holds before it hands them on, and pairs
#: of nodes compared at a time.
_HELD, _PAIRS = 1 << 20, 1 << 18
#: Bytes of texts that are split into terms at a time; a longer text is split alone.
_BYTES_AT_ONCE = 4 << 20
#: Tasks that a language's rows may be dealt to where they meet its sources.
_SALTS = 32


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The terms of binary texts, none of them null: each one's text, by its place, and the term."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    ends = np.concatenate(([0], np.cumsum(size))).astype(wide)
    mapped = b"".join(texts.to_pylist()).translate(_BYTES)
    plain = (pa.LargeStringArray if wide is np.int64 else pa.StringArray).from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(mapped))
    split = pc.ascii_split_whitespace(plain)
    words = split.flatten()
    at = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(words), 0)  # none before a blank at the start or after one at the end
    return at[real.to_numpy(zero_copy_only=False)], words.filter(real)


_COUNTS = ["group", "term", "n", "docs"]


def _combined(parts: list[pa.Table]) -> pa.Table:
    """(group, term, n, docs) of several, with each group's term once."""
    grouped = pa.concat_tables(parts).group_by(["group", "term"], use_threads=False)
    return grouped.aggregate([("n", "sum"), ("docs", "sum")]).select(["group", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTS)


def _count(groups: np.ndarray, texts: pa.Array) -> pa.Table:
    """(group, term, n, docs): how often the terms occur in a group's texts, and in how many."""
    at, words = terms(texts)
    coded = words.dictionary_encode()
    keys = np.sort(at.astype(np.int64) << 32 | coded.indices.to_numpy(zero_copy_only=False))
    first = np.flatnonzero(np.diff(keys, prepend=-1))  # each text's term once
    n = np.diff(first, append=len(keys))
    keys = groups[keys[first] >> 32] << 32 | (keys[first] & 0xFFFFFFFF)
    held = pa.table({"key": keys, "n": n}).group_by("key", use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    keys = held["key"].to_numpy()
    term = coded.dictionary.take(pa.array(keys & 0xFFFFFFFF)).cast(pa.binary())
    return pa.table([pa.array(keys >> 32), term, held["n_sum"], held["n_count"]], _COUNTS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), combined over the documents of the task."""
    groups: dict[tuple[str, str], int] = {}
    parts: list[pa.Table] = []  # the first is combined

    def out() -> Iterator[pa.RecordBatch]:
        lang, source = (pa.array([g[i] for g in groups], pa.string()) for i in range(2))
        for part in _combined(parts).to_batches(max_chunksize=1 << 16):
            group, *rest = part.columns
            yield pa.RecordBatch.from_arrays([lang.take(group), source.take(group), *rest], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        of = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        group = np.array([groups.setdefault(g, len(groups)) for g in of], np.int64)
        texts = batch.column(2)
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            till = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + _BYTES_AT_ONCE, "right")))
            parts.append(_count(group[at:till], texts.slice(at, till - at)))
            at = till
            if sum(map(len, parts)) > 2 * len(parts[0]) + _HELD // 4:
                parts = [_combined(parts)]
                if len(parts[0]) > _HELD:
                    yield from out()
                    parts = []
    if parts:
        yield from out()


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 2) / (total + 2 kept)), exact at any count; null where no term is kept."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = (total + kept * 2).cast("decimal(20,0)")
    return _div(above, F.nullif(below, F.lit(0).cast("decimal(20,0)"))) + 1


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are 1 to SCALE + 1, so the square fits a long."""
    return _div((p - q) * (p - q), p + q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def term_rows(documents: DataFrame, least_docs: int = 10) -> DataFrame:
    """(lang, source, term, n, lang_n, first): for the terms in at least `least_docs` documents of a
    language and each of its sources that has them, how often they occur there and in the language,
    and whether the source is the term's first. `documents` has lang, source and text, none of them null.

    The counts of a term meet once, in the exchange by term and language: what follows needs no other.
    The term comes before the language in it, as rows are sorted by it and tell terms apart sooner.
    """
    held = documents.select("lang", "source", F.col("text").cast("binary"))
    partial = held.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long").repartition("term", "lang")
    counted = partial.groupBy("term", "lang", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("term", "lang")
    return (
        counted.select(
            "lang", "source", "term", "n",
            F.sum("n").over(whole).alias("lang_n"),
            F.sum("docs").over(whole).alias("docs"),
            (F.col("source") == F.min("source").over(whole)).alias("first"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )


def source_totals(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """(lang, source, at, total, lang_total, kept, zero): each source of a language, numbered in their
    order, with the sum of its kept terms and of its language's, their number, and its share of a
    term that it does not have."""
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    of_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("kept"))
    zero = F.lit(0).cast("long")
    return (
        documents.select("lang", "source")
        .distinct()
        .join(totals.drop("firsts"), ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select(
            "lang", "source",
            F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("at"),
            *(F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "kept")),
        )
        .withColumn("zero", _share(zero, F.col("total"), F.col("kept")))
    )


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(values[order], first)


def _compared(row: pa.ListArray, m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sources (the lesser in the upper half) and their corrections, from a language's sorted rows.

    Level by level: a node stands in the first of the rows that share its path, and is weighted by
    the terms of all rows up to the next that leaves the path at or above it.
    """
    at, p, zero = (c.to_numpy().astype(np.int64) for c in row.flatten().flatten())
    size = pc.list_value_length(row).to_numpy().astype(np.int64)
    start = np.cumsum(size) - size
    # How many nodes of the row before are this row's too.
    common = np.minimum(size, np.append(0, size[:-1]))
    of = np.repeat(np.arange(len(size)), common)
    here = np.arange(len(of)) - np.repeat(np.cumsum(common) - common, common) + start[of]
    above = here - start[of] + start[of - 1]
    unlike = np.flatnonzero((at[here] != at[above]) | (p[here] != p[above]))
    rows, first = np.unique(of[unlike], return_index=True)
    common[rows] = here[unlike[first]] - start[rows]

    passed = np.append(0, np.cumsum(m))
    for depth in range(1, int(size.max(initial=0))):
        begin = np.flatnonzero(common <= depth)
        end = np.append(begin[1:], len(size))
        held = size[begin] > depth
        weight = (passed[end] - passed[begin])[held]
        nodes = start[begin[held]] + depth
        step = max(1, _PAIRS // depth)
        for i in range(0, len(nodes), step):
            node = nodes[i : i + step, None]
            path = node - np.arange(depth, 0, -1)
            both = _gaps(p[path], p[node]) - _gaps(p[path], zero[node])
            both += _gaps(zero[path], zero[node]) - _gaps(zero[path], p[node])
            both *= weight[i : i + step, None]
            yield _summed((at[path] << 32 | at[node]).ravel(), both.ravel())


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value): corrections for terms that both have, from sorted rows of (lang, row, m).

    Sorted rows visit the tree depth first, so that the rows of a node follow each other. Where a
    batch begins inside a subtree its path is built once more, and the sums are the same.
    """
    lang: str | None = None
    sums: list[tuple[np.ndarray, np.ndarray]] = []  # the first is summed
    size = 0

    def add() -> None:
        nonlocal sums, size
        sums = [_summed(*(np.concatenate(x) for x in zip(*sums, strict=True)))]
        size = 0

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal sums
        if not sums:
            return
        add()
        keys, values = sums.pop()
        for at in range(0, len(keys), 1 << 16):
            part = keys[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.string()),
                    pa.array(part >> 32, pa.int32()),
                    pa.array(part & 0xFFFFFFFF, pa.int32()),
                    pa.array(values[at : at + (1 << 16)], pa.int64()),
                ],
                ["lang", "a", "b", "value"],
            )

    for batch in batches:
        runs = pc.run_end_encode(batch.column(0))
        begin = 0
        for end, its_lang in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
            if its_lang != lang:
                yield from out()
                lang = its_lang
            part = batch.slice(begin, end - begin)
            begin = end
            for found in _compared(part.column(1), part.column(2).to_numpy()):
                sums.append(found)
                size += len(found[0])
                if size > _HELD // 4 + len(sums[0][0]):
                    add()
                    if len(sums[0][0]) > _HELD:
                        yield from out()
    yield from out()


def pair_values(items: DataFrame, sources: DataFrame) -> DataFrame:
    """(lang, a, b, value): for sources a < b of a language (by number), the sum over all kept terms.

    `items` holds, for each kept term and source that has it, the source's number and share.
    """
    z = F.col("zero")
    other = sources.select("lang", F.col("at").alias("_at"), F.col("zero").alias("_zero"))
    # Both have none of any term: a row for each pair, as in the result.
    none = sources.join(other, "lang").where(F.col("at") < F.col("_at")).select(
        "lang", F.col("at").alias("a"), F.col("_at").alias("b"),
        F.coalesce(_gap(z, F.col("_zero")) * F.col("kept"), F.lit(0).cast("long")).alias("value"),
    )
    # One has the term: terms with equal counts there are one row.
    equal = items.groupBy("lang", "at", "p", "zero").agg(F.count(F.lit(1)).alias("m"))
    salt = F.pmod(F.hash("at", "p"), F.lit(_SALTS))
    dealt = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    one = equal.withColumn("_salt", salt).join(dealt, ["lang", "_salt"]).where(F.col("at") != F.col("_at")).select(
        "lang", F.least("at", "_at").alias("a"), F.greatest("at", "_at").alias("b"),
        (F.col("m") * (_gap(F.col("p"), F.col("_zero")) - _gap(z, F.col("_zero")))).alias("value"),
    )
    # Both have it: the tree of rows.
    row = F.sort_array(F.collect_list(F.struct("at", "p", "zero")))
    rows = items.groupBy("term", "lang").agg(row.alias("row")).groupBy("lang", "row").agg(F.count(F.lit(1)).alias("m"))
    tree = rows.repartitionByRange("lang", "row").sortWithinPartitions("lang", "row")
    both = tree.mapInArrow(_tree, "lang string, a int, b int, value long")
    return none.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(documents: DataFrame, least_docs: int = 10, terms_per_source: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) of `documents`.

    Part `pair`: each other source of the language and the sum of their gaps over all kept terms;
    part `term`: the `terms_per_source` kept terms that the source has, and has more of than its
    language, with the widest gaps. Nulls in text, lang and source count as empty; a source without
    any term has none of each; a language that keeps no term has pairs of value 0. Repeated rows
    count each as a document; equal values rank by the item's UTF-8 bytes. An empty table gives an
    empty one; other columns are not looked at.

    Counts are combined in the tasks that read the texts, so a frequent term or source is a few
    rows of each, and meet in one exchange. One row holds the sources of a term, and the result a
    row for each pair of them: sources may be many thousands, not millions. Terms of equal rows are
    one row of the tree.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = documents.select(empty("lang"), empty("source"), empty("text"))
    rows = stored(term_rows(docs, least_docs))
    sources = stored(source_totals(docs, rows))
    items = stored(
        rows.join(sources, ["lang", "source"]).select(
            "lang", "source", "term", "at", "zero",
            _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
            _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
        )
    )
    best = items.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
        _gap(F.col("p"), F.col("q")).alias("value"),
    )
    name = lambda at, source: sources.select("lang", F.col("at").alias(at), F.col("source").alias(source))
    named = pair_values(items, sources).join(name("a", "_a"), ["lang", "a"]).join(name("b", "_b"), ["lang", "b"])
    way = lambda source, item: F.struct(F.col(source).alias("source"), F.col(item).alias("item"))
    pairs = named.select("lang", "value", F.inline(F.array(way("_a", "_b"), way("_b", "_a")))).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    )
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = lambda df: df.withColumn("rank", place)
    return ranked(pairs).unionByName(ranked(best).where(F.col("rank") <= terms_per_source))


def sql(least_docs: int = 10, terms_per_source: int = 10) -> str:
    """The same for DuckDB, by comparing every pair of sources on every term."""
    share = "1 + {scale}::HUGEINT * ({n} + 2) // ({total} + 2 * kept)"
    gap = "((p - q) * (p - q)) // (p + q)"
    own = share.format(scale=SCALE, n="coalesce(n, 0)", total="total")
    lang = share.format(scale=SCALE, n="lang_n", total="lang_total")
    return rf"""
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM documents),
    o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
    k AS (
      SELECT lang, term, count(*) AS lang_n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {least_docs}),
    v AS (SELECT lang, count(*) AS kept, sum(lang_n)::HUGEINT AS lang_total FROM k GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
    g AS (
      SELECT s.lang, s.source, coalesce(total, 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) s
      LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source) USING (lang, source)),
    p AS (
      SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {own} AS p, {lang} AS of_lang
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
    pairs AS (
      SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum({gap.replace("p", "x.p").replace("q", "y.p")}), 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
      LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
      WHERE x.term IS NULL OR y.term IS NOT NULL
      GROUP BY a.lang, a.source, b.source),
    best AS (
      SELECT lang, source, term AS item, CAST({gap.replace("q", "of_lang")} AS BIGINT) AS value
      FROM p WHERE n > 0 AND p > of_lang),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM best)
    SELECT lang, source, 'pair' AS part, item, value,
      CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank
    FROM pairs
    UNION ALL SELECT lang, source, 'term', item, value, rank FROM ranked WHERE rank <= {terms_per_source}
    """
