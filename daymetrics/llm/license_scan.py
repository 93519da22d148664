"""License scan: lines compared with licence templates by the Dice coefficient of word bigrams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics.llm.common import LOWER, UPPER

#: Well-known licence notices, as they are commonly written.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation."
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction."
    ),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "All rights reserved": "All rights reserved.",
}


def words_of(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    """Word bigrams of the normalised text, repeats included; a single word stands for itself."""
    words = words_of(text)
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)] or words


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Bigram counts that can still reach the threshold, as Dice is at most 2 min(a, b) / (a + b)."""
    low = math.ceil(size * threshold / (2 - threshold) - 1e-9)
    return max(1, low), math.floor(size * (2 - threshold) / threshold + 1e-9)


def normalised(text: Column) -> Column:
    """ASCII letters and digits in lower case, everything else one space."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(n < 1, words).otherwise(pairs)


def scan(
    documents: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = 0.8,
    text: str = "text",
) -> DataFrame:
    """Adds license, license_dice and license_segments to every row of `documents`.

    Segments of the whole text are its lines and, where they have several lines, its paragraphs
    (parts between blank lines). A segment is normalised and compared with those templates that
    its size admits: the Dice coefficient over bags of word bigrams, of which a segment of n
    words has n - 1 (one word: itself). `license` is the template with the highest coefficient
    (ties: the name first in order), `license_dice` that coefficient, `license_segments` the
    number of segments that reach the threshold for some template; null, null and 0 if none
    does, as for null and empty texts. Repeated rows repeat their result, an empty table gives
    an empty one, input columns of the new names are replaced.

    The templates are literals of the plan; there is no join and no shuffle. Segments that no
    template admits by size, such as long texts, are dropped before a bigram is built.
    """
    bags = {name: bigrams_of(t) for name, t in sorted(templates.items())}
    if not bags or not all(bags.values()):
        raise ValueError("every template needs a word")
    limits = [size_bounds(len(bag), threshold) for bag in bags.values()]
    fewest, most = min(low for low, _ in limits), max(high for _, high in limits)

    def common(grams: Column, bag: list[str]) -> Column:
        once = [g for g, n in Counter(bag).items() if n == 1]
        found = F.size(F.array_intersect(grams, F.array(*map(F.lit, once)))) if once else F.lit(0)
        for gram, n in Counter(bag).items():
            if n > 1:
                found = found + F.least(F.lit(n), F.size(grams) - F.size(F.array_remove(grams, gram)))
        return found

    def score(grams: Column) -> Column:
        """The best template of one segment as (dice, rank); the rank breaks ties."""
        n = F.size(grams)
        scores = []
        for rank, (bag, (low, high)) in enumerate(zip(bags.values(), limits, strict=True)):
            dice = F.when(n.between(low, high), F.lit(2.0) * common(grams, bag) / (n + len(bag)))
            scores.append(F.when(dice >= threshold, F.struct(dice.alias("dice"), F.lit(-rank).alias("rank"))))
        return F.greatest(*scores) if len(scores) > 1 else scores[0]

    new = {"license", "license_dice", "license_segments", "_fitting", "_s", "_best"}
    kept = [c for c in documents.columns if c.lower() not in new]
    whole = F.coalesce(F.col(text), F.lit(""))
    paragraphs = F.filter(F.split(whole, r"\n[ \t\r]*\n"), lambda p: p.contains("\n"))
    words = F.transform(F.concat(F.split(whole, "\n"), paragraphs), lambda s: F.split(normalised(s), " "))
    fitting = F.filter(words, lambda w: F.greatest(F.lit(1), F.size(w) - 1).between(fewest, most) & (w[0] != ""))
    best = F.col("_best")
    return (
        documents.select(*kept, fitting.alias("_fitting"))
        .select(*kept, F.filter(F.transform(F.transform("_fitting", bigrams), score), lambda s: s.isNotNull()).alias("_s"))
        .select(*kept, F.array_max("_s").alias("_best"), F.size("_s").cast("long").alias("license_segments"))
        .select(
            *kept,
            F.when(best.isNotNull(), F.element_at(F.array(*map(F.lit, bags)), 1 - best["rank"])).alias("license"),
            best["dice"].alias("license_dice"),
            "license_segments",
        )
    )


def sql(templates: Mapping[str, str] = TEMPLATES, threshold: float = 0.8) -> str:
    """DuckDB SQL for the scan: every segment against every template, without pruning by size."""
    rows = [
        f"({rank}, '{name}', '{gram}', {n}, {len(bigrams_of(t))})"
        for rank, (name, t) in enumerate(sorted(templates.items()))
        for gram, n in Counter(bigrams_of(t)).items()
    ]
    normal = f"trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
    WITH t(rank, name, gram, n, size) AS (VALUES {", ".join(rows)}),
    seg AS (
      SELECT doc_id, unnest(list_concat(string_split(text, chr(10)),
        list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: contains(p, chr(10))))) AS s
      FROM documents),
    w AS (SELECT doc_id, row_number() OVER () AS seg, string_split({normal}, ' ') AS w FROM seg),
    g AS (
      SELECT doc_id, seg, CASE WHEN len(w) < 2 THEN w ELSE
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END AS grams
      FROM w WHERE w[1] <> ''),
    u AS (SELECT seg, doc_id, len(grams) AS size, unnest(grams) AS gram FROM g),
    c AS (SELECT seg, doc_id, size, gram, count(*) AS n FROM u GROUP BY ALL),
    d AS (
      SELECT seg, c.doc_id, t.rank, t.name, 2.0::DOUBLE * sum(least(c.n, t.n)) / (any_value(c.size) + any_value(t.size)) AS dice
      FROM c JOIN t USING (gram) GROUP BY seg, c.doc_id, t.rank, t.name),
    b AS (SELECT doc_id, seg, name, rank, dice FROM d WHERE dice >= {threshold}),
    r AS (
      SELECT doc_id, arg_max(name, [dice, -rank]) AS license, max(dice) AS license_dice,
             count(DISTINCT seg) AS license_segments FROM b GROUP BY doc_id)
    SELECT doc_id, license, license_dice, coalesce(license_segments, 0) AS license_segments
    FROM documents LEFT JOIN r USING (doc_id)"""
