"""The n-gram join, the filter audit and the source audit: plain versions, odd rows, hot groups."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daymetrics.llm import filter_audit, ngram_join, source_divergence
from daymetrics.llm import queries as Q
from daymetrics.llm.common import table, without

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, extra string"


# --- n-gram join -----------------------------------------------------------------------

def plain_set(text, width=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_components(sets, percent=85):
    """The smallest key that links reach, over all pairs that share anything."""
    parent, having = {i: i for i in sets}, {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = Counter()
        for token in sets[i]:
            common.update(having.get(token, ()))
            having.setdefault(token, []).append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}


def test_the_query_equals_all_pairs(spark):
    sets = {r["doc_id"]: plain_set(r["text"]) for r in table(spark, SF, "documents").collect()}
    got = Q.op11_token_prefixes(spark, SF).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(sets)


def families(draw):
    """Texts of shared passages, copies with few and many changes, and short ones."""
    passages = [[f"p{k}x{i}" for i in range(60)] for k in range(3)]
    texts = []
    for k in range(60):  # one passage in many texts, with little besides or much
        own = [f"o{k}x{i}" for i in range(draw.choice([2, 5, 9, 12, 40, 200]))]
        texts.append(own + passages[k % 3] + (passages[(k + 1) % 3] if k % 5 == 0 else []))
    base = [f"b{i}" for i in range(150)]
    for _ in range(80):  # a family whose members differ in up to a fifth of their words
        copy = list(base)
        for at in draw.sample(range(150), draw.choice([0, 1, 2, 3, 4, 6, 8, 30])):
            copy[at] = f"n{draw.random()}"
        texts.append(copy[draw.choice([0, 0, 0, 5]) :])
    for n in range(12):
        texts += [[f"s{i}" for i in range(n)], [f"s{i}" for i in range(n)]]
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("percent, paired, tripled, tokens", [(85, 64, 512, 1 << 22), (60, 3, 20, 4000), (85, 1, 1, 1500)])
def test_frequent_tokens_and_dealt_families_lose_no_link(frame, monkeypatch, percent, paired, tripled, tokens):
    """Low bounds, so that combinations of two and three tokens, and block pairs, do the work."""
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    monkeypatch.setattr(ngram_join, "TRIPLED", tripled)
    dealt = ngram_join.dealt_families
    monkeypatch.setattr(ngram_join, "dealt_families", lambda members: dealt(members, tokens))
    texts = dict(enumerate(families(random.Random(percent))))
    docs = frame("doc_id long, text string", list(texts.items()))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.cluster(docs, percent=percent).collect()}
    assert got == plain_components({i: plain_set(t) for i, t in texts.items()}, percent)


def test_linked_sets_share_what_they_are_indexed_by(monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIRED", 4)
    monkeypatch.setattr(ngram_join, "TRIPLED", 16)
    rng = np.random.default_rng(4)
    levels = ngram_join.Levels(1.0)
    levels.of = rng.choice([0, 1, levels.paired, levels.tripled], ngram_join.COUNTERS, p=[0.3, 0.2, 0.3, 0.2]).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(6, 400))
        x = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        y = x[rng.random(len(x)) < 0.93] if n > 20 else x
        y = np.unique(np.concatenate([y, rng.integers(0, 1 << 64, int(rng.integers(0, 1 + n // 20)), np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < 85 * (len(x) + len(y) - common):
            continue
        (a, share), (b, other) = ngram_join.signatures(x, levels, 85), ngram_join.signatures(y, levels, 85)
        needed = min(share, other)
        assert len(np.intersect1d(a, b)) >= (1 if needed == ngram_join._ANY else needed)


def test_lists_that_go_on_in_other_batches(monkeypatch):
    import pyarrow as pa

    draw = random.Random(2)
    rows = sorted({(k, n, draw.randrange(40), 1) for k in range(30) for n in draw.sample(range(100, 300), draw.choice([1, 2, 5, 30]))})
    monkeypatch.setattr(ngram_join, "_LIST", 8)
    monkeypatch.setattr(ngram_join.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda s: 0})()))

    def connected(size):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], list("kniw")) for i in range(0, len(rows), size)]
        found = [r for b in ngram_join._listed(85)(iter(batches)) for r in b.to_pylist() if r["b"] is not None and r["part"] is None]
        return plain_links({(r["a"], r["b"]) for r in found})

    def plain_links(pairs):
        parent = list(range(40))
        for a, b in pairs:
            x, y = parent[a], parent[b]
            parent = [min(x, y) if p in (x, y) else p for p in parent]
        return parent

    fitting = {(x[2], y[2]) for x, y in itertools.combinations(rows, 2) if x[0] == y[0] and 100 * x[1] >= 85 * y[1]}
    assert connected(7) == connected(1) == connected(1000) == plain_links(fitting)


def connected_sets(postings, sets):
    """The least set that candidates reach, for each."""
    least = {x: x for x in sets}
    for a, b in ((r["a"], r["b"]) for r in ngram_join.candidates(postings, 85).collect()):
        x, y = sorted((least[a], least[b]))
        least = {k: x if v == y else v for k, v in least.items()}
    return least


POSTINGS = "key long, n int, set long, share int"


def test_a_frequent_token_connects_only_sets_that_need_it(frame):
    """Sets in one long list are no family, which would be compared in whole; in as many as they must share, they are."""
    given = [(0, 100 + s % 9, s, 3) for s in range(300)]  # all share one token
    given += [(1000 + 4 * s + i, 100 + s % 9, s, 3) for s in range(300) for i in range(3)]  # nothing
    given += [(5000 + s // 2 * 2 + i, 100 + s % 9, s, 3) for s in range(100, 110) for i in range(2)]  # pairs: two, and the long list
    given += [(k, 100 + s % 9, s, 3) for k in (7, 8) for s in range(200, 270)]  # three long lists
    given += [(9, 100, 400 + s, ngram_join._ANY if s % 50 == 0 else 3) for s in range(100)]
    sets = sorted({x[2] for x in given})
    got = connected_sets(frame(POSTINGS, given), sets)
    want = {s: 200 if 200 <= s < 270 else s // 2 * 2 if 100 <= s < 110 else 400 if s == 450 else s for s in sets}
    assert got == want


@pytest.mark.parametrize("longest", [1, 2, 5, 64])
def test_candidates_connect_what_shares_enough(frame, monkeypatch, longest):
    monkeypatch.setattr(ngram_join, "_LIST", longest)
    draw, having, of = random.Random(longest), {}, {}
    for s in range(240):
        n = draw.choice([(30, 34), (60, 66), (130, 150)][s // 3 % 3])
        mine = draw.sample(range(60), draw.choice([1, 3, 4])) + [100 + 8 * (s // 3) + i for i in range(8) if draw.random() < 0.6]
        having[s], of[s] = set(mine), (n, draw.choice([ngram_join._ANY] + [2 + n // 48] * 6))
    given = [(k, of[s][0], s, of[s][1]) for s in having for k in having[s]]
    got = connected_sets(frame(POSTINGS, given + given[::5]), having)  # copies that two tasks have read
    enough = 0
    for a, b in itertools.combinations(having, 2):
        (n, x), (m, y) = of[a], of[b]
        needed = min(x, y) if min(x, y) < ngram_join._ANY else 1
        if 100 * min(n, m) >= 85 * max(n, m) and len(having[a] & having[b]) >= needed:
            enough += 1
            assert got[a] == got[b]
    assert enough > 50


def test_join_of_odd_rows(frame):
    same = "one two three four five six seven eight"
    docs = frame(
        DOCS,
        [(1, None, "en", "a", ""), (2, "", "en", "a", ""), (3, " \t\n", "en", "a", ""), (9, same, "en", "a", ""), (7, same.upper(), None, None, None)]
        + [(None, same, "en", "a", "")] * 2 + [(7, same, "en", "b", "x"), (11, "two words", "x", "y", ""), (10, "TWO\x0bwords", "x", "y", "")]
        + [(12, "w " * 30_000, "en", "a", ""), (None, "alone here", "en", "a", "")],
    )
    names = ["n_shingles", "component_id", "name", "tokens", "label", "key"]
    got = ngram_join.cluster(docs.withColumns({n: F.lit("clash") for n in names})).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by_id[1] == [(0, 1)] and by_id[2] == [(0, 2)] and by_id[3] == [(0, 3)]  # no word: linked with nothing
    assert by_id[9] == [(5, 7)] and by_id[7] == [(5, 7)] * 2
    assert sorted(by_id[None], key=str) == sorted([(5, 7), (5, 7), (1, None)], key=str)
    assert by_id[10] == by_id[11] == [(1, 10)] and by_id[12] == [(1, 12)]
    assert ngram_join.cluster(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ngram_join.cluster(docs, percent=30)


# --- filter audit ----------------------------------------------------------------------

def fails_of(rows):
    """Each row's failing filters, one after the other."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        copy = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, *_ in rows)
        out.append(
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                "D": any(c in "#$%&*|" for c in text),
                "E": copy,
            }
        )
    return out


def plain_audit(rows, labels):
    fails, found = fails_of(rows), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for part in {r[3] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[3] or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                before = order[: step - 1]
                removed = [i for i, f in mine if f[name] and not any(f[x] for x in before)]
                shapley[name] += len(removed)
                found[part, "".join(order), step] = [
                    sum(not any(f[x] for x in order[:step]) for _, f in mine), len(removed),
                    sum(f[name] and any(f[x] for x in before) for _, f in mine),
                    sum(f[name] and sum(f.values()) == 1 for _, f in mine),
                    sum(i in good for i in removed), sum(i in toxic for i in removed),
                ]
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                found[part, "".join(order), step].append(shapley[name])
    return found


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in filter_audit.COUNTS] + [r["shapley"]] for r in df.collect()}


def test_audit_of_odd_rows(frame):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [
        (1, None, "en", "a", ""), (2, "", "en", "a", ""), (3, long, "en", None, ""), (4, long, "en", "a", ""), (4, long, "en", "a", ""),
        (5, "word " * 60_000, "en", "b", ""), (None, long, "en", "a", ""), (None, "x & y", "en", "", ""), (6, long + " ÀÉ", "en", "a", ""),
        (7, long.upper(), "en", "b", ""), (8, "Éé # \U0001f642 A", "en", "b", ""), (9, "x & y", "en", "b", ""), (0, "x & y ", "en", "b", ""),
    ]
    labels = [(4, 1, 0), (4, 0, 1), (5, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1), (2, 7, 7)]
    docs = frame(DOCS, rows).withColumns({n: F.lit(1) for n in ("part", "mask", "n", "good", "toxic", "digest", "cells", "_salt")})
    marks = frame("doc_id long, quality int, toxic int, good int", [(*x, 5) for x in labels])
    assert audited(filter_audit.audit(docs, marks)) == plain_audit(rows, labels)
    assert audited(filter_audit.audit(docs, marks.limit(0))) == plain_audit(rows, [])
    assert filter_audit.audit(docs.limit(0), marks).count() == 0


def test_audit_of_a_hot_text(frame):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " * 120, "en", f"s{i % 4}", "") for i in range(300)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 300, 7)]
    docs = frame(DOCS, rows)
    marks = frame("doc_id long, quality int, toxic int", [(a, b, int(c)) for a, b, c in labels])
    assert audited(filter_audit.audit(docs, marks)) == plain_audit(rows, labels)


# --- source audit ----------------------------------------------------------------------

def plain_sources(rows, least=10, best=10):
    import re

    of = {}
    for _, text, lang, source, *_ in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        of.setdefault(lang or "", []).append((source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)))
    found = set()
    for lang, docs in of.items():
        spread = Counter(t for _, terms in docs for t in set(terms))
        kept = [t for t, n in spread.items() if n >= least]
        counts = {s: Counter(t for x, terms in docs if x == s for t in terms) for s, _ in docs}
        whole = sum(counts.values(), Counter())

        def share(count, t, kept=kept):
            return 1 + 10**9 * (count[t] + 2) // (sum(count[k] for k in kept) + 2 * len(kept))

        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s, mine in counts.items():
            pairs = [(-sum(gap(share(mine, t), share(other, t)) for t in kept), o) for o, other in counts.items() if o != s]
            terms = [(-gap(share(mine, t), share(whole, t)), t) for t in kept if mine[t] and share(mine, t) > share(whole, t)]
            for part, listed, limit in (("pair", pairs, None), ("term", terms, best)):
                order = sorted(listed, key=lambda x: (x[0], x[1].encode()))[:limit]
                found |= {(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(order, 1)}
    return found


def test_sources_of_odd_rows(frame, rows):
    draw = random.Random(3)
    words = ["alpha", "Beta", "éàè", "naïve", "Ünï", "x", "日本", "gamma", "don't", "a1b2"]
    given = [(i, " ".join(draw.choices(words, k=draw.choice([0, 3, 30]))), "en", f"s{draw.randrange(6)}", "") for i in range(120)]
    given += [(i, draw.choice(["rare word", "only numbers 12", None]), draw.choice(["de", None, ""]), draw.choice(["a", "b", None]), "") for i in range(30)]
    given += [(500, "alpha " * 50_000, "en", "s1", "")] + [(501, "alpha beta", "en", "s9", "")] * 2 + [(None, None, "xx", "lonely", "")]
    clash = {n: F.lit(1) for n in ("term", "p", "n", "at", "total", "rank", "value", "item", "part", "row", "docs")}
    docs = frame(DOCS, given).withColumns(clash)
    got = rows(source_divergence.audit(docs), "lang", "source", "part", "item", "value", "rank")
    assert set(got) == plain_sources(given) and len(got) == len(set(got))
    assert set(rows(source_divergence.audit(docs, 1, 3), "lang", "source", "part", "item", "value", "rank")) == plain_sources(given, 1, 3)
    assert source_divergence.audit(docs.limit(0)).count() == 0


@pytest.mark.parametrize("pairs, held", [(5, 1 << 20), (1 << 18, 3)])
def test_the_tree_in_small_steps(frame, rows, monkeypatch, pairs, held):
    """Nodes compared a few at a time, and counts and sums handed on early."""
    monkeypatch.setattr(source_divergence, "_PAIRS", pairs)
    monkeypatch.setattr(source_divergence, "_HELD", held)
    draw = random.Random(pairs)
    given = [(i, " ".join(draw.choices("abcdefghij", k=20)), draw.choice(["en", "de"]), f"s{draw.randrange(5)}", "") for i in range(200)]
    got = rows(source_divergence.audit(frame(DOCS, given)), "lang", "source", "part", "item", "value", "rank")
    assert set(got) == plain_sources(given)


def test_a_task_counts_a_term_once():
    """However many terms there are; characters beyond ASCII are no blanks, whatever they are elsewhere."""
    given = [(f"{lang}", "s", f" the\x00{i}The " + " ".join(f"é{w}\u00a0\u0085" for w in plain_names(i * 12_500, 100_000))) for i in range(10) for lang in ("en", "")]
    given += [("en", "t", ""), ("en", "s", "12\t"), ("", "s", "the")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((a, s, x.encode()) for a, s, x in given), strict=True)], ["lang", "source", "text"])
    n, docs = Counter(), Counter()
    for lang, source, text in given:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.replace("T", "t"))
        n.update((lang, source, w) for w in words)
        docs.update((lang, source, w) for w in set(words))
    assert len(n) > 300_000
    got = [r for part in source_divergence._counted(iter([batch.slice(0, 9), batch.slice(9)])) for r in zip(*(c.to_pylist() for c in part.columns), strict=True)]
    assert len(got) == len(n) and {(a, s, w.decode()): (k, d) for a, s, w, k, d in got} == {w: (k, docs[w]) for w, k in n.items()}


def plain_names(start, count):
    return ["".join("abcdefghij"[int(c)] for c in str(i)) for i in range(start, start + count)]


def test_counts_meet_in_one_exchange(frame):
    plan = source_divergence.term_rows(frame(DOCS, [(1, "a b", "en", "s", "")]))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1


@pytest.mark.parametrize("chunk", [1, 3, 10_000])
def test_the_tree_in_batches(chunk):
    """Batches and languages that begin inside a subtree, against all pairs of each row."""
    draw, rows, want = random.Random(chunk), [], Counter()
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in ("", "de", "en"):
        own = [draw.randrange(1, 50) for _ in range(7)]
        for row in sorted({tuple((a, draw.choice([60, 10**9]), own[a]) for a in range(7) if draw.random() < 0.6) for _ in range(200)} - {()}):
            m = draw.randrange(1, 5)
            rows.append((lang, [dict(zip(("at", "p", "zero"), x, strict=True)) for x in row], m))
            for (a, p, x), (b, q, y) in itertools.combinations(row, 2):
                want[lang, a, b] += m * (gap(p, q) - gap(p, y) + gap(x, y) - gap(x, q))
    kind = pa.list_(pa.struct([("at", pa.int32()), ("p", pa.int64()), ("zero", pa.int64())]))
    lang, row, m = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(lang), pa.array(row, kind), pa.array(m)], ["lang", "row", "m"])
    got = Counter()
    for part in source_divergence._tree(batch.slice(i, chunk) for i in range(0, len(rows), chunk)):
        for lang, a, b, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
            got[lang, a, b] += value
    assert got == want


# --- shared helper ---------------------------------------------------------------------

def test_rows_without_the_dropped_ones(spark, frame, rows):
    some = spark.range(-500, 500).withColumn("x", F.col("id") * 2)
    dropped = frame("id long", [(i,) for i in range(-500, 700, 7)])
    assert rows(without(some, dropped, "id"), "id") == [(i,) for i in range(-500, 500) if (i + 500) % 7]
    assert without(some, dropped.limit(0), "id").count() == 1000
    assert without(some.limit(0), dropped, "id").count() == 0
