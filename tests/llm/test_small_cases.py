"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from daymetrics.llm import (
    histogram_sort, html_mincut, language, license_scan, maxscore, mixing, packing, quality, simhash, url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, extra string"
RULES = (url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"))


@pytest.fixture(scope="session")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture
def odd_docs(frame):
    """Null and empty texts, a long one, blanks only, repeated rows, null ids and null keys."""
    return frame(
        DOCS,
        [
            (1, None, "en", "a", "x"),
            (2, "", "en", "a", None),
            (3, "word " * 60_000, "en", "a", "x"),
            (4, " \t\n\x0b\f\r", "de", None, "x"),
            (5, "same text here and there", "de", "b", "x"),
            (5, "same text here and there", "de", "b", "x"),
            (None, "a text without an id", None, None, None),
            (6, "123 456", None, "b", "x"),
        ],
    )


def test_url_filter(frame, rows):
    pages = frame(
        "page_id long, url string, host string, verdict string",
        [
            (1, None, "h", "v"), (2, "", "h", "v"), (3, "no scheme casino", "h", "v"),
            (4, "http://A.Example.NET/en/x?q#f", "h", "v"), (5, "http://a.example.net/de/x", "h", "v"),
            (6, "http://x.org/free/bets", "h", "v"), (7, "http://x.org/freebets/winner", "h", "v"),
            (8, "http://x.org/free/free", "h", "v"), (9, "http://x.org", "h", "v"), (9, "http://x.org", "h", "v"),
            (10, "ftp://a.b/c://d/e", "h", "v"), (11, "http://x.org/" + "a" * 100_000 + "/casino", "h", "v"),
            (12, "http://annet/x", "h", "v"),
        ],
    )
    got = rows(url_filter.judge(pages, RULES), "page_id", "host", "rule", "verdict")
    assert got == [
        (1, "", None, "allow"), (2, "", None, "allow"), (3, "", None, "block"),
        (4, "a.example.net", "example.net/en/", "allow"), (5, "a.example.net", "net/", "block"),
        (6, "x.org", None, "block"), (7, "x.org", None, "allow"), (8, "x.org", None, "allow"),
        (9, "x.org", None, "allow"), (9, "x.org", None, "allow"), (10, "a.b", None, "allow"),
        (11, "x.org", None, "block"), (12, "annet", None, "allow"),
    ]
    assert rows(url_filter.judge(pages, RULES).where("page_id = 4"), "path") == [("/en/x",)]
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def test_license_scan(frame, odd_docs, rows):
    docs = frame(
        "doc_id long, text string, license string",
        [
            (1, "x\nLicensed under the APACHE license - version 2.0!\ny", "old"),
            (2, "Licensed under the Apache License, version 2.0, says who", "old"),
            (3, "All rights\nreserved.\n\nb", "old"),
            (4, "ALL RIGHTS RESERVED\nall rights reserved.", "old"),
            (5, None, "old"),
        ],
    )
    got = rows(license_scan.scan(docs), "doc_id", "license", "license_dice", "license_segments")
    assert got[0] == (1, "Apache-2.0", 1.0, 2)  # the line, and the paragraph of three lines
    assert got[1][1] == "Apache-2.0" and 0.8 <= got[1][2] < 1.0
    assert got[2] == (3, "All rights reserved", 1.0, 1)  # a paragraph of two lines
    assert got[3][3] == 2
    assert got[4] == (5, None, None, 0)
    assert license_scan.scan(odd_docs).count() == 8
    assert license_scan.scan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(docs, {"none": "..."})


def test_license_size_bounds_lose_nothing():
    for size in range(1, 60):
        low, high = license_scan.size_bounds(size, 0.8)
        for other in range(1, 200):
            reachable = 2 * min(size, other) / (size + other) >= 0.8 - 1e-12
            assert reachable == (low <= other <= high)


def test_quality_statistics(frame, odd_docs, rows):
    docs = frame(
        "doc_id long, text string, n_words long",
        [
            (1, "a b c a b c d", 99),  # windows abc (twice), bca, cab, bcd
            (2, "x x x x", 99),
            (3, "one #two\n\n \none #two\none", 99),
            (4, None, 99),
            (5, "é\u00a0ß 😀", 99),
        ],
    )
    got = rows(quality.statistics(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == [(1, 7, 7, 0, 0, 6), (2, 4, 4, 0, 0, 4), (3, 5, 17, 2, 1, 5), (4, 0, 0, 0, 0, 0), (5, 2, 4, 0, 0, 0)]
    labels = frame("doc_id long, quality int, toxic int", [(3, 1, 0), (5, None, 0), (None, 0, 0), (99, 7, 0)])
    judged = quality.judge(odd_docs, labels)
    assert judged.count() == 8
    assert [r["kept"] for r in judged.where("doc_id = 3").collect()] == [False]  # one word, repeated
    assert quality.judge(odd_docs.limit(0), labels.limit(0)).count() == 0


def test_language(odd_docs, frame, rows):
    rows_of = [(i, t, k, None, None) for i in range(300) for t, k in [("the and of with " * 8, "en"), ("der und die mit " * 8, "de")]]
    net = language.train([(r[2], r[1]) for r in rows_of[:40]], steps=40)
    got = rows(language.predict(odd_docs, net), "doc_id", "lang_pred")
    assert ((1, "und") in got) and ((2, "und") in got) and ((4, "und") in got) and ((6, "und") in got)
    odd = frame("doc_id long, text string", list(enumerate(["½ ² ① Ⅷ 12", "_ \u0301 -", "ª", "中", "½ x"])))
    assert [p == "und" for _, p in rows(language.predict(odd, net), "doc_id", "lang_pred")] == [True, True, False, False, False]
    learned = language.identify(frame(DOCS, rows_of))
    assert rows(learned.where("lang <> lang_pred"), "doc_id") == []
    assert {r[0] for r in rows(language.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))), "lang_pred")} == {"und"}
    assert language.identify(odd_docs.limit(0)).count() == 0


def test_mixing(odd_docs):
    got = mixing.mix(odd_docs.withColumn("topic", F.lit("clash"))).collect()
    assert len(got) == 8
    assert all(0.0 <= r["probability"] <= 1.0 and r["copies"] in (0, 1) for r in got)
    assert len({r["copies"] for r in got if r["doc_id"] == 5}) == 1
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_maxscore(frame, rows):
    vectors = frame(
        "vec_id long, embedding array<float>, score long",
        [
            (0, [1.0, -0.5], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1), (3, None, 1), (4, [], 1), (5, [1.0, None], 1),
            (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [1.0], 1), (50, [3e38, -3e38], 1),
            (None, [1.0, 1.0], 1), (1, [0.5, 0.5], 1),
        ],
    )
    got = rows(maxscore.search(vectors, F.col("vec_id") % 50 == 0, 3))
    half = 256 * 128 - 128 * 128
    most = (1 << 63) - 1  # a score beyond a long
    assert got == [
        (0, 1, 50, most), (0, 2, 1, half), (0, 3, 1, half),
        (50, 1, 0, most), (50, 2, 1, 0), (50, 3, 1, 0),
    ]
    assert maxscore.search(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_maxscore_of_large_components_is_exact(frame, rows):
    """Components beyond 524,288, sums beyond 2^53 that cancel or differ by one, and ties, next to
    ordinary rows: against Python's integers."""
    import math

    big = 2.0**45
    made = [
        (0, [1.0, 1.0, 2.0**-8]), (1, [big, -big, 1.0]), (2, [big, 2.0**-8 - big, 1.0]), (3, [6e5, 7e5, -8e5]),
        (4, [big + 2.0**-7, -big, 1.0]), (5, [0.5, -0.25, 3.0]), (6, [1.0, -1.0, 1e9]), (7, [big, -big, 1.0]),
        (8, [-big, big, 0.0]), (50, [3e6, -3e6, 5e5]), (100, [1e4, 1e4, 1e4]), (150, [0.0, 0.0, 0.0]),
    ]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in made}
    expected = []
    for i, q in whole.items():
        if i % 50 == 0:
            sums = {j: sum(a * b for a, b in zip(q, v, strict=True)) for j, v in whole.items() if j != i}
            scored = ((-min(2**63 - 1, max(-(2**63), s)), j) for j, s in sums.items())
            expected += [(i, rank, j, -score) for rank, (score, j) in enumerate(sorted(scored)[:5], 1)]
    assert any(2**53 < s < 2**63 - 1 for *_, s in expected)
    got = maxscore.search(frame("vec_id long, embedding array<double>", made), F.col("vec_id") % 50 == 0, shard_rows=4, query_rows=2)
    assert rows(got, "query_id", "rank", "vec_id", "score") == sorted(expected)


def shard_of(docs, n=5, split=1 << 20):
    text = F.coalesce(F.col("text"), F.lit(""))
    return histogram_sort.shard(docs, F.col("text"), F.col("doc_id"), F.octet_length(text) + 8, n, split_bytes=split)


def test_histogram_sort(odd_docs):
    got = shard_of(odd_docs.withColumn("slot", F.lit(1))).collect()
    assert len(got) == 8
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert shard_of(odd_docs.limit(0)).count() == 0


def test_simhash(odd_docs):
    got = {}
    for r in simhash.cluster(odd_docs).collect():
        got.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert len(got[5]) == 2 and got[5][0] == got[5][1]
    assert got[1] == got[2] == got[4] == [("0" * 16, 1)]  # no word: zero, linked
    assert got[None][0][1] is None  # its only document has no id
    assert simhash.cluster(odd_docs.limit(0)).count() == 0


def test_packing(odd_docs, tokenizer):
    pieces = packing.pack(odd_docs, tokenizer, 64).collect()
    assert sorted({r["doc_id"] for r in pieces if r["doc_id"] is not None}) == [1, 2, 3, 4, 5, 6]
    assert [(r["length"], r["doc_tokens"], r["opens"], r["closes"]) for r in pieces if r["doc_id"] == 1] == [(1, 1, True, True)]
    assert packing.pack(odd_docs.limit(0), tokenizer).count() == 0


def test_html(frame, rows):
    pages = frame(
        "page_id long, html string, text string, n_chars long",
        [
            (1, None, "old", 0), (2, "", "old", 0), (3, "<<<>>>", "old", 0),
            (4, "<nav>Menu of this site, with many words in it.</nav><article><h1>A &amp; B</h1><p>Text\n  of the&nbsp;"
                "article, long enough.<p>More of it &lt;here&gt;.", "old", 0),
            (4, "<nav>Menu of this site, with many words in it.</nav><article><h1>A &amp; B</h1><p>Text\n  of the&nbsp;"
                "article, long enough.<p>More of it &lt;here&gt;.", "old", 0),
            (5, "<div>" * 3000 + "<p>word " * 3000, "old", 0),
        ],
    )
    got = rows(html_mincut.extract(pages), "page_id", "text", "n_chars")
    text = "A & B\nText of the article, long enough.\nMore of it <here>."
    assert got[:3] == [(1, "", 0), (2, "", 0), (3, "", 0)] or got[2][0] == 3
    assert got[3] == got[4] == (4, text, len(text))
    assert html_mincut.extract(pages.limit(0)).count() == 0


def test_own_names_in_the_input_do_no_harm(odd_docs, frame):
    names = ["_words", "_lines", "_windows", "_repeated", "_found", "_s", "_best", "_fitting", "_source", "__source", "_h", "_piece"]
    docs = odd_docs.withColumns({n: F.lit(1) for n in names})
    assert quality.statistics(docs).count() == license_scan.scan(docs).count() == mixing.mix(docs).count() == 8
    assert shard_of(docs).count() == simhash.cluster(docs).count() == language.identify(docs).count() == 8
    pages = frame("page_id long, url string, html string, _rule int, _terms int, _got int", [(1, "http://a.b/c", "<p>x", 1, 1, 1)])
    assert url_filter.judge(pages, RULES).count() == html_mincut.extract(pages).count() == 1
