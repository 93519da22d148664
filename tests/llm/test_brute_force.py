"""Operators against plain versions of what they compute, on whole small tables."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from check_oracles import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymetrics.llm import html_mincut, language, maxscore, mixing, packing, quality, simhash
from daymetrics.llm import queries as Q
from daymetrics.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, Q.QUERIES[name], Q.ORACLES[name], SF) == ""


def test_extraction_matches_the_marked_articles(spark):
    import html
    import re

    for r in table(spark, SF, "pages").select("html").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (html.unescape(re.sub("</?b>", "", b)) for b in re.split(r"</?(?:p|h1|br)>", article))
        assert html_mincut.main_text(r["html"])[0] == "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def test_minimum_cut_is_minimal():
    draw = random.Random(3)
    for _ in range(150):
        n = draw.randint(1, 8)
        odds = [draw.choice([-3, -1, 0, 0.5, 2]) + draw.random() * 0.01 for _ in range(n)]
        edges = [(i, j, draw.random() * 2) for i in range(n) for j in range(i + 1, n) if draw.random() < 0.5]

        def cost(labels, odds=odds, edges=edges):
            own = sum(abs(o) for o, x in zip(odds, labels, strict=True) if (o > 0) != x)
            return own + sum(w for i, j, w in edges if labels[i] != labels[j])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_mincut.minimum_cut(odds, edges)) == pytest.approx(best)


def test_binomial_tail(spark):
    cases = [(0, 10, 0.05), (3, 900, 0.0125), (40, 5000, 0.0125), (2000, 200_000, 0.0125), (5, 10, 0.05)]
    for k, n, p in cases:
        got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        lg = math.lgamma
        exact = sum(
            math.exp(lg(n + 1) - lg(j + 1) - lg(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1)
        )
        assert got == pytest.approx(1.0 if k >= n * p else exact, rel=1e-7)


def test_certified_cutoffs_limit_the_loss(spark, frame):
    """Good documents seldom have symbols, bad ones always: the rule is found and spares the good."""
    words = "word" + " word{}" * 0
    rows, labels = [], []
    for i in range(3000):
        bad, slip = i % 5 == 0, i % 1000 == 1
        text = " ".join(f"w{i}x{j}{'#' if bad or slip else ''}" for j in range(60))
        rows.append((i, text, "en" if i % 3 else None))
        labels.append((i, 0 if bad else 1, 0))
    docs = frame("doc_id long, text string, lang string", rows)
    got = quality.judge(docs, frame("doc_id long, quality int, toxic int", labels)).select("doc_id", "kept").collect()
    good = [r["kept"] for r in got if r["doc_id"] % 5]
    assert not any(r["kept"] for r in got if r["doc_id"] % 5 == 0)
    assert good.count(False) / len(good) <= 0.05
    assert words


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = language.Network.new(["a", "b", "c"], 6, 3, rng)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    symbols, label = rng.integers(0, 257, (6, 5)), rng.integers(0, 3, 5)
    _, grads = net.gradients(symbols, label)
    for k, w in net.weights.items():
        for i in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(5)]:
            if k[0] == "x":
                i = (int(symbols[0, 0]), i[1])
            old, step = w[i], 1e-5
            w[i] = old + step
            up, _ = net.gradients(symbols, label)
            w[i] = old - step
            down, _ = net.gradients(symbols, label)
            w[i] = old
            assert grads[k][i] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-4)


def test_language_on_held_out_documents(spark):
    got = Q.op3_byte_gru(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    held = got.where("held_out").select("lang", "lang_pred").collect()
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.collect())


def test_long_texts_are_pooled_over_all_their_bytes():
    net = language.Network.new(["a", "b"], 4, 3, np.random.default_rng(0))
    text = bytes(range(1, 250)) * 9
    alone = net.probabilities(language.windows_of(text, 4).T).transpose(1, 0, 2).reshape(-1, 2)[: len(text)].mean(axis=0)
    old, language._WINDOWS = language._WINDOWS, 7
    try:
        assert np.allclose(language.pooled(net, [b"", text, b"x"])[1], alone, atol=1e-5)
    finally:
        language._WINDOWS = old


def test_raking_meets_the_targets(frame):
    cells = [("a", "en", 700), ("a", "de", 100), ("b", "en", 50), ("b", "de", 150), ("c", "en", 10)]
    table_ = frame("source string, lang string, tokens long", cells)
    sources, langs = {"a": 0.4, "b": 0.5, "c": 0.1}, {"en": 0.6, "de": 0.4}
    weighted, worst = mixing.rake(
        table_,
        {
            "source": frame("source string, target double", list(sources.items())),
            "lang": frame("lang string, target double", list(langs.items())),
        },
    )
    got = weighted.collect()
    for key, goal in (("source", sources), ("lang", langs)):
        for value, share in goal.items():
            assert sum(r["weight"] * r["tokens"] for r in got if r[key] == value) == pytest.approx(share, abs=1e-5)
    assert worst < 1e-5


def test_draws_follow_the_probabilities(spark, docs):
    got = Q.op4_raked_mix(spark, "/root/testdata/sf0.01").collect()
    expected = sum(r["probability"] * r["n_tokens"] for r in got)
    assert expected == pytest.approx(0.5 * sum(r["n_tokens"] for r in got), rel=1e-3)
    assert sum(r["copies"] for r in got) == pytest.approx(sum(r["probability"] for r in got), rel=0.15)


def test_shards(spark, docs):
    got = Q.op6_histogram_sort(spark, SF).collect()
    assert len(got) == len(docs)
    sizes = {}
    for r in got:
        text = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    share, largest = sum(sizes.values()) / 24, max(r["size"] for r in got)
    assert all(abs(x - share) <= 0.02 * share + largest for x in sizes.values())


def test_a_hot_group_spreads_over_shards(frame):
    docs = frame("doc_id long, text string", [(i, "copy" if i % 3 else f"text {i}") for i in range(3000)])
    from test_small_cases import shard_of

    got = shard_of(docs, 8, split=4000).collect()
    sizes = [sum(len(r["text"]) + 8 for r in got if r["shard"] == s) for s in range(8)]
    assert max(sizes) <= 1.05 * min(sizes)
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    changes = sum(a["text"] != b["text"] for a, b in itertools.pairwise(order))
    assert changes == len({r["text"] for r in got}) - 1  # equal texts lie together
    assert all([r["slot"] for r in order if r["shard"] == s] == list(range(sum(r["shard"] == s for r in got))) for s in range(8))


def components(prints, radius=3):
    """Smallest id reachable, by comparing all fingerprints."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius) + i + 1:
            a, b = sorted((root(x), root(ids[int(j)])))
            parent[b] = a
    return {i: root(i) for i in ids}


def plain_fingerprint(text):
    import xxhash

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_fingerprints(spark, docs):
    prints = {i: plain_fingerprint(r["text"]) for i, r in docs.items()}
    expected = components(prints)
    got = Q.op10_simhash_covering(spark, SF).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == prints
    assert {r["doc_id"]: r["component_id"] for r in got} == expected


@pytest.mark.parametrize("limit", [4096, 3])
def test_links_join_all_pairs_within_the_radius(spark, frame, limit):
    """Dense balls and far fingerprints, with and without dealing crowded buckets out again."""
    draw = random.Random(5)
    values = []
    for _ in range(6):
        base = draw.getrandbits(64)
        values += [base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for _ in range(40)]
    values += [draw.getrandbits(64) for _ in range(100)]
    prints = {simhash._signed(v): v for v in values}
    fps = frame("fp long", [(s,) for s in prints])
    found = simhash.components(simhash.links(fps, 3, limit))
    got = {s: s for s in prints} | {r["node"]: r["label"] for r in found.collect()}
    assert got == components(prints)


def test_covering_masks_cover():
    masks = simhash.covering_masks(range(12), 3)
    for bits in itertools.combinations(range(12), 3):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_packing_is_lossless(spark, docs):
    tokenizer = Tokenizer.from_file(__import__("public_tokenizers").path(Q.TOKENIZER))
    ids = {i: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1] for i, r in docs.items()}
    got = Q.op9_pack_windows(spark, SF).collect()
    back = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        back.setdefault(r["doc_id"], []).extend(piece)
    assert back == ids
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(filled) == list(range(len(filled)))
    assert [filled[s] for s in sorted(filled)][:-1] == [2048] * (len(filled) - 1)


def test_words_encode_as_whole_texts_do():
    encoder = packing.WordEncoder(__import__("public_tokenizers").path(Q.TOKENIZER))
    assert encoder.by_words
    texts = [
        "", " ", "Don't DON'T it's 5'5", "a\x1cb", "x\u0301 e\u0301", "<|endoftext|> hi<|startoftext|>x", "日本語 テスト 123",
        "a\u00a0b", "ª º µ × ÷ ½ ²", "ÀÉß straße ŒUVRE", "!!!??? #$% 12ab34", "x\u3000y \u0338= ≠", "🙂👍🏽 ok", "_a_ `x`", "\x00\x01",
    ]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), encoder.type).tolist() == encoder.whole(t).tolist()


def test_maxscore_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    ids, vectors = rng.permutation(5000), rng.integers(-40, 40, (5000, 16))
    vectors[:1500] = vectors[0]  # a third of all rows are one vector
    shard = maxscore.Shard(ids, vectors)
    for query_id, query in [(ids[0], vectors[0]), (ids[2000], vectors[2000]), (-1, np.zeros(16, int))]:
        score = vectors @ query
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != query_id][:5]
        got_ids, got = shard.top(query_id, query, 5, block=256)
        assert list(got_ids) == [ids[i] for i in order] and list(got) == [score[i] for i in order]
