"""Expected marginals of the final probabilities, with and without a bound on copies."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from daymetrics.llm import mixing
from daymetrics.llm import queries as Q
from daymetrics.llm.common import table

SF = "/root/testdata/sf0.01"


def deviation(rows, keys=("source", "lang", "topic"), exponent=0.7):
    """The largest distance of an expected marginal from the tempered share of all tokens."""
    worst, drawn = 0.0, sum(r["probability"] * r["n_tokens"] for r in rows)
    for key in keys:
        held, got = {}, {}
        for r in rows:
            held[r[key]] = held.get(r[key], 0) + r["n_tokens"]
            got[r[key]] = got.get(r[key], 0) + r["probability"] * r["n_tokens"]
        whole = sum(n**exponent for n in held.values())
        worst = max(worst, *(abs(got[v] / drawn - held[v] ** exponent / whole) for v in held))
    return worst


def test_the_query_has_the_target_marginals(spark):
    got = Q.op4_raked_mix(spark, SF).collect()
    assert deviation(got) < 1e-5
    assert any(r["probability"] > 1 for r in got) and all(0 <= r["copies"] - int(r["probability"]) <= 1 for r in got)


def test_a_bound_keeps_the_marginals_and_lowers_the_rate(spark):
    got = mixing.mix(table(spark, SF, "documents"), rate=P.RATE).collect()
    assert deviation(got) < 1e-5 and max(r["probability"] for r in got) <= 1
    rate = sum(r["probability"] * r["n_tokens"] for r in got) / sum(r["n_tokens"] for r in got)
    assert 0.35 < rate < 0.5  # a tempered share of the rarest value allows 0.38


def test_plan_under_a_bound(frame):
    cells = frame("a string, b string, tokens long", [("x", "p", 900), ("x", "q", 50), ("y", "p", 30), ("y", "q", 20)])
    goals = {
        "a": frame("a string, target double", [("x", 0.6), ("y", 0.4)]),
        "b": frame("b string, target double", [("p", 0.7), ("q", 0.3)]),
    }
    for most, kept in ((None, 0.5), (4, 0.5), (1, 0.125)):  # y has 50 of 1000 tokens for 0.4 of the sample
        planned, rate, off = mixing.plan(cells, goals, 0.5, most)
        got = planned.withColumn("mass", F.col("probability") * F.col("tokens") / (1000 * rate)).collect()
        assert rate == pytest.approx(kept) and off <= 1e-6 and all(r["probability"] <= (most or 99) for r in got)
        assert sum(r["mass"] for r in got if r["a"] == "y") == pytest.approx(0.4, abs=1e-5)
        assert sum(r["mass"] for r in got if r["b"] == "q") == pytest.approx(0.3, abs=1e-5)
