import random
import re

import pytest
from pyspark.sql import functions as F

from daymetrics.functions import text as X


def expected_strip(s):
    """The clean-up with a standard regex engine, rule by rule."""
    for pattern, by in [(r"<[^>]+>", ""), (r"```[a-z]*", ""), (r"\*+", ""), (r"\n\s*\n\s*\n", "\n\n")]:
        s = re.sub(pattern, by, s)
    return s.strip()


HAND = [
    "",
    "   ",
    "plain",
    "<b>bold</b> <br/>",
    "a < b and c > d",
    "<> <<x>> <unclosed and more < text",
    "```python\ncode\n``` ```",
    "**strong** * item ***",
    "a\n\n\nb\n \n\t\n\nc",
    "a\n \n　\nb",
    "   x  \x1c",
    "​zero width stays​",
    "ends with newline\n",
    "<div\nclass='x'>multi\nline</div>",
    "$1 \\ backslash",
    None,
]


def test_strip_markup_by_hand_and_at_random(spark):
    rng = random.Random(3)
    parts = ["<", ">", "a", "b>", "`", "```", "```py", "*", "**", "\n", " ", "\t", " ", "\x1f", "é", "😀", "$", "\\"]
    texts = HAND + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.strip_markup(F.col("t")).alias("s")).collect():
        assert r["s"] == (None if r["t"] is None else expected_strip(r["t"])), repr(r["t"])


def test_blank_class_is_the_whole_set(spark):
    every = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    df = spark.createDataFrame([("x" + c + "x", c) for c in map(chr, range(1, 0x3100))], "t string, c string")
    found = df.where(F.regexp_replace("t", X.BLANK, "") == "xx").select("c").collect()
    assert {r["c"] for r in found} == set(every) == set(X.BLANKS)


def test_strip_markup_on_hostile_text(spark):
    """Texts that make a careless pattern quadratic."""
    n = 200_000
    df = spark.createDataFrame([("<" * n,), ("x" + " " * n + "x",), ("a\n" + " " * n,)], "t string")
    got = [r["s"] for r in df.select(X.strip_markup(F.col("t")).alias("s")).collect()]
    assert got == ["<" * n, "x" + " " * n + "x", "a"]


@pytest.mark.parametrize("size", [1, 3, 7, 4000])
def test_chunks_join_back(spark, size):
    long = "añ😀" * 9000
    texts = ["", "x", "😀" * size, "😀" * size + "y", long[: 64 * size], long[: 64 * size + 1], long[: size * 130], None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {}
    for r in X.chunk(df, "t", size).orderBy("id", "chunk_no").collect():
        got.setdefault(r["id"], []).append(r["chunk"])
        assert r["chunk_no"] == len(got[r["id"]]) - 1
    for i, t in enumerate(texts):
        want = [t[k : k + size] for k in range(0, len(t), size)] if t else []
        assert got.get(i, []) == want


@pytest.mark.parametrize(
    "x, digits, text",
    [(62.0, 1, "62.0"), (7.2, 1, "7.2"), (7.25, 2, "7.25"), (0.0, 1, "0.0"), (0.1, 1, "0.1"),
     (20000000.0, 1, "20000000.0"), (12345678.9, 1, "12345678.9"), (123456789.25, 2, "123456789.25"),
     (123456789.5, 2, "123456789.5"), (20000000.0, 2, "20000000.0"), (None, 1, None), (None, 2, None)],
)
def test_number_text(spark, x, digits, text):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(X.number_text(F.col("x"), digits).alias("t")).first()["t"] == text


def test_template(spark):
    got = spark.range(1).select(X.template("{a}-{b} {a}!", {"a": F.lit("x"), "b": F.lit("y")}).alias("t"))
    assert got.first()["t"] == "x-y x!"
