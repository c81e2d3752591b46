"""Seeded property tests: Spark expressions against Python's own evaluation
of the same rules, many random inputs in one Spark job each."""

import random
import re

from tidewatch import constants as C
from tidewatch.functions import is_relevant, parse_counter


def _py_counter(s):
    if not s:
        return None
    m = re.search(r"([\d,\.]+)\s*(k|K)?\s*stars?", s, re.IGNORECASE)
    if not m:
        return None
    try:
        val = float(m.group(1).replace(",", ""))
    except ValueError:
        return None
    if m.group(2):
        val *= 1000
    return int(val)


def test_counter_parse_matches_python(spark):
    rng = random.Random(3)
    parts = ["1", "2", "07", ",", ".", " ", "k", "K", "stars", "star", "Stars", "STAR", "today", "x", "⭐"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.p for r in df.select("i", parse_counter("s").alias("p")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _py_counter(t), t


def test_relevance_matches_python(spark):
    rng = random.Random(4)
    original = re.compile("(" + "|".join(C.RELEVANCE_TERMS) + ")", re.IGNORECASE)
    parts = ["ai", "AI", "ml", "rag", "train", "model", "machine", "learning", "deep", "-", " ", "\n", "_",
             "é", "s", "1", "fine", "tun", "gpt", "x", "agent", "mail", "html"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.m for r in df.select("i", is_relevant("s").alias("m")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == bool(original.search(t)), repr(t)
