import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import vectors as V
from twins import tfidf_sims

WORDS = ["ai", "model", "agent", "chip", "gpu", "rag", "cost", "law", "fund", "risk", "über", "Été", "x"]
D0 = dt.date(2024, 3, 1)


def _texts(rng, n_days, blank_p=0.2):
    out = []
    for i in range(n_days):
        if rng.random() < blank_p:
            out.append(rng.choice(["", "   "]))
        else:
            out.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 12))))
    return out


def _spark_sims(spark, per_scope, max_features):
    rows = []
    for scope, texts in per_scope.items():
        for i, t in enumerate(texts):
            rows.append((scope, D0 + dt.timedelta(days=i), t))
    df = spark.createDataFrame(rows, "scope string, date date, text string")
    n_days = max(len(t) for t in per_scope.values())
    day = D0 + dt.timedelta(days=n_days - 1)
    tf = V.term_counts(df)
    members = V.day_members(df.select("date"), df.select("scope").distinct(), day, n_days - 1)
    sims = V.tfidf_similarity(tf, members, max_features=max_features)
    got = {}
    for r in sims.collect():
        got.setdefault(r.scope, {})[(r.date - D0).days] = r.sim
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_similarity_matches_python_twin(spark, seed):
    rng = random.Random(seed)
    per_scope = {f"s{k}": _texts(rng, 6) for k in range(4)}
    max_features = 12 if seed == 2 else 5000  # seed 2 cuts the vocabulary (ties by term)
    got = _spark_sims(spark, per_scope, max_features)
    for scope, texts in per_scope.items():
        want = tfidf_sims(texts, max_features)
        if want is None:
            assert scope not in got
            continue
        assert sorted(got[scope]) == list(range(len(texts) - 1))
        for i, w in enumerate(want):
            assert got[scope][i] == pytest.approx(w, abs=1e-12)


def test_blank_day_has_zero_similarity_and_counts(spark):
    per_scope = {"t": ["agent model", "", "agent model chip", "agent model"]}
    got = _spark_sims(spark, per_scope, 5000)["t"]
    assert got[1] == 0.0 and len(got) == 3
    want = tfidf_sims(per_scope["t"])
    assert [got[i] for i in range(3)] == pytest.approx(want, abs=1e-12)


def test_fewer_than_two_nonblank_texts_give_nothing(spark):
    assert _spark_sims(spark, {"t": ["", " ", "agent"]}, 5000) == {}


def test_term_counts_add_up_over_rows(spark):
    rows = [("s", D0, "Agent model"), ("s", D0, "agent")]
    df = spark.createDataFrame(rows, "scope string, date date, text string")
    tf = {r.term: r.tf for r in V.term_counts(df).collect()}
    assert tf[" ag"] == 2 and tf["nt "] == 2 and tf[" mo"] == 1


def test_merge_scopes_is_concatenation(spark):
    rows = [("a", D0, "agent"), ("b", D0, "agent chip")]
    df = spark.createDataFrame(rows, "scope string, date date, text string")
    merged = {r.term: r.tf for r in V.merge_scopes(V.term_counts(df)).collect()}
    direct = {r.term: r.tf for r in V.term_counts(df.withColumn("scope", F.lit("_combined"))).collect()}
    assert merged == direct
