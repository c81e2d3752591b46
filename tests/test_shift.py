import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import shift as SH
from tidewatch.operators import vectors as V
from twins import tfidf_sims

D0 = dt.date(2024, 4, 1)


def _frame(spark, texts, scope="papers"):
    rows = [(scope, D0 + dt.timedelta(days=i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "scope string, date date, text string")


def test_text_shift_drops_blank_days(spark):
    texts = ["agent model", "", "agent chip", "model cost", "  ", "agent model cost"]
    df = _frame(spark, texts)
    day = D0 + dt.timedelta(days=len(texts) - 1)
    counts = spark.createDataFrame([("papers", 2)], "scope string, text_count long")
    out = SH.text_shift(V.term_counts(df), counts, df.select("date"), day).first()
    corpus = [t for t in texts[:-1] if t.strip()] + [texts[-1]]
    sims = tfidf_sims(corpus)
    mean = sum(sims) / len(sims)
    assert out.nonblank_history_days == 3 and out.history_days == 5
    assert out.mean_similarity == round(mean, 3) and out.capability_score == round(1 - mean, 3)
    assert out.trend == ("跃迁" if 1 - mean > 0.4 else "延续")


def test_text_shift_needs_three_nonblank_days(spark):
    df = _frame(spark, ["agent", "", "chip", "model"])
    counts = spark.createDataFrame([("papers", 1)], "scope string, text_count long")
    out = SH.text_shift(V.term_counts(df), counts, df.select("date"), D0 + dt.timedelta(days=3)).first()
    assert out.capability_score is None and out.trend == "unknown" and out.nonblank_history_days == 2


def test_novelty_series_pairs_and_blank(spark):
    texts = ["agent model gpu", "agent model chip", "", "law risk fund"]
    df = _frame(spark, texts)
    day = D0 + dt.timedelta(days=3)
    got = {r.date: r.novelty for r in
           SH.novelty_series(V.term_counts(df), df.select("date"), df.select("scope").distinct(), day).collect()}
    assert len(got) == 3
    assert got[D0 + dt.timedelta(days=2)] == 0.0 and got[D0 + dt.timedelta(days=3)] == 0.0
    want = round(1 - tfidf_sims(texts[:2], 3000)[0], 3)
    assert got[D0 + dt.timedelta(days=1)] == pytest.approx(want)
