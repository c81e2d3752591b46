import datetime as dt
import random

from tidewatch.operators import keywords as KW
from twins import keyword_trends

D = dt.date(2024, 5, 31)


def _frame(spark, history, today):
    rows = []
    for i, kws in enumerate(history):
        day = D - dt.timedelta(days=len(history) - i)
        rows += [(day, k) for k in kws]
    rows += [(D, k) for k in today]
    return spark.createDataFrame(rows, "date date, kw string")


def _lists(spark, history, today, days=30):
    t = KW.keyword_trends(_frame(spark, history, today), D, days=days)
    out = {"new": [], "rising": [], "fading": []}
    for r in t.collect():
        out[r.kind].append(r.kw)
    return {k: sorted(v) for k, v in out.items()}


def test_five_or_fewer_records(spark):
    history = [{"a", "b"}, {"a"}, {"c"}, {"c"}, {"c"}]
    got = _lists(spark, history, {"a", "b", "z"})
    assert got["new"] == ["z"]
    assert got["rising"] == ["a"]          # 2 of 5 recent records, older rate 0
    assert got["fading"] == []             # c is in the last five


def test_no_keywords_today_reports_nothing(spark):
    rows = [(D - dt.timedelta(days=1), "a")]
    df = spark.createDataFrame(rows, "date date, kw string")
    assert KW.keyword_trends(df, D).count() == 0


def test_random_against_twin(spark):
    rng = random.Random(7)
    vocab = [f"k{i}" for i in range(12)]
    for _ in range(3):
        n = rng.randint(3, 12)
        history = [set(rng.sample(vocab, rng.randint(0, 5))) for _ in range(n)]
        history = [h for h in history if h] or [{"k0"}]
        today = set(rng.sample(vocab, rng.randint(1, 5)))
        assert _lists(spark, history, today) == keyword_trends(history, today)


def test_lists_first_ten_sorted(spark):
    today = {f"n{i:02d}" for i in range(15)}
    t = KW.keyword_trends(_frame(spark, [{"x"}], today), D)
    lists = KW.keyword_lists(t).collect()
    assert [r.kw for r in lists if r.kind == "new"] == sorted(today)[:10]
