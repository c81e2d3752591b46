import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions import parse_counter
from tidewatch.operators import counters as CT

D = dt.date(2024, 2, 28)


def _fact(spark, rows):
    return spark.createDataFrame(rows, "date date, key string, value long, pos long")


def test_growth_against_historical_maximum(spark):
    rows = [(D - dt.timedelta(days=3), "r", 10, 1), (D - dt.timedelta(days=2), "r", 50, 1),
            (D - dt.timedelta(days=1), "r", 20, 1), (D, "r", 40, 1)]
    g = CT.counter_growth(_fact(spark, rows), D).first()
    assert g.prev_max == 50 and g.growth_pct == -0.2 and not g.is_new


def test_new_and_zero_history(spark):
    rows = [(D, "new", 5, 1), (D - dt.timedelta(days=1), "zero", 0, 1), (D, "zero", 3, 2)]
    g = {r.key: r for r in CT.counter_growth(_fact(spark, rows), D).collect()}
    assert g["new"].is_new and g["new"].growth_pct is None
    assert not g["zero"].is_new and g["zero"].growth_pct is None


def test_last_value_of_day_wins_and_unparsed_drops(spark):
    rows = [(D, "a", "10 stars", 1), (D, "a", "junk", 2), (D, "b", "junk", 1), (D, "b", "7 stars", 2)]
    df = spark.createDataFrame(rows, "date date, key string, stars string, pos long")
    fact = df.select("date", "key", parse_counter("stars").alias("value"), "pos")
    g = {r.key: r.value for r in CT.counter_growth(fact, D).collect()}
    assert g == {"b": 7}
    st = CT.counter_state(fact, D)
    assert st.count() == 2          # the key count still counts the unparsed one


def test_window_excludes_older_than_lookback(spark):
    rows = [(D - dt.timedelta(days=31), "r", 100, 1), (D - dt.timedelta(days=30), "r", 10, 1), (D, "r", 20, 1)]
    g = CT.counter_growth(_fact(spark, rows), D).first()
    assert g.prev_max == 10 and g.growth_pct == 1.0


def test_top_lists(spark):
    rows = [(D, f"k{i}", i, 20 - i) for i in range(15)] + [(D - dt.timedelta(days=1), f"k{i}", 1, 1) for i in range(12)]
    g = CT.counter_growth(_fact(spark, rows), D)
    assert [r.key for r in CT.top_values(g).collect()][:3] == ["k14", "k13", "k12"]
    assert [r.key for r in CT.new_entities(g).collect()] == ["k14", "k13", "k12"]   # input order by pos
    assert CT.top_growth(g).count() == 10


def test_series_zero_fill_and_ticks(spark):
    rows = [(D - dt.timedelta(days=i), "x", "1,000 stars", 1) for i in (0, 2, 5)]
    stars = spark.createDataFrame(rows, "date date, repo string, stars string, pos long")
    spine = spark.createDataFrame([(D - dt.timedelta(days=i),) for i in range(15)], "date date")
    from tidewatch.functions import counter_or_zero
    s = CT.daily_series(stars, D, counter_or_zero("stars"), metric="stars", spine=spine)
    vals = {r.date: r.value for r in s.collect()}
    assert len(vals) == 15 and vals[D] == 1000 and vals[D - dt.timedelta(days=1)] == 0
    ct = CT.chart_table(s.withColumn("value", F.col("value").cast("double"))).orderBy("date").collect()
    assert [r.show_tick for r in ct] == [i % 2 == 0 for i in range(15)]   # a tick every 15 // 7 = 2 days
    assert ct[-1].label == D.strftime("%m-%d")
