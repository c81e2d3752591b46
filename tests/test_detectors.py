import datetime as dt

from tidewatch.operators import detectors as DT


def _sims(spark, values, scope="technology"):
    base = dt.date(2024, 1, 1)
    rows = [(scope, base + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "scope string, date date, sim double")


def _m(spark, values, **kw):
    return DT.trend_measures(_sims(spark, values), params=DT.TrendParams(**kw), keep_raw=True).first()


def test_spike_fires(spark):
    m = _m(spark, [0.1, 0.1, 0.6, 0.6, 0.6])
    assert m.spike and m.recent_sim == 0.6 and m.older_sim == 0.1 and m.spike_confidence == 1.0


def test_spike_needs_older_part(spark):
    m = _m(spark, [0.9, 0.9, 0.9])
    assert not m.spike and m.older_sim is None


def test_continuous_fires(spark):
    m = _m(spark, [0.2, 0.3, 0.4, 0.5])
    assert m.continuous and m.monotonic_ratio == 1.0 and m.trend_days == 5


def test_continuous_falling(spark):
    m = _m(spark, [0.9, 0.8, 0.7, 0.6])
    assert not m.continuous and m.monotonic_ratio == 0.25


def test_continuous_uses_last_seven_records(spark):
    m = _m(spark, [0.9, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8])
    assert m.trend_days == 8 and m.up_steps == 7 and m.monotonic_ratio == 1.0


def test_identical_day_counts_as_non_decreasing(spark):
    m = _m(spark, [0.5, 0.6, 0.7, 1.0000000000000002])
    assert m.up_steps == 4 and m.monotonic_ratio == 1.0


def test_emerging_fires_and_sorts_last(spark):
    m = _m(spark, [0.05, 0.1, 0.0])
    assert m.emerging and m.max_sim == 0.1 and m.mean_sim == 0.05 and m.novelty_score == 0.9
    both = _sims(spark, [0.05, 0.1, 0.0]).unionByName(_sims(spark, [0.2, 0.3, 0.4, 0.5], "risk"))
    sig = DT.signal_order(DT.trend_signals(DT.trend_measures(both, keep_raw=True))).collect()
    assert [s.type for s in sig] == ["continuous_trend", "sudden_spike", "emerging_topic"]
    assert sig[1].confidence == 0.67
    assert sig[2].confidence is None and sig[2].novelty_score == 0.9
    assert sig[0].dimension == "风险信号"
    assert sig[0].description.startswith("风险信号的话题向量在最近5天内")


def test_spike_description_two_decimals(spark):
    m = DT.trend_measures(_sims(spark, [0.1, 0.1, 0.6, 0.6, 0.6]), keep_raw=True)
    s = DT.trend_signals(m).filter("type = 'sudden_spike'").first()
    assert "(0.60)" in s.description and "(0.10)" in s.description


def test_shift_label_gradual_unreachable(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.5, 0.5), (0.3, 0.7), (0.45, 0.55)], "nov double, mean double")
    got = [r[0] for r in df.select(DT.shift_label(F.col("nov"), F.col("mean"))).collect()]
    assert got == ["跃迁", "延续", "跃迁"]


def test_signal_ranks_break_ties_in_production_order(spark):
    rows = [("sudden_spike", "risk", None, 4, 0), ("emerging_topic", "technology", None, 0, 2), ("continuous_trend", "risk", 0.7, 4, 1),
            ("sudden_spike", "technology", 0.7, 0, 0), ("sudden_spike", "capital", 0.9, 3, 0)]
    signals = spark.createDataFrame(rows, "type string, dimension string, confidence double, dim_rank int, type_rank int")
    got = [(r.type, r.dimension) for r in DT.signal_ranks(signals).orderBy("rank").collect()]
    assert got == [("sudden_spike", "capital"), ("sudden_spike", "technology"), ("continuous_trend", "risk"),
                   ("emerging_topic", "technology"), ("sudden_spike", "risk")]
    assert [(r.type, r.dimension) for r in DT.signal_order(signals).collect()] == got
