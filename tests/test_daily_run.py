import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tidewatch.plans.daily_run import RunPaths, daily_run
from tidewatch.streaming import streams as ST


def _inputs(spark, day_no):
    items = spark.createDataFrame(
        [("A", "papers", f"t{i}", f"https://a/{i}", "s", "", i) for i in range(day_no, day_no + 4)] +
        [("B", "industry", f"t{i}", f"https://a/{i}", "", "", i) for i in range(day_no + 2, day_no + 6)],
        "source string, category string, title string, url string, summary string, published string, pos long")
    catalog = spark.createDataFrame([("A", 0, "RSS"), ("B", 1, "scrape"), ("C", 2, "API")],
                                    "source string, src_rank int, method string")
    papers = spark.createDataFrame([(f"agent model day {day_no}", "inference cost falls", 1)],
                                   "title string, abstract string, pos long")
    repos = spark.createDataFrame([("org/a", f"{100 + day_no} stars today", 1), ("org/b", "1.2k stars", 2)],
                                  "repo string, stars string, pos long")
    models = spark.createDataFrame([("m1", 1000 + day_no, 1)], "model_id string, downloads long, pos long")
    return items, catalog, papers, repos, models


def test_daily_run_order_and_rerun(spark):
    paths = RunPaths(tempfile.mkdtemp(prefix="tw-run-"))
    for k, day in enumerate(["2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04"]):
        out = daily_run(spark, day, paths, *_inputs(spark, k), cap=3)
    trend = out["trend"].first()
    assert trend.history_days == 3 and trend.has_enough_history      # today is not part of its own history
    first = {r.aid for r in out["accepted"].collect()}
    # a rerun of the day finds its accepted ids registered; only items that were
    # beyond a source's cap can come in now
    out = daily_run(spark, "2024-03-04", paths, *_inputs(spark, 3), cap=3)
    again = {r.aid for r in out["accepted"].collect()}
    assert first and not (first & again)
    stats = {r.source: r for r in out["stats"].collect()}
    assert stats["C"].status == "fail" and stats["A"].fetched == 4
    hist = spark.read.parquet(paths.history)
    assert hist.count() == 4
    m = out["metrics"].first()
    assert m.github_stars.repo_count == 2 and m.huggingface_downloads.total_downloads == 1003
    assert out["bundle"].first().text.startswith("## 今日结构分析")
    assert spark.read.parquet(paths.run_log).count() == 5


def test_foreach_batch_ingest_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="tw-fb-")
    reg, items = os.path.join(base, "reg"), os.path.join(base, "items")
    fn = ST.ingest_batches(reg, items)
    b0 = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", 2, "z")], "aid string, pos long, title string")
    b1 = spark.createDataFrame([("b", 0, "w"), ("c", 1, "v")], "aid string, pos long, title string")
    fn(b0, 0)
    fn(b1, 1)
    fn(b1, 1)   # replay
    got = sorted((r.aid, r.title) for r in spark.read.parquet(items).collect())
    assert got == [("a", "y"), ("b", "z"), ("c", "v")]


def test_day_without_papers_and_items(spark):
    paths = RunPaths(tempfile.mkdtemp(prefix="tw-empty-"))
    items, catalog, papers, repos, models = _inputs(spark, 0)
    out = daily_run(spark, "2024-03-01", paths, items.limit(0), catalog, papers.limit(0), repos, models)
    assert out["accepted"].count() == 0 and out["digest"].count() == 5
    m = out["metrics"].first()
    assert not m.arxiv_capability.has_data and m.arxiv_capability.message and m.arxiv_capability.paper_count == 0
    assert m.github_stars.has_data and m.github_stars.history_days == 0
    # the next day has papers but neither repos nor models; the first day still counts as a snapshot day
    out = daily_run(spark, "2024-03-02", paths, items, catalog, papers, repos.limit(0), models.limit(0))
    m = out["metrics"].first()
    assert m.arxiv_capability.has_data and m.arxiv_capability.history_days == 0 and m.arxiv_capability.trend == "unknown"
    assert not m.github_stars.has_data and m.github_stars.top_growth == [] and m.huggingface_downloads.model_count == 0
    charts = {(r.metric, r.date.isoformat()): r.value for r in out["charts"].collect()}
    assert charts == {("stars", "2024-03-01"): 1300.0, ("stars", "2024-03-02"): 0.0, ("downloads", "2024-03-01"): 1000.0,
                      ("downloads", "2024-03-02"): 0.0, ("novelty", "2024-03-02"): 0.0}


def test_rerun_with_an_empty_day_replaces_it(spark):
    paths = RunPaths(tempfile.mkdtemp(prefix="tw-rerun-"))
    items, catalog, papers, repos, models = _inputs(spark, 0)
    daily_run(spark, "2024-03-01", paths, items, catalog, papers, repos, models)
    out = daily_run(spark, "2024-03-01", paths, items, catalog, papers, repos.limit(0), models)
    assert not out["metrics"].first().github_stars.has_data
    assert os.listdir(paths.digest) and os.listdir(paths.references) and os.listdir(paths.latest)
