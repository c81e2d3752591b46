"""The daily run (R5) as one driver function over DataFrames and stores.

Order of steps (as in the original pipeline, with the registry written only
after the accepted items are stored):

1. ingest: harvested items -> ids -> capped first-wins dedup against the registry
   -> the run's items appended -> registry appended -> per-source statistics
   (a failure between the two appends lets a rerun take those items again);
2. snapshot facts written for the day (papers, repos, models) and the day's marker: a day
   without papers is a snapshot day too;
3. metrics report from the metrics store (lookback excludes the day);
4. analysis document (given, else the empty one);
5. trend report from the history store **before** the day is written, then the
   day's history record and its term counts are written (a rerun replaces the
   day).  Term counts of past days never change, so they are kept in a
   date-partitioned term store: a run tokenizes only its own day.  The corpus statistics
   (counts and document frequencies) are a stored state: a run adds its day and takes
   back the day that leaves; the window's counts are read only where they meet the vocabulary;
6. chart table from the metrics store (window includes the day);
7. bundle and run summary, appended to the run log; digest and reference list as text, the
   reports as the latest JSON.

Paths are folders on shared storage; a day is replaced as a whole, and every store is read with
an explicit schema, so a day without rows or a first run needs no special case.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch import constants as C
from tidewatch.functions.counters import counter_or_zero
from tidewatch.operators import analysis as AN
from tidewatch.operators import counters as CT
from tidewatch.operators import ingest as IG
from tidewatch.operators import reports as RP
from tidewatch.operators import rolling as RL
from tidewatch.operators import shift as SH
from tidewatch.operators import vectors as V
from tidewatch.operators._util import cut_lineage, window_filter
from tidewatch.plans import reports as PR
from tidewatch.sources import harvest as HV
from tidewatch.sources import registry as RG
from tidewatch.sources import store as S


@dataclass(frozen=True)
class RunPaths:
    root: str

    def __getattr__(self, name: str) -> str:  # items, registry, history, papers, repos, models, run_log
        return os.path.join(self.root, name)


def _terms_window(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Stored term counts of ``[d-30, d-1]`` (partition-pruned), empty when none."""
    stored = S.read_store(spark, path, "scope string, term string, tf bigint")
    return window_filter(stored, day, C.LOOKBACK_DAYS).select("scope", "date", "term", "tf")


def daily_run(spark: SparkSession, day: str, paths: RunPaths, items: DataFrame, catalog: DataFrame,
              papers: DataFrame, repos: DataFrame, models: DataFrame,
              analysis: DataFrame | None = None, usage: DataFrame | None = None,
              cap: int = C.ITEMS_PER_SOURCE) -> dict[str, DataFrame]:
    """Run one day; returns the day's report frames.

    ``items``: harvested items (``source, category, title, url, summary, published, pos``);
    ``catalog``: ``source, src_rank, method``; ``papers``: ``title, abstract, pos``;
    ``repos``: ``repo, stars, pos``; ``models``: ``model_id, downloads, pos``.
    """
    d = F.to_date(F.lit(day))
    # 1 ingest
    raw = IG.with_item_id(items)
    seen = RG.read_ids(spark, paths.registry)
    accepted = IG.dedup_capped(raw, catalog, seen, cap=cap)
    # items of every run are kept (a rerun of the day may accept items that were
    # beyond a source's cap before); the registry is appended after they are stored
    run_id = uuid.uuid4().hex
    stored = accepted.withColumn("run_id", F.lit(run_id))
    stored.write.mode("append").parquet(f"{paths.items}/date={day}")
    written = S.read_store(spark, paths.items, stored.schema).filter((F.col("date") == d) & (F.col("run_id") == run_id))
    RG.append_ids(written, paths.registry)
    RG.merge_if_needed(spark, paths.registry)
    stats = IG.ingest_stats(raw, written, catalog)

    # 2 snapshot facts of the day
    S.replace_day(papers, paths.papers, day)
    S.replace_day(repos, paths.repos, day)
    S.replace_day(models, paths.models, day)
    S.replace_day(spark.range(1).select(F.col("id").alias("marker")), paths.snapshot_days, day)
    p_all = S.read_store(spark, paths.papers, papers.schema)
    r_all = S.read_store(spark, paths.repos, repos.schema)
    m_all = S.read_store(spark, paths.models, models.schema)
    snapshot_days = S.read_store(spark, paths.snapshot_days, "marker bigint").select("date")

    # 3 metrics report (paper term counts: only today's texts are tokenized, from their stored day)
    today_papers = HV.paper_texts(p_all.filter(F.col("date") == d)).select("date", F.lit("papers").alias("scope"), "text")
    S.replace_day(V.term_counts(today_papers), paths.paper_terms, day)
    paper_tf = window_filter(S.read_store(spark, paths.paper_terms, "scope string, term string, tf bigint"),
                             day, C.LOOKBACK_DAYS + 1, inclusive=True)
    counts = today_papers.groupBy("scope").agg(F.count("*").alias("text_count"))
    metrics = PR.metrics_report(day, paper_tf, snapshot_days, counts, r_all,
                                m_all.select("date", F.col("model_id").alias("key"),
                                             F.col("downloads").alias("value"), "pos"), snapshot_days=snapshot_days)

    # 4 analysis document
    if analysis is None:
        analysis = AN.default_analysis(spark, day)

    # 5 trend report before the day is stored, then the history record
    record = AN.history_records(analysis)
    hist = window_filter(S.read_store(spark, paths.history, record.schema), day, C.LOOKBACK_DAYS)
    hist_dates = hist.select("date")
    hist_kw = hist.select("date", F.explode("keywords").alias("kw"))
    today_texts = AN.day_texts(analysis)
    S.replace_day(V.term_counts(today_texts), f"{paths.terms}_today", day)
    today_tf = S.read_store(spark, f"{paths.terms}_today", "scope string, term string, tf bigint").filter(F.col("date") == d)
    tf = _terms_window(spark, paths.terms, day).unionByName(today_tf.select("scope", "date", "term", "tf"))
    records = hist_dates.unionByName(today_texts.select("date"))
    keywords = hist_kw.unionByName(AN.day_keywords(analysis))
    every_term = S.read_store(spark, paths.terms, "scope string, term string, tf bigint").select("scope", "date", "term", "tf")
    state = RL.update_state(every_term, today_tf, paths.term_state, day)
    trend = cut_lineage(PR.trend_report(tf, records, keywords, day, state=state))
    S.replace_day(record, paths.history, day)
    S.replace_day(today_tf, paths.terms, day)

    # 6 chart table (window includes the day)
    stars = CT.daily_series(r_all, day, counter_or_zero("stars"), metric="stars", spine=snapshot_days)
    downloads = CT.daily_series(m_all, day, F.coalesce("downloads", F.lit(0)), metric="downloads", spine=snapshot_days)
    novelty = SH.novelty_series(paper_tf, snapshot_days, spark.createDataFrame([("papers",)], "scope string"), day)
    series = (stars.withColumn("value", F.col("value").cast("double"))
              .unionByName(downloads.withColumn("value", F.col("value").cast("double")))
              .unionByName(novelty.select(F.lit("novelty").alias("metric"), "date", F.col("novelty").alias("value"))))
    # charts need two snapshot days; the novelty curve then has one point less
    enough = window_filter(snapshot_days.distinct(), day, C.LOOKBACK_DAYS, inclusive=True).select(F.count("*")).scalar() >= 2
    charts = CT.chart_table(series.filter(enough), min_days=1)

    # 7 bundle and run summary
    bundle = PR.bundle(day, analysis, trend, metrics, charts)
    usage = usage if usage is not None else spark.createDataFrame(
        [], "stage string, model string, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint")
    summary = RP.run_summary(stats, usage, trend.select(
        F.size("signals").cast("bigint").alias("trend_signals"), "history_days", "has_enough_history", "overall_novelty",
        *[F.array_join(F.col("keyword_trends")[f"{k}_keywords"], ", ").alias(f"{k}_keywords") for k in ("new", "rising", "fading")]))
    summary = summary.withColumn("date", d)
    S.append_run_log(summary, paths.run_log)
    S.append_run_log(stats.drop("src_rank").withColumn("date", d), f"{paths.run_log}_sources")
    categories = items.select("source", "category").groupBy("source").agg(F.min("category").alias("category"))
    digest = RP.digest_lines(written, day)
    references = RP.reference_list(RP.evidence_rows(analysis), categories)
    S.write_text(digest, f"{paths.digest}/date={day}")
    S.write_text(references, f"{paths.references}/date={day}")
    S.write_latest_json(bundle, paths.latest)
    return {"accepted": written, "stats": stats, "metrics": metrics, "trend": trend, "charts": charts,
            "bundle": bundle, "summary": summary, "tokens": RP.token_totals(usage), "digest": digest, "references": references}
