"""Text-shift measures built on the corpus-keyed similarity (M1, M5).

* :func:`text_shift`: a day's text against its *non-blank* history days only
  (blank days leave the corpus, unlike the trend detectors); needs at least
  ``min_history`` non-blank days; label by novelty / mean thresholds.
* :func:`novelty_series`: each existing day against the previous existing day,
  each pair its own two-document corpus (vocabulary ``max_features``);
  0.0 when either text is blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.functions.rounding import py_round
from tidewatch.operators._util import broadcast_if_bounded, cut_lineage, day_lit, materialized, window_filter
from tidewatch.operators.detectors import shift_label
from tidewatch.operators.vectors import above_cut, histogram_cuts, tfidf_similarity


def nonblank_days(tf: DataFrame, keys: tuple[str, ...] = ("scope",)) -> DataFrame:
    """``(keys..., date)`` of documents with at least one term (non-blank)."""
    return tf.select(*keys, "date").distinct()


def text_shift(tf: DataFrame, today_counts: DataFrame, records: DataFrame, day,
               days: int = C.LOOKBACK_DAYS, min_history: int = C.MIN_HISTORY_DAYS,
               max_features: int = C.MAX_FEATURES) -> DataFrame:
    """Per scope: ``scope, has_data, message, history_days, nonblank_history_days,
    text_count, capability_score, mean_similarity, trend`` (M1, P17).

    ``today_counts``: ``(scope, text_count)`` of the day's texts (non-empty);
    ``records``: the existing record days (``date``), blank or not.  A scope with history
    but without text today has ``has_data = false``.  With fewer than ``min_history``
    non-blank history days there is a message, no score, trend ``unknown``, and ``history_days`` are
    the non-blank ones; else ``history_days`` are all record days.
    """
    d = day_lit(day)
    hist_nb = window_filter(nonblank_days(tf), day, days)
    n_records = window_filter(records.select("date").distinct(), day, days).select(F.count("*")).scalar()
    nb_counts = hist_nb.groupBy("scope").agg(F.count("*").alias("nonblank_history_days"))
    scopes = (today_counts.select("scope", "text_count").join(nb_counts, "scope", "full")
              .select("scope", F.coalesce("text_count", F.lit(0)).alias("text_count"),
                      F.coalesce("nonblank_history_days", F.lit(0)).alias("nonblank_history_days")))
    eligible = scopes.filter((F.col("text_count") > 0) & (F.col("nonblank_history_days") >= min_history)).select("scope")
    members = (hist_nb.join(eligible, "scope", "left_semi").withColumn("is_query", F.lit(False))
               .unionByName(eligible.select("scope", d.alias("date"), F.lit(True).alias("is_query"))))
    sims = tfidf_similarity(tf, members, max_features=max_features, min_nonblank=1)
    agg = sims.groupBy("scope").agg(F.avg("sim").alias("mean_sim"))
    out = scopes.join(agg, "scope", "left").withColumn("_records", n_records)
    ok, has_data = F.col("mean_sim").isNotNull(), F.col("text_count") > 0
    novelty = 1.0 - F.col("mean_sim")
    return out.select(
        "scope", has_data.alias("has_data"),
        F.when(~has_data, C.NO_TEXT_TODAY).when(~ok, C.TOO_LITTLE_HISTORY.format(need=min_history)).alias("message"),
        F.when(ok, F.col("_records")).when(has_data, F.col("nonblank_history_days")).cast("bigint").alias("history_days"),
        F.col("nonblank_history_days").cast("bigint").alias("nonblank_history_days"),
        F.col("text_count").cast("bigint").alias("text_count"),
        F.when(ok, py_round(novelty, 3)).alias("capability_score"),
        F.when(ok, py_round("mean_sim", 3)).alias("mean_similarity"),
        F.when(ok, shift_label(novelty, F.col("mean_sim"))).otherwise(F.lit("unknown")).alias("trend"),
    )


def day_pairs(records: DataFrame, scopes: DataFrame, day, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """Consecutive existing days of the chart window ``[d-days+1, d]``:
    ``(scope, pair_end, date, is_query)`` with two rows per pair.

    Every scope gets the window's dates from a bounded ``sequence`` and keeps
    the existing ones by a semi-join with the record days (at most ``days``
    rows, broadcast); ``lag`` per scope then pairs each day with the previous
    existing one.
    """
    d = day_lit(day)
    recs = broadcast_if_bounded(
        window_filter(records.select("date").distinct(), day, days, inclusive=True), days, 16)
    cand = scopes.select("scope", F.explode(F.sequence(F.date_sub(d, days - 1), d)).alias("date"))
    spine = cand.join(recs, "date", "left_semi")
    w = Window.partitionBy("scope").orderBy("date")
    pairs = (spine.withColumn("prev", F.lag("date").over(w)).filter(F.col("prev").isNotNull())
             .withColumnRenamed("date", "pair_end"))
    return (pairs.select("scope", "pair_end",
                         F.explode(F.array(
                             F.struct(F.col("prev").alias("date"), F.lit(False).alias("is_query")),
                             F.struct(F.col("pair_end").alias("date"), F.lit(True).alias("is_query")))).alias("m"))
            .select("scope", "pair_end", "m.date", "m.is_query"))


def novelty_series(tf: DataFrame, records: DataFrame, scopes: DataFrame, day, days: int = C.LOOKBACK_DAYS,
                   max_features: int = C.SERIES_MAX_FEATURES) -> DataFrame:
    """``scope, date, novelty``: ``round(1 - sim(prev, date), 3)``, 0.0 when a side is blank (M5).

    A pair of days is a corpus of two documents.  The counts of a term are put in the order of the record days once
    (one shuffle by scope and term); a row then sees the row before it, so both counts of a pair
    are in one row without a join.  The vocabulary is cut by a histogram of counts; only ties are ranked.
    """
    members = materialized(day_pairs(records, scopes, day, days))
    ck = ["scope", "pair_end"]
    ends = members.filter("is_query").select(*ck)
    # each day's pair as its end and, if there is a next record day, that day's pair as its other side
    prev = members.filter("not is_query").select("scope", "date", F.col("pair_end").alias("next_end"))
    own = ends.select("scope", F.col("pair_end").alias("date"), F.col("pair_end").alias("own_end"))
    place = own.join(prev, ["scope", "date"], "full")
    by = Window.partitionBy("scope", "term").orderBy("date")
    rows = (tf.select("scope", "date", "term", "tf").join(broadcast_if_bounded(place, max(1, members.count()), 32), ["scope", "date"])
            .withColumns({"before": F.lag(F.struct("next_end", "tf")).over(by), "after": F.lead("own_end").over(by)}))
    shared = F.when(F.col("before.next_end") == F.col("own_end"), F.col("before.tf")).otherwise(F.lit(0))
    mine = F.struct(F.col("own_end").alias("pair_end"), F.col("tf").alias("cur"), shared.alias("prev"))
    gone = F.struct(F.col("next_end").alias("pair_end"), F.lit(0).cast("bigint").alias("cur"), F.col("tf").alias("prev"))
    # the next record day lacks the term: a row of its own
    lacks = F.col("next_end").isNotNull() & ~F.coalesce(F.col("after") == F.col("next_end"), F.lit(False))
    counts = (rows.select("scope", "term", F.explode(F.filter(F.array(F.when(F.col("own_end").isNotNull(), mine), F.when(lacks, gone)),
                                                              lambda x: x.isNotNull())).alias("x"))
              .select("scope", "term", "x.*").withColumn("ctf", F.col("cur") + F.col("prev")))
    counts = cut_lineage(counts)
    sides = counts.groupBy(*ck).agg((F.max(F.col("cur") > 0) & F.max(F.col("prev") > 0)).alias("both"))
    cuts = histogram_cuts(counts.groupBy(*ck, "ctf").agg(F.count("*").alias("terms")), ck, max_features)
    kept = above_cut(counts.join(cuts, ck).filter(F.col("ctf") >= F.col("cut")), ck, max_features)
    df = (F.col("cur") > 0).cast("int") + (F.col("prev") > 0).cast("int")
    idf2 = F.pow(F.log(3.0 / (df + 1.0)) + 1.0, 2)
    sums = kept.groupBy(*ck).agg(F.sum(F.col("cur") * F.col("prev") * idf2).alias("dot"),
                                 F.sum(F.col("cur") * F.col("cur") * idf2).alias("nc"),
                                 F.sum(F.col("prev") * F.col("prev") * idf2).alias("np"))
    sim = F.when((F.col("nc") > 0) & (F.col("np") > 0), F.col("dot") / F.sqrt(F.col("nc") * F.col("np"))).otherwise(0.0)
    return (ends.join(sums.join(sides, ck), ck, "left")
            .select("scope", F.col("pair_end").alias("date"),
                    F.when(F.coalesce("both", F.lit(False)), py_round(1.0 - sim, 3)).otherwise(F.lit(0.0)).alias("novelty")))
