"""Keyword trends: new, rising and fading keywords of a day against its history (T4).

History "records" are the days that exist in ``[d-days, d-1]``; "last N"
means the last N existing records, not calendar days.  The record spine holds
at most ``days`` rows, so it is ranked on its own and broadcast; the keyword
side is reduced to distinct ``(date, kw)`` pairs (map-side combine) and then
aggregated once per keyword.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.operators._util import day_lit, window_filter


def record_spine(day_keywords: DataFrame, day, days: int = C.LOOKBACK_DAYS,
                 spine: DataFrame | None = None) -> DataFrame:
    """History record days ``[d-days, d-1]`` with ``rn`` = 1 for the latest."""
    src = spine if spine is not None else day_keywords
    recs = window_filter(src.select("date").distinct(), day, days)
    return recs.select("date", F.row_number().over(Window.orderBy(F.col("date").desc())).alias("rn"))


def keyword_measures(day_keywords: DataFrame, day, days: int = C.LOOKBACK_DAYS,
                     recent_n: int = C.KEYWORD_RECENT_N, spine: DataFrame | None = None) -> DataFrame:
    """Per keyword of the window: ``kw, today, df, recent_count, older_count,
    n_hist, n_recent, n_older``.

    The days of a keyword are one long (bit i: i days ago), or-ed together in one partially
    aggregated shuffle; counts are bit counts against the masks of the record days.
    """
    if days > 62:
        raise ValueError("the lookback of keyword measures is at most 62 days")
    d = day_lit(day)

    bit = F.expr("shiftleft(1L, _ago)")
    rows = day_keywords.filter((F.col("date") >= F.date_sub(d, days)) & (F.col("date") <= d) & F.col("kw").isNotNull())
    per_kw = (rows.withColumn("_ago", F.datediff(d, F.col("date")))
              .groupBy("kw").agg(F.bit_or(bit).alias("seen")))
    recs = record_spine(day_keywords, day, days, spine).withColumn("_ago", F.datediff(d, F.col("date")))
    masks = recs.agg(F.coalesce(F.bit_or(bit), F.lit(0)).cast("bigint").alias("hist"),
                     F.coalesce(F.bit_or(F.when(F.col("rn") <= recent_n, bit)), F.lit(0)).cast("bigint").alias("recent"))
    hist, recent = masks.select("hist").scalar(), masks.select("recent").scalar()

    return counted(per_kw.withColumn("_hist", hist).withColumn("_recent", recent), "_hist", "_recent")


def lowest_bits(mask: str, n: int) -> Column:
    """The ``n`` lowest set bits of a mask."""
    rest, kept = F.col(mask), F.lit(0).cast("bigint")
    for _ in range(n):
        low = rest.bitwiseAND(-rest)
        kept, rest = kept.bitwiseOR(low), rest.bitwiseXOR(low)
    return kept


def counted(per_kw: DataFrame, hist: str, recent: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Measures of keywords from their days (``seen``, bit i: i days ago) and the masks of the records."""
    def count(mask):
        return F.bit_count(mask).cast("bigint")

    seen, h, r = F.col("seen"), F.col(hist), F.col(recent)
    return per_kw.select(
        *keep, "kw", (seen.bitwiseAND(F.lit(1)) == 1).alias("today"),
        count(seen.bitwiseAND(h)).alias("df"), count(seen.bitwiseAND(r)).alias("recent_count"),
        (count(seen.bitwiseAND(h)) - count(seen.bitwiseAND(r))).alias("older_count"),
        count(h).alias("n_hist"), count(r).alias("n_recent"), (count(h) - count(r)).alias("n_older"))


def keyword_trends(day_keywords: DataFrame, day, days: int = C.LOOKBACK_DAYS,
                   recent_n: int = C.KEYWORD_RECENT_N, rise_delta: float = C.KEYWORD_RISE_DELTA,
                   fade_min_df: int = C.KEYWORD_FADE_MIN_DF, spine: DataFrame | None = None) -> DataFrame:
    """All classified keywords: ``kind, kw, df, recent_rate, older_rate``.

    * new: present today, in no history record;
    * rising: present today and in history, ``recent_rate > older_rate + rise_delta``
      (rates over the last ``recent_n`` records and the older ones; older rate 0
      when there are no older records);
    * fading: absent today, in at least ``fade_min_df`` records, none of the last ``recent_n``.
    Nothing is reported when the day has no keywords.
    """
    kinds = classified(keyword_measures(day_keywords, day, days, recent_n, spine), rise_delta, fade_min_df)
    # only the day's own partition is read for this
    today = day_keywords.filter((F.col("date") == day_lit(day)) & F.col("kw").isNotNull()).limit(1)
    has_today = today.select(F.count("*")).scalar() > 0
    return kinds.filter(has_today)


def classified(m: DataFrame, rise_delta: float = C.KEYWORD_RISE_DELTA, fade_min_df: int = C.KEYWORD_FADE_MIN_DF,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep..., kind, kw, df, recent_rate, older_rate`` of keywords that are new, rising or fading."""
    recent_rate = F.col("recent_count") / F.greatest(F.col("n_recent"), F.lit(1))
    older_rate = F.when(F.col("n_older") > 0, F.col("older_count") / F.col("n_older")).otherwise(F.lit(0.0))
    m = m.withColumn("recent_rate", recent_rate).withColumn("older_rate", older_rate)
    kind = (F.when(F.col("today") & (F.col("df") == 0), F.lit("new"))
            .when(F.col("today") & (F.col("recent_rate") > F.col("older_rate") + rise_delta), F.lit("rising"))
            .when(~F.col("today") & (F.col("df") >= fade_min_df) & (F.col("recent_count") == 0), F.lit("fading")))
    return (m.withColumn("kind", kind).filter(F.col("kind").isNotNull())
            .select(*keep, "kind", "kw", F.col("df").cast("bigint").alias("df"),
                    F.round("recent_rate", 6).alias("recent_rate"), F.round("older_rate", 6).alias("older_rate")))


def keyword_lists(trends: DataFrame, top: int = C.KEYWORD_TOP) -> DataFrame:
    """First ``top`` keywords of each kind in ascending order (K4), with their rank."""
    w = Window.partitionBy("kind").orderBy("kw")
    return (trends.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top)
            .select("kind", "rank", "kw"))


def keyword_report(trends: DataFrame, top: int = C.KEYWORD_TOP) -> DataFrame:
    """One row: ``new_keywords, rising_keywords, fading_keywords`` arrays."""
    lists = keyword_lists(trends, top)
    agg = lists.groupBy().agg(*[
        F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("kw")))).alias(f"{k}_keywords")
        for k in ("new", "rising", "fading")
    ])
    return agg
