"""Keyword trends of a stream (X2 into T4).

The state of a keyword is a bit mask per block of ``BLOCK`` days: one bit for each day it was seen.
A micro-batch reduces its rows to masks (partially aggregated, so a keyword that holds a third of a batch is
one row a task) and writes them as its own epoch; it reads no state.  Masks merge by OR, in any order and any number of
times, so replays, restarts and late rows need no special case: a late row just sets its day's bit.
:func:`merge_masks` keeps the number of files and the age of the state bounded: it merges all epochs and lets blocks
expire that no lookback reaches any more.

:func:`keyword_trends_by_day` gives T4 for any days from the masks: two blocks hold a lookback.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch import constants as C
from tidewatch.operators.keywords import classified, counted, lowest_bits
from tidewatch.sources import store as S

BLOCK = 32
MASKS = "kw string, block bigint, mask bigint"


def _number(date: str) -> Column:
    return F.unix_date(F.col(date).cast("date")).cast("bigint")


def day_masks(day_keywords: DataFrame) -> DataFrame:
    """``kw, block, mask`` of ``(date, kw)`` rows: the block's last day is bit 0, the day before bit 1, and so on."""
    rows = day_keywords.filter(F.col("kw").isNotNull() & F.col("date").isNotNull()).withColumn("_n", _number("date"))
    bit = F.expr(f"shiftleft(1L, cast({BLOCK - 1} - pmod(_n, {BLOCK}) as int))")
    return rows.groupBy("kw", F.floor(F.col("_n") / BLOCK).alias("block")).agg(F.bit_or(bit).alias("mask"))


def write_masks(path: str):
    """``foreachBatch`` function: the masks of a micro-batch of ``(date, kw)`` rows as its own epoch (a replay replaces it)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        S.replace_day(day_masks(batch), path, epoch_id, date_col="epoch")

    return run


def run_keyword_stream(stream: DataFrame, path: str, checkpoint_dir: str) -> None:
    """Drain a stream of ``(date, kw)`` rows into masks (trigger ``availableNow``)."""
    (stream.writeStream.foreachBatch(write_masks(path)).option("checkpointLocation", checkpoint_dir)
     .trigger(availableNow=True).start().awaitTermination())


def read_masks(spark: SparkSession, path: str) -> DataFrame:
    """``kw, block, mask`` over all epochs."""
    rows = S.read_store(spark, path, MASKS, date_col="epoch")
    return rows.groupBy("kw", "block").agg(F.bit_or("mask").alias("mask"))


def merge_masks(spark: SparkSession, path: str, day, days: int = C.LOOKBACK_DAYS) -> None:
    """Merge all epochs into one and let keywords expire whose block no lookback from ``day`` on reaches.

    The merged masks are written before the epochs go; as masks merge by OR, a failure in between leaves both, and the
    same result.  Not to be run while the stream writes."""
    epochs = [name for name, _ in S.partitions(spark, path, "epoch")]
    if not epochs:
        return
    last = max(int(e.removeprefix("merged-")) for e in epochs)
    oldest = F.floor((F.unix_date(F.lit(day).cast("date")) - days) / BLOCK)
    S.replace_day(read_masks(spark, path).filter(F.col("block") >= oldest), path, f"merged-{last + 1}", date_col="epoch")
    S.drop_partitions(spark, path, "epoch", epochs)


def keyword_trends_by_day(masks: DataFrame, query_days: DataFrame | None = None, days: int = C.LOOKBACK_DAYS,
                          recent_n: int = C.KEYWORD_RECENT_N, rise_delta: float = C.KEYWORD_RISE_DELTA,
                          fade_min_df: int = C.KEYWORD_FADE_MIN_DF) -> DataFrame:
    """``date, kind, kw, df, recent_rate, older_rate``: T4 for each of ``query_days`` (``date``; by default
    every day with a keyword).  Records are the days with any keyword; a day without keywords reports nothing."""
    if days > 62:
        raise ValueError("the lookback is at most 62 days")
    reach = (1 << (days + 1)) - 1
    # all keywords together: the record days, at most a row a block
    every = masks.groupBy("block").agg(F.bit_or("mask").alias("mask"))
    known = F.expr(f"filter(sequence(0, {BLOCK - 1}), i -> (mask & shiftleft(1L, i)) <> 0)")
    record_days = every.select(F.explode(known).alias("i"), "block").select((F.col("block") * BLOCK + BLOCK - 1 - F.col("i")).alias("n"))
    if query_days is not None:
        record_days = record_days.join(query_days.select(_number("date").alias("n")).distinct(), "n", "left_semi")
    wanted = record_days.agg(F.array_sort(F.collect_set("n")).alias("ns")).scalar()  # one entry a day of the stream

    def seen(rows: DataFrame, *keys: str) -> DataFrame:
        """Masks relative to each wanted day: bit i is i days before it."""
        last = F.col("block") * BLOCK + BLOCK - 1
        near = rows.withColumn("_ns", wanted).withColumn("_last", last).withColumn(
            "n", F.explode(F.expr(f"filter(_ns, n -> n > _last - {BLOCK} and n <= _last + {days})")))
        moved = F.expr("if(n >= _last, shiftleft(mask, cast(n - _last as int)), shiftright(mask, cast(_last - n as int)))")
        return near.groupBy("n", *keys).agg(F.bit_or(moved).bitwiseAND(F.lit(reach).cast("bigint")).alias("seen"))

    records = seen(every).select("n", F.col("seen").bitwiseAND(F.lit(-2).cast("bigint")).alias("hist"))
    records = records.withColumn("recent", lowest_bits("hist", recent_n))
    # a row a day: small beside the keywords
    per_kw = seen(masks, "kw").join(records, "n")
    kinds = classified(counted(per_kw, "hist", "recent", keep=("n",)), rise_delta, fade_min_df, keep=("n",))
    return kinds.select(F.date_from_unix_date(F.col("n").cast("int")).alias("date"), "kind", "kw", "df", "recent_rate", "older_rate")
