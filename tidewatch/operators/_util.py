"""Small shared helpers for operators."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_lit(day: str | _dt.date | Column) -> Column:
    """A query day as a DATE column (string ``YYYY-MM-DD``, ``date`` or Column)."""
    if isinstance(day, Column):
        return day.cast("date")
    if isinstance(day, _dt.datetime):
        day = day.date()
    if isinstance(day, _dt.date):
        return F.lit(day)
    return F.to_date(F.lit(day))


def window_filter(df: DataFrame, day, days: int, date_col: str = "date",
                  inclusive: bool = False) -> DataFrame:
    """Lookback window.

    ``inclusive=False``: ``[d-days, d-1]`` (history, excludes d);
    ``inclusive=True``: ``[d-days+1, d]`` (chart window, includes d).
    Written as a plain range predicate so partition pruning / parquet
    pushdown apply to a date-partitioned table.
    """
    d = day_lit(day)
    c = F.col(date_col)
    if inclusive:
        return df.filter((c > F.date_sub(d, days)) & (c <= d))
    return df.filter((c >= F.date_sub(d, days)) & (c < d))


def broadcast_if_bounded(df: DataFrame, max_rows: int | None, row_bytes: int = 64) -> DataFrame:
    """Broadcast only when a proven row bound fits the session threshold.

    Without a bound the plain DataFrame is returned and AQE decides at run
    time from measured shuffle sizes.
    """
    if max_rows is None:
        return df
    spark = df.sparkSession
    limit = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))))
    if limit > 0 and max_rows * row_bytes <= limit:
        return F.broadcast(df)
    return df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder named by
    ``spark.checkpoint.dir`` (set only when the session has none) and read it back.

    Used for intermediates that several branches of one plan read (the term
    table): they are computed once, readers take only their columns, and a lost
    executor re-reads files instead of recomputing the lineage.
    """
    from tidewatch.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tw_materialized = True
    return out


def materialized(df: DataFrame) -> DataFrame:
    """``df`` itself when it already comes from :func:`cut_lineage`, else its table."""
    return df if getattr(df, "_tw_materialized", False) else cut_lineage(df)


def consecutive_index(df: DataFrame, order: list, name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Add a 1-based consecutive row number over a total ``order`` without a
    single-task window.

    Range-partition on the order (hot keys spread over several ranges, since
    the order is total), freeze the assignment in a written table,
    number rows inside each range, and add the counts of all earlier ranges
    (one row per range, broadcast).
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    n = partitions or max(1, spark.sparkContext.defaultParallelism)
    ranged = cut_lineage(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid", "inner")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_pid", "_local", "_off"))
