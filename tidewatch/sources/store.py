"""Date-partitioned stores: seen registry, daily history and metrics.

A day is replaced as a whole, also by no rows at all (:func:`replace_day`); reads prune
partitions by the lookback predicate and take an explicit schema, so days
without rows and stores that don't exist yet are just empty.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.operators._util import window_filter

SEEN_SCHEMA = T.StructType([
    T.StructField("aid", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Seen registry (S8); an empty frame with the schema when absent."""
    if _exists(spark, path):
        return spark.read.schema(SEEN_SCHEMA).parquet(path)
    return spark.createDataFrame([], SEEN_SCHEMA)


def append_registry(accepted: DataFrame, path: str, run_ts=None) -> None:
    """Append the ids of accepted items (S9) and keep the time of the run (``last_run``), also
    when nothing was accepted.  Call after the items are written."""
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    (accepted.select("aid").distinct().withColumn("first_seen", ts)
     .write.mode("append").parquet(path))
    accepted.sparkSession.range(1).select(ts.alias("last_run")).write.mode("append").parquet(f"{path.rstrip('/')}_runs")


def last_run(spark: SparkSession, path: str) -> DataFrame:
    """One row ``last_run``: the newest run of a registry, null before the first."""
    runs = f"{path.rstrip('/')}_runs"
    known = spark.read.schema("last_run timestamp").parquet(runs) if _exists(spark, runs) \
        else spark.createDataFrame([], "last_run timestamp")
    return known.agg(F.max("last_run").alias("last_run"))


def replace_day(df: DataFrame, path: str, day, date_col: str = "date") -> None:
    """Replace one day's partition by ``df`` (without the date column); an empty frame empties it.

    The new day is written beside the store (a hidden folder, which readers skip) and takes the day's place when it is
    complete: a failed write leaves the old day as it was, and no reader sees a half day.  A failure between the two
    renames is mended by the next call, or by :func:`recover_days`."""
    spark = df.sparkSession
    if date_col in df.columns:
        df = df.drop(date_col)
    recover_days(spark, path, date_col)
    staged, target, old = [f"{path}/{prefix}{date_col}={day}" for prefix in (".new-", "", ".old-")]
    df.write.mode("overwrite").parquet(staged)
    fs, (new, at, before) = _folders(spark, staged, target, old)
    if fs.exists(at):
        _rename(fs, at, before)
    _rename(fs, new, at)
    fs.delete(before, True)


def _folders(spark: SparkSession, *paths: str):
    at = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return at[0].getFileSystem(spark._jsc.hadoopConfiguration()), at


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"can't rename {source} to {target}")


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files (a file, or a folder's direct children)."""
    fs, (at,) = _folders(spark, path)
    files = [fs.getFileStatus(at)] + (list(fs.listStatus(at)) if fs.getFileStatus(at).isDirectory() else [])
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def recover_days(spark: SparkSession, path: str, date_col: str = "date") -> None:
    """Give a day back its old rows if a replacement ended between its two renames."""
    fs, (root,) = _folders(spark, path)
    if not fs.exists(root):
        return
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if name.startswith(f".old-{date_col}="):
            _, (day,) = _folders(spark, f"{path}/{name.removeprefix('.old-')}")
            if fs.exists(day):
                fs.delete(f.getPath(), True)
            else:
                _rename(fs, f.getPath(), day)


def partitions(spark: SparkSession, path: str, date_col: str = "date") -> list:
    """(value, Hadoop path) of a store's partitions, from the folder names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [(f.getPath().getName(), f.getPath()) for f in fs.listStatus(at) if f.isDirectory()]
    return [(n.split("=", 1)[1], p) for n, p in found if n.startswith(f"{date_col}=")]


def drop_partitions(spark: SparkSession, path: str, date_col: str, values: Iterable[str]) -> None:
    """Remove partitions by their values."""
    values = set(values)
    for value, at in partitions(spark, path, date_col):
        if value in values:
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored_days(spark: SparkSession, path: str, date_col: str = "date") -> list[_dt.date]:
    """The days of a store."""
    return sorted(_dt.date.fromisoformat(value) for value, _ in partitions(spark, path, date_col))


def drop_days_after(spark: SparkSession, path: str, day, date_col: str = "date") -> None:
    """Remove the days after ``day`` (derived data that an older day's rerun makes stale)."""
    drop_partitions(spark, path, date_col, [str(d) for d in stored_days(spark, path, date_col) if str(d) > str(day)])


def read_store(spark: SparkSession, path: str, schema: str | T.StructType, date_col: str = "date") -> DataFrame:
    """All days of a store with an explicit schema (with or without the date column)."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    full = T.StructType([f for f in fields if f.name != date_col]).add(date_col, T.DateType() if date_col == "date" else T.StringType())
    if not _exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def write_days(df: DataFrame, path: str, date_col: str = "date", fmt: str = "parquet") -> None:
    """Write one partition per day; rewriting a day replaces it."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(date_col).format(fmt).save(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def read_days(spark: SparkSession, path: str, day, days: int = 30, inclusive: bool = False,
              date_col: str = "date", fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Lookback read: ``[d-days, d-1]`` (S11, S13) or ``[d-days+1, d]``.

    Unreadable files are skipped (``ignoreCorruptFiles``) like the original's
    warn-and-continue.
    """
    reader = spark.read.format(fmt).option("ignoreCorruptFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    df = reader.load(path)
    df = df.withColumn(date_col, F.col(date_col).cast("date"))
    return window_filter(df, day, days, date_col=date_col, inclusive=inclusive)


def write_latest_json(df: DataFrame, path: str) -> None:
    """Latest-report sink (S15): one JSON document, replaced each run."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_text(lines: DataFrame, path: str, keys: tuple[str, ...] = ("section", "item", "line")) -> None:
    """Text sink (S17): the lines of a report as text files, in key order over the files."""
    lines.repartitionByRange(*keys).sortWithinPartitions(*keys).select("text").write.mode("overwrite").text(path)


def append_run_log(df: DataFrame, path: str) -> None:
    """Run-log sink."""
    df.write.mode("append").parquet(path)


def read_json_history(spark: SparkSession, path: str, day, days: int = 30, schema: T.StructType | None = None,
                      inclusive: bool = False) -> DataFrame:
    """Lookback over one pretty-printed JSON document per day.

    Documents are read whole (``multiLine``); a document that does not parse
    is dropped (the original skips the file with a warning) and the day key
    is the document's own ``date`` field, not the file name.  Rows come back
    in ascending date order when sorted by ``date``.
    """
    corrupt = "_corrupt_record"
    reader = (spark.read.option("multiLine", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt).option("ignoreCorruptFiles", "true"))
    if schema is not None:
        reader = reader.schema(T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType())]))
    df = reader.json(path)
    if corrupt in df.columns:
        df = df.filter(F.col(corrupt).isNull()).drop(corrupt)
    df = df.withColumn("date", F.to_date("date")).filter(F.col("date").isNotNull())
    return window_filter(df, day, days, inclusive=inclusive)
