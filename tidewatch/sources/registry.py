"""The registry of seen ids as a bucketed table.

Ids are kept in buckets by their hash, so an anti-join of a run's items with all ids ever seen moves the items only: the
registry side has no exchange.  The files are the truth: a version folder ``v<number>-b<buckets>`` holds Parquet bucket files, the
newest complete one (``_SUCCESS``) counts, and a session's table is declared over it when it is opened.

* :func:`append_ids` adds a run's ids (at most one file a bucket) and keeps the time of the run;
* :func:`merge` rewrites the ids, each once with its first time, into a new version, without an exchange either;
  a merge that fails leaves the old version in use;
* ids may occur several times (a run that was repeated after a failure): readers take them as a set.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.sources import store as S

BUCKETS = 64
MERGE_AFTER = 64  # files a bucket, on average
_VERSION = re.compile(r"v(\d+)-b(\d+)$")


def _versions(spark: SparkSession, path: str, complete: bool = True) -> list[tuple[int, int, str]]:
    """(number, buckets, folder) in order."""
    fs, (root,) = S._folders(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for f in fs.listStatus(root):
        m = _VERSION.fullmatch(f.getPath().getName())
        done = spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")
        if m and (not complete or fs.exists(done)):
            found.append((int(m[1]), int(m[2]), f"{path}/{f.getPath().getName()}"))
    return sorted(found)


def _declare(spark: SparkSession, folder: str, buckets: int) -> str:
    """Name of a session table over a version's files."""
    name = f"tw_registry_{hashlib.md5(folder.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} (aid STRING, first_seen TIMESTAMP) USING parquet "
                  f"CLUSTERED BY (aid) INTO {buckets} BUCKETS LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return name


def _write(ids: DataFrame, folder: str, buckets: int, mode: str) -> None:
    spark = ids.sparkSession
    name = _declare(spark, folder, buckets)
    (ids.select("aid", "first_seen").write.bucketBy(buckets, "aid").format("parquet").option("path", folder).mode(mode).saveAsTable(name))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``aid, first_seen``: all ids seen (possibly several times); empty before the first run."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], S.SEEN_SCHEMA)
    _, buckets, folder = versions[-1]
    return spark.table(_declare(spark, folder, buckets))


def append_ids(accepted: DataFrame, path: str, run_ts=None, buckets: int = BUCKETS) -> None:
    """Add the ids of accepted items and the time of the run, also when nothing was accepted.  Call after the
    items are written.  ``buckets`` counts for a new registry."""
    spark = accepted.sparkSession
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    versions = _versions(spark, path)
    _, buckets, folder = versions[-1] if versions else (1, buckets, f"{path}/v000001-b{buckets}")
    ids = accepted.select("aid").filter("aid is not null").distinct().withColumn("first_seen", ts)
    _write(ids.repartition(buckets, "aid"), folder, buckets, "append")
    spark.range(1).select(ts.alias("last_run")).write.mode("append").parquet(f"{path.rstrip('/')}_runs")


def files(spark: SparkSession, path: str) -> int:
    """Data files of the version in use."""
    versions = _versions(spark, path)
    if not versions:
        return 0
    fs, (folder,) = S._folders(spark, versions[-1][2])
    return sum(f.getPath().getName().startswith("part-") for f in fs.listStatus(folder))


def merge(spark: SparkSession, path: str, buckets: int | None = None) -> None:
    """Write every id once, with its first time, as a new version (with another number of buckets, if given).  Not to
    be run beside a run that appends.  Older versions than the one before go; that one stays for its readers."""
    versions = _versions(spark, path)
    if not versions:
        return
    number = max(v[0] for v in _versions(spark, path, complete=False)) + 1
    buckets = buckets or versions[-1][1]
    once = read_ids(spark, path).groupBy("aid").agg(F.min("first_seen").alias("first_seen"))
    _write(once if buckets == versions[-1][1] else once.repartition(buckets, "aid"), f"{path}/v{number:06d}-b{buckets}", buckets, "append")
    keep = {versions[-1][2], f"{path}/v{number:06d}-b{buckets}"}
    for _, _, folder in _versions(spark, path, complete=False):
        if folder not in keep:
            fs, (old,) = S._folders(spark, folder)
            fs.delete(old, True)


def merge_if_needed(spark: SparkSession, path: str, merge_after: int = MERGE_AFTER) -> None:
    """Merge once there are more than ``merge_after`` files a bucket."""
    versions = _versions(spark, path)
    if versions and files(spark, path) > merge_after * versions[-1][1]:
        merge(spark, path)
