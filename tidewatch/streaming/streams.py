"""Incremental dedup and daily facts with Structured Streaming.

The daily poll with remembered ids becomes a stream: items are deduplicated
by id within a watermark (state is bounded by the delay), and keyword /
counter facts are tumbling one-day windows in update mode: every micro-batch
upserts the days it touched, so open days are there too.  Rows that come after
the watermark are counted in a side table.  Event-time columns must be TIMESTAMP (not TIMESTAMP_NTZ)
for ``withWatermark``; the helpers cast.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.ids import item_id
from tidewatch.session import ensure_checkpoint_dir


def stream_dedup(items: DataFrame, ts: str = "ts", key: str = "aid", delay: str = "30 days") -> DataFrame:
    """First-wins dedup of an item stream by id within ``delay``."""
    return (items.withColumn(ts, F.col(ts).cast("timestamp"))
            .withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark([key]))


def stream_daily_keywords(events: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Daily keyword presence and counter totals per key (X2): ``date, kw, n, value``."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return (e.groupBy(F.window(ts, "1 day").alias("w"), "kw")
            .agg(F.count("*").alias("n"), F.sum("value").alias("value"))
            .select(F.to_date(F.col("w.start")).alias("date"), "kw", "n", "value"))


def run_daily_upserts(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> None:
    """Drain a daily aggregate in update mode (trigger ``availableNow``).

    Each epoch writes the groups it changed to its own ``epoch`` partition (a replayed
    epoch replaces exactly that one); :func:`read_daily` takes the newest row of a
    group.  ``<out_dir>_late`` gets one row per epoch with the number of rows that
    the watermark dropped.
    """
    spark = stream.sparkSession

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch_id}")

    q = (stream.writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    _write_late_rows(spark, _drained(q), out_dir)


def _drained(q) -> dict[int, int]:
    """Wait for a query's end; rows dropped behind the watermark by epoch.  A query keeps its last 100
    progress records only, so they are taken while it runs."""
    late: dict[int, int] = {}
    done = False
    while not done:
        done = q.awaitTermination(1)
        for p in q.recentProgress:
            late[p.batchId] = max(late.get(p.batchId, 0), sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
    return late


def _write_late_rows(spark: SparkSession, late: dict[int, int], out_dir: str) -> None:
    """One file a run: its epochs with their late rows."""
    spark.createDataFrame(sorted(late.items()), "epoch long, late_rows long").coalesce(1).write.mode("append").parquet(f"{out_dir}_late")


def read_daily(spark: SparkSession, out_dir: str, keys: tuple[str, ...] = ("date", "kw")) -> DataFrame:
    """The newest version of every group written by :func:`run_daily_upserts`."""
    return _newest(spark.read.option("recursiveFileLookup", "false").parquet(out_dir), keys)


def _newest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("epoch")).alias("v"))
    return newest.select(*keys, "v.*")


def merge_daily(spark: SparkSession, out_dir: str, keys: tuple[str, ...] = ("date", "kw")) -> None:
    """Merge all epochs but the last (which a restart may replay) into one, so that a reader's work follows the groups, not
    the number of epochs.  The merged epoch is written before the others go: a failure in between leaves the same result.
    Not to be run while the stream writes."""
    from tidewatch.sources import store as S

    epochs = sorted(int(value) for value, _ in S.partitions(spark, out_dir, "epoch"))
    if len(epochs) < 3:
        return
    rows = spark.read.parquet(out_dir).filter(F.col("epoch") < epochs[-1])
    S.replace_day(_newest(rows, keys), out_dir, epochs[-2], date_col="epoch")
    S.drop_partitions(spark, out_dir, "epoch", [str(e) for e in epochs[:-2]])


def late_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """``epoch, late_rows`` of a drained stream (of several runs, the largest count of an epoch)."""
    return spark.read.parquet(f"{out_dir}_late").groupBy("epoch").agg(F.max("late_rows").alias("late_rows"))


def run_available_now(stream: DataFrame, out_dir: str, checkpoint_dir: str, mode: str = "append") -> None:
    """Drain everything available into parquet files (trigger ``availableNow``); rows that the watermark drops are
    counted in ``<out_dir>_late``."""
    q = (stream.writeStream.format("parquet").outputMode(mode)
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    _write_late_rows(stream.sparkSession, _drained(q), out_dir)


def scratch_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    """Output and checkpoint folders under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    run = f"{name}-{uuid.uuid4().hex[:12]}"
    return os.path.join(base, run, "out"), os.path.join(base, run, "state")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream: one Parquet file or a folder of part files.

    All files that are there make one epoch: the rows of a table come in no order, so with
    several epochs the watermark of an early one would drop rows of a later one.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    # a file stream takes folders only
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def document_stream(spark: SparkSession, sf_dir: str, epoch: str = "2024-01-01", days: int = 31) -> DataFrame:
    """``documents`` as an item stream (file source): ``ts`` = epoch + doc_id % days."""
    docs = table_stream(spark, sf_dir, "documents")
    ts = F.timestamp_add("DAY", (F.col("doc_id") % days).cast("int"), F.lit(epoch).cast("timestamp"))
    return docs.select(item_id(F.lit(""), F.col("text")).alias("aid"), "source", F.col("doc_id").alias("pos"),
                       ts.alias("ts"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream with ``kw = user_id:event_type``."""
    ev = table_stream(spark, sf_dir, "events")
    return ev.select(F.col("ts").cast("timestamp").alias("ts"),
                     F.concat_ws(":", F.col("user_id").cast("string"), F.col("event_type")).alias("kw"),
                     "value")


def ingest_batches(registry_path: str, items_path: str, key: str = "aid", run_id: str | None = None):
    """``foreachBatch`` function for "never again" dedup (X1 with J1 + S9).

    Each micro-batch keeps the first row per id (by ``pos``), drops ids
    registered by any *other* ``(run, epoch)``, then overwrites its own ``batch``
    partition of the items table and of the registry.  A replayed epoch
    (after a lost executor or driver restart) therefore replaces exactly what
    it wrote before: the sink is idempotent.  ``run_id`` names the streaming state: keep it
    over restarts from the same checkpoint, take a new one (the default) for a new
    state, whose epochs start at 0 again.
    """
    from tidewatch.sources import store as S

    run_id = run_id or uuid.uuid4().hex

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{run_id}-{epoch_id}"
        others = [c for c in batch.columns if c not in (key, "pos")]
        first = batch.groupBy(key).agg(F.min(F.struct("pos", *others)).alias("_r")).select(key, "_r.*")
        if S._exists(spark, registry_path):
            others_seen = spark.read.parquet(registry_path).filter(F.col("batch") != name).select(key)
            first = first.join(others_seen, key, "left_anti")
        S.replace_day(first, items_path, name, date_col="batch")
        written = spark.read.schema(first.schema).parquet(f"{items_path}/batch={name}")
        S.replace_day(written.select(key, F.current_timestamp().alias("first_seen")), registry_path, name, date_col="batch")

    return run
