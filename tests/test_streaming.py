import os
import tempfile

from pyspark.sql import functions as F

from tidewatch.sources import store as S
from tidewatch.streaming import streams as ST


def test_stream_dedup_matches_batch(spark):
    src = tempfile.mkdtemp(prefix="tw-stream-")
    rows = [(f"id{i % 7}", "s", i, f"2024-01-{1 + i % 20:02d} 00:00:00") for i in range(40)]
    df = spark.createDataFrame(rows, "aid string, source string, pos long, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.write.mode("overwrite").parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(src, "a"))
    out, state = ST.scratch_dirs(spark, "t-dedup")
    ST.run_available_now(ST.stream_dedup(stream), out, state)
    assert sorted(r.aid for r in spark.read.parquet(out).collect()) == [f"id{i}" for i in range(7)]


def test_ntz_is_cast_for_watermark(spark):
    src = tempfile.mkdtemp(prefix="tw-stream-")
    df = spark.sql("SELECT 'a' AS aid, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts")
    df.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out, state = ST.scratch_dirs(spark, "t-ntz")
    ST.run_available_now(ST.stream_dedup(stream), out, state)
    assert spark.read.parquet(out).count() == 1


def test_stream_daily_has_every_day(spark):
    src = tempfile.mkdtemp(prefix="tw-stream-")
    rows = [(f"2024-01-{1 + i % 5:02d} {i % 24:02d}:00:00", f"k{i % 3}", float(i)) for i in range(60)]
    df = (spark.createDataFrame(rows, "ts string, kw string, value double")
          .withColumn("ts", F.to_timestamp("ts")))
    df.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out, state = ST.scratch_dirs(spark, "t-daily")
    ST.run_daily_upserts(ST.stream_daily_keywords(stream), out, state)
    got = sorted((r.date.isoformat(), r.kw, r.n, r.value) for r in ST.read_daily(spark, out).collect())
    batch = df.groupBy(F.to_date("ts").alias("date"), "kw").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    want = sorted((r.date.isoformat(), r.kw, r.n, r.value) for r in batch.collect())
    assert got == want and len(got) == 15
    assert ST.late_rows(spark, out).agg(F.sum("late_rows")).first()[0] == 0


def test_daily_upsert_and_late_rows(spark):
    src = tempfile.mkdtemp(prefix="tw-stream-")
    out, state = ST.scratch_dirs(spark, "t-late")

    def arrive(name, rows):
        df = spark.createDataFrame(rows, "ts string, kw string, value double").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.parquet(f"{src}/{name}")
        stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(src)
        ST.run_daily_upserts(ST.stream_daily_keywords(stream), out, state)

    arrive("a", [("2024-01-10 01:00:00", "k", 1.0)])
    arrive("b", [("2024-01-10 02:00:00", "k", 2.0), ("2024-01-20 00:00:00", "k", 5.0)])
    arrive("c", [("2024-01-01 00:00:00", "k", 7.0)])  # long past the watermark
    got = sorted((r.date.isoformat(), r.n, r.value) for r in ST.read_daily(spark, out).collect())
    assert got == [("2024-01-10", 2, 3.0), ("2024-01-20", 1, 5.0)]
    arrive("d", [("2024-01-20 03:00:00", "k", 1.0)])
    before = sorted(map(tuple, ST.read_daily(spark, out).collect()))
    epochs = len(S.partitions(spark, out, "epoch"))
    ST.merge_daily(spark, out)
    ST.merge_daily(spark, out)  # nothing left to merge
    assert len(S.partitions(spark, out, "epoch")) == 2 < epochs
    assert sorted(map(tuple, ST.read_daily(spark, out).collect())) == before
    arrive("e", [("2024-01-20 04:00:00", "k", 1.0)])  # the stream goes on
    assert ("2024-01-20", 3, 7.0) in [(r.date.isoformat(), r.n, r.value) for r in ST.read_daily(spark, out).collect()]
    assert ST.late_rows(spark, out).agg(F.sum("late_rows")).first()[0] == 1


def test_ingest_batches_survives_a_new_state(spark):
    base = tempfile.mkdtemp(prefix="tw-batches-")
    registry, items = f"{base}/registry", f"{base}/items"

    def batch(*ids):
        return spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "aid string, pos long")

    first = ST.ingest_batches(registry, items)
    first(batch("a", "b", "a"), 0)
    first(batch("b", "c"), 1)
    first(batch("b", "c"), 1)  # a replayed epoch
    second = ST.ingest_batches(registry, items)  # new streaming state: epochs from 0 again
    second(batch("a", "d"), 0)
    assert sorted(r.aid for r in spark.read.parquet(items).collect()) == ["a", "b", "c", "d"]
    assert sorted(r.aid for r in spark.read.parquet(registry).collect()) == ["a", "b", "c", "d"]


def test_streams_read_folders_of_part_files(spark):
    from tidewatch.plans.queries import REGISTRY

    single, base = "/root/testdata/sf0.001", tempfile.mkdtemp(prefix="tw-parts-")
    spark.read.parquet(f"{single}/documents.parquet").repartition(6).write.parquet(f"{base}/documents.parquet")
    spark.read.parquet(f"{single}/events.parquet").repartition(6).write.partitionBy("event_type").parquet(f"{base}/events.parquet")
    for name in ("stream_dedup", "stream_daily"):
        want, got = ([tuple(r) for r in REGISTRY[name](spark, d).collect()] for d in (single, base))
        assert len(got) == len(want) > 0
    key = ["date", "kw", "n"]
    want, got = (sorted(map(tuple, REGISTRY["stream_daily"](spark, d).select(*key).collect())) for d in (single, base))
    assert got == want


def test_late_rows_of_the_dedup_stream(spark):
    src = tempfile.mkdtemp(prefix="tw-stream-")
    out, state = ST.scratch_dirs(spark, "t-dedup-late")

    def arrive(name, rows):
        df = spark.createDataFrame(rows, "aid string, ts string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.parquet(f"{src}/{name}")
        stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(src)
        ST.run_available_now(ST.stream_dedup(stream, delay="1 day"), out, state)

    arrive("a", [("x", "2024-01-10 00:00:00"), ("y", "2024-01-20 00:00:00"), ("x", "2024-01-10 01:00:00")])
    arrive("b", [("z", "2024-01-01 00:00:00"), ("w", "2024-01-02 00:00:00"), ("v", "2024-01-20 01:00:00")])
    assert sorted(r.aid for r in spark.read.parquet(out).collect()) == ["v", "x", "y"]
    assert ST.late_rows(spark, out).agg(F.sum("late_rows")).first()[0] == 2


def test_late_rows_are_taken_while_the_query_runs():
    """More epochs than a query keeps progress of."""
    class Progress:
        def __init__(self, i):
            self.batchId, self.stateOperators = i, [type("S", (), {"numRowsDroppedByWatermark": i % 3})()]

    class Query:
        at = 0

        def awaitTermination(self, seconds):
            self.at = min(250, self.at + 60)
            return self.at == 250

        @property
        def recentProgress(self):
            return [Progress(i) for i in range(max(0, self.at - 100), self.at)]

    assert ST._drained(Query()) == {i: i % 3 for i in range(250)}
