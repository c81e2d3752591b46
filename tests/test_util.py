from pyspark.sql import Window, functions as F

from tidewatch.operators._util import broadcast_if_bounded, consecutive_index, window_filter


def test_consecutive_index_matches_global_row_number(spark):
    # one category holds a third of the rows; the index must still be 1..n in order
    rows = [(0 if i % 3 == 0 else 1 + i % 5, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "cat int, pos long")
    got = consecutive_index(df, [F.col("cat"), F.col("pos")], "idx", partitions=16)
    want = df.withColumn("idx", F.row_number().over(Window.orderBy("cat", "pos")).cast("bigint"))
    assert got.count() == 3000
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_broadcast_only_with_bound(spark):
    df = spark.range(10)
    plan_b = broadcast_if_bounded(df, 10).join(spark.range(100), "id")._jdf.queryExecution().optimizedPlan().toString()
    plan_n = broadcast_if_bounded(df, None).join(spark.range(100), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan_b.lower() and "broadcast" not in plan_n.lower()


def test_window_filter_bounds(spark):
    import datetime as dt
    d = dt.date(2024, 1, 31)
    df = spark.createDataFrame([(d - dt.timedelta(days=i),) for i in range(40)], "date date")
    assert window_filter(df, d, 30).count() == 30
    assert window_filter(df, d, 30, inclusive=True).agg(F.max("date")).first()[0] == d
