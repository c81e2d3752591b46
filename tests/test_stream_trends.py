"""Keyword trends of a stream against the batch operator: random batch cuts, late rows, restarts, replays, merging."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from tidewatch.operators import keywords as KW
from tidewatch.sources import store as S
from tidewatch.streaming import trends as TR

DAY0 = dt.date(2024, 2, 20)


def _rows(rng, n_days, n):
    days = [d for d in range(n_days) if rng.random() < 0.85]
    rows = [(DAY0 + dt.timedelta(days=rng.choice(days)), f"k{min(rng.randint(0, 30), rng.randint(0, 30))}") for _ in range(n)]
    # some keywords stop, others begin late
    return [(d, k) for d, k in rows if not (k in ("k1", "k2") and d > DAY0 + dt.timedelta(days=n_days // 2))] + [(None, "k3"), (rows[0][0], None)]


def _plain(rows, day, days):
    """T4 in plain Python: sets of days."""
    by = {}
    for d, k in rows:
        if d and k and day - dt.timedelta(days=days) <= d <= day:
            by.setdefault(k, set()).add(d)
    hist = sorted({d for d, k in rows if d and k and day - dt.timedelta(days=days) <= d < day}, reverse=True)
    recent, older = set(hist[:5]), set(hist[5:])
    out = set()
    if not any(d == day and k for d, k in rows):
        return out
    for k, ds in by.items():
        df, r, o = len(ds & set(hist)), len(ds & recent), len(ds & older)
        rr, orr = r / max(len(recent), 1), o / len(older) if older else 0.0
        kind = "new" if day in ds and not df else "rising" if day in ds and rr > orr + 0.2 else "fading" if day not in ds and df >= 3 and not r else None
        if kind:
            out.add((kind, k, df, round(rr, 6), round(orr, 6)))
    return out


def _by_day(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.date, set()).add((r.kind, r.kw, r.df, r.recent_rate, r.older_rate))
    return out


def test_trends_of_random_batches_replays_and_merges(spark):
    rng = random.Random(4)
    rows = _rows(rng, 80, 700)
    frame = lambda part: spark.createDataFrame(part, "date date, kw string")
    path = os.path.join(tempfile.mkdtemp(prefix="tw-masks-"), "masks")
    order = rows[:]
    rng.shuffle(order)  # late rows everywhere
    write, epoch = TR.write_masks(path), 0
    for lo in range(0, len(order), 140):
        write(frame(order[lo:lo + 140]), epoch)
        if rng.random() < 0.6:
            write(frame(order[lo:lo + 140]), epoch)  # replay
        epoch += 1
    days = sorted({d for d, k in rows if d and k})
    for lookback in (30, 62):
        got = _by_day(TR.keyword_trends_by_day(TR.read_masks(spark, path), days=lookback))
        assert got == {d: t for d in days if (t := _plain(rows, d, lookback))}
    batch = {tuple(r) for r in KW.keyword_trends(frame(rows), days[40]).collect()}
    assert batch == _plain(rows, days[40], 30)
    # merging keeps what a lookback from the last day reaches, and later batches go on
    last = days[-1]
    TR.merge_masks(spark, path, last)
    assert [v for v, _ in S.partitions(spark, path, "epoch")] == [f"merged-{epoch}"]
    assert TR.read_masks(spark, path).agg(F.min("block")).first()[0] >= (last - dt.timedelta(days=62) - dt.date(1970, 1, 1)).days // 32
    later = [(last + dt.timedelta(days=1), k) for k in ("k0", "k1", "brand new")]
    write(frame(later), epoch + 1)
    one = frame([(later[0][0], "x")])
    assert _by_day(TR.keyword_trends_by_day(TR.read_masks(spark, path), one)) == {later[0][0]: _plain(rows + later, later[0][0], 30)}


def test_merge_that_fails_before_the_epochs_go(spark, monkeypatch):
    rows = _rows(random.Random(8), 20, 100)
    path = os.path.join(tempfile.mkdtemp(prefix="tw-masks-"), "masks")
    for i in range(2):
        TR.write_masks(path)(spark.createDataFrame(rows[i::2], "date date, kw string"), i)
    before = sorted(map(tuple, TR.read_masks(spark, path).collect()))
    with monkeypatch.context() as m:
        m.setattr(S, "drop_partitions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        try:
            TR.merge_masks(spark, path, DAY0)
        except OSError:
            pass
    assert len(S.partitions(spark, path, "epoch")) == 3 and sorted(map(tuple, TR.read_masks(spark, path).collect())) == before
    TR.merge_masks(spark, path, DAY0)
    assert len(S.partitions(spark, path, "epoch")) == 1 and sorted(map(tuple, TR.read_masks(spark, path).collect())) == before


def test_stream_restarts_where_it_stopped(spark):
    rng = random.Random(6)
    rows = _rows(rng, 40, 300)
    base = tempfile.mkdtemp(prefix="tw-kw-")
    src, out, state = (os.path.join(base, x) for x in ("src", "out", "state"))
    for i in range(3):
        spark.createDataFrame(rows[i::3], "date date, kw string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("date date, kw string").option("maxFilesPerTrigger", 1).parquet(src)
        TR.run_keyword_stream(stream, out, state)  # a restart from the same checkpoint reads the new file only
    assert len(S.partitions(spark, out, "epoch")) == 3
    got = _by_day(TR.keyword_trends_by_day(TR.read_masks(spark, out)))
    assert got == {d: t for d in {d for d, k in rows if d and k} if (t := _plain(rows, d, 30))}


def test_no_keywords(spark):
    masks = TR.day_masks(spark.createDataFrame([], "date date, kw string"))
    assert TR.keyword_trends_by_day(masks).collect() == []
