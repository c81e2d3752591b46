"""All days at once against one day after the other; the stored state against the whole window."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import backfill as BF
from tidewatch.operators import rolling as RL
from tidewatch.operators import vectors as V
from tidewatch.sources import store as S

DAY0 = dt.date(2024, 1, 1)


def _history(rng, n_days, scopes=("a", "b")):
    """(scope, date, term, tf) with blank days, missing days, common and rare terms with many ties."""
    records = sorted(rng.sample(range(n_days), int(n_days * 0.8)))
    rows = []
    for day in records:
        for scope in scopes:
            if rng.random() < 0.8:
                for term in {rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randint(1, 12))}:
                    rows.append((scope, DAY0 + dt.timedelta(days=day), term, rng.randint(1, 3)))
    return rows, [DAY0 + dt.timedelta(days=d) for d in records]


def _frames(spark, rows, records, scopes=("a", "b", "blank")):
    tf = spark.createDataFrame(rows, "scope string, date date, term string, tf bigint")
    return tf, spark.createDataFrame([(d,) for d in records], "date date"), spark.createDataFrame([(s,) for s in scopes], "scope string")


@pytest.mark.parametrize("seed,features", [(1, 4), (2, 12)])
def test_backfill_equals_one_day_after_the_other(spark, seed, features):
    rng = random.Random(seed)
    rows, records = _history(rng, 9)
    tf, recs, scopes = _frames(spark, rows, records)
    days = 5
    got = {(r.scope, r.day, r.date): (round(r.sim, 9), r.n_docs, r.n_nonblank)
           for r in BF.similarity_backfill(tf, recs, scopes, days=days, max_features=features).collect()}
    want = {}
    for day in records:
        members = V.day_members(recs, scopes, day, days)
        for r in V.tfidf_similarity(tf, members, max_features=features).collect():
            want[r.scope, day, r.date] = (round(r.sim, 9), r.n_docs, r.n_nonblank)
    assert got == want and want


@pytest.mark.parametrize("seed", [5, 6])
def test_sliding_statistics_and_vocabulary_in_plain_python(spark, seed):
    rng = random.Random(seed)
    rows, records = _history(rng, 25)
    tf, recs, _ = _frames(spark, rows, records)
    days, features = 6, 5
    whole = {}
    for day in records:
        for scope, date, term, n in rows:
            if day - dt.timedelta(days=days) <= date <= day:
                ctf, df, q = whole.setdefault((scope, day), {}).get(term, (0, 0, 0))
                whole[scope, day][term] = (ctf + n, df + 1, n if date == day else q)
    intervals = BF.sliding_statistics(tf, days).collect()
    for (scope, day), terms in whole.items():
        at = {r.term: (r.ctf, r.df, r.arrived if r.start == day else 0) for r in intervals if r.scope == scope and r.start <= day < r.until}
        assert at == terms
    kept = {}
    for r in BF.sliding_vocabulary(tf, recs, days, features).collect():
        kept.setdefault((r.scope, r.day), {})[r.term] = (r.ctf, r.df, r.qtf)
    assert kept == {k: dict(sorted(t.items(), key=lambda x: (-x[1][0], x[0]))[:features]) for k, t in whole.items()}
    cuts = {(r.scope, r.day): (r.cut, r.above) for r in BF.vocabulary_cuts(BF.sliding_statistics(tf, days), recs, features).collect()}
    for key, terms in whole.items():
        counts = sorted((t[0] for t in terms.values()), reverse=True)
        cut = counts[features - 1] if len(counts) >= features else 0
        assert cuts[key] == (cut, sum(c > cut for c in counts) if cut else 0)


def test_backfill_without_history(spark):
    tf, recs, scopes = _frames(spark, [], [])
    assert BF.similarity_backfill(tf, recs, scopes).collect() == []
    tf, recs, scopes = _frames(spark, [("a", DAY0, "x", 1)], [DAY0])
    assert BF.similarity_backfill(tf, recs, scopes).collect() == []


def test_jobs_do_not_grow_with_the_days(spark):
    def stages(n_days):
        rows, records = _history(random.Random(0), n_days)
        plan = BF.similarity_backfill(*_frames(spark, rows, records), days=3)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join"), plan.count("Aggregate"), plan.count("Union")

    assert stages(6) == stages(24)


def _state_rows(df):
    return {(r.scope, r.term): (r.ctf, r.df) for r in df.collect()}


def _window(rows, day, days):
    out = {}
    for scope, date, term, n in rows:
        if day - dt.timedelta(days=days) <= date <= day:
            ctf, df = out.get((scope, term), (0, 0))
            out[scope, term] = (ctf + n, df + 1)
    return out


def test_state_equals_the_window_on_random_runs(spark):
    """Days in order with gaps, reruns of the last day with other texts, and a rerun of an older day."""
    rng, days = random.Random(11), 4
    base = tempfile.mkdtemp(prefix="tw-state-")
    terms_path, state_path = os.path.join(base, "terms"), os.path.join(base, "state")
    stored = {}

    def run(day):
        counts = [(s, t, n) for s in ("a", "b") if rng.random() < 0.8 for t, n in {(rng.choice("uvwxyz"), rng.randint(1, 3)) for _ in range(4)}]
        counts = list({(s, t): (s, t, n) for s, t, n in counts}.values())
        today = spark.createDataFrame(counts, "scope string, term string, tf bigint")
        terms = S.read_store(spark, terms_path, "scope string, term string, tf bigint")
        state = _state_rows(RL.update_state(terms, today, state_path, day, days))
        S.replace_day(today, terms_path, day)
        stored[day] = counts
        for later in [d for d in stored if d > day]:  # they are run again after an older day
            del stored[later]
            S.replace_day(today.limit(0), terms_path, later)
        rows = [(s, d, t, n) for d, c in stored.items() for s, t, n in c]
        assert state == _window(rows, day, days)

    for k in (0, 1, 2, 2, 3, 5, 6, 12, 13, 13, 6, 7):
        run(DAY0 + dt.timedelta(days=k))
    assert S.stored_days(spark, state_path) == [DAY0 + dt.timedelta(days=k) for k in (0, 1, 2, 3, 5, 6, 7)]


def test_similarities_from_a_state(spark):
    rows, records = _history(random.Random(21), 9)
    tf, recs, scopes = _frames(spark, rows, records)
    day = records[-1]
    members = V.day_members(recs, scopes, day, 5)
    state = RL.advance(spark.createDataFrame([], RL.STATE), tf.filter(F.col("date") >= F.lit(day - dt.timedelta(days=5))), tf.limit(0))
    plain = sorted(map(repr, V.tfidf_similarity(tf, members, max_features=6).collect()))
    assert plain == sorted(map(repr, V.tfidf_similarity(tf, members, max_features=6, state=state).collect())) and plain
