import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.functions.ngrams import count_windows, explode_ngrams, padded_line, window_counts
from tidewatch.operators import vectors as V

D = dt.date(2024, 1, 30)


def test_windows_give_the_ngrams_of_every_place(spark):
    texts = ["Ab ab　abcdé 😀x\x00 ΟΔΟΣ. İx\n\x1cy", "", "  ", None, "漢字漢字漢字", "abcd"]
    df = spark.createDataFrame([("s", D, t) for t in texts] + [(None, D, "null scope")], "scope string, date date, text string")
    words = df.select("scope", "date", F.explode(F.split(F.lower("text"), "[\\s　\x1c]+")).alias("word")).filter("word <> ''")
    want = Counter((r.scope, r.term) for r in explode_ngrams(words, "word").collect())
    got = {(r.scope, r.term): r.tf for r in V.term_counts(df).collect()}
    assert got == want


def test_more_letters_than_fit_in_an_integer():
    line = padded_line("".join(chr(c) for c in range(0x4E00, 0x4E00 + 300)) + " ab")
    windows, counts = count_windows(line, len(line), 2, 8)  # nine bits a letter
    assert Counter(dict(zip(windows, counts))) == Counter(w for p in line.split("\n") for i in range(len(p)) if len(w := p[i:i + 8]) >= 2)


def test_counting_stops_at_chunks_without_losing_places(monkeypatch, spark):
    from tidewatch.functions import ngrams
    whole = Counter(dict(zip(*count_windows(line := padded_line("abc de abcd " * 50), len(line)))))
    monkeypatch.setattr(ngrams, "BLOCK", 7)
    parts = Counter()
    for at in range(0, len(line), 13):
        for w, n in zip(*count_windows(line[at:at + 13 + 3], min(13, len(line) - at))):
            parts[w] += n
    assert parts == whole


def test_rows_to_shuffle_grow_with_ngrams_not_with_words(spark):
    letters = "abcd"
    words = [a + b + c + d + e for a in letters for b in letters for c in letters for d in letters for e in letters]  # 1,024 words, 4-grams repeat
    df = spark.createDataFrame([("s", D, " ".join(words))], "scope string, date date, text string").coalesce(1)
    rows = window_counts(df, ["scope", "date"])
    assert rows.count() < len(words)
    plan = V.term_counts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1  # no aggregation of words before that of n-grams
