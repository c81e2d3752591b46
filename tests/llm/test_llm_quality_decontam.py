import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate as D
from tidewatch.llm import quality as Q
from tidewatch.llm.common import shingles, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def _docs(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def _words(n, seed=0):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]


def test_longest_repeats_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        a = np.array([rng.randint(0, 3) for _ in range(rng.randint(0, 30))], np.uint64)
        got = Q.longest_repeats(a)
        for i in range(len(a)):
            best = 0
            for j in range(len(a)):
                k = 0
                while i != j and i + k < len(a) and j + k < len(a) and a[i + k] == a[j + k]:
                    k += 1
                best = max(best, k)
            assert got[i] == best


def test_quality_cases(spark):
    clean = _words(200)
    block = _words(30, 5)
    texts = [" ".join(clean), None, "", " \t\n", " ".join(_words(49)), " ".join(block * 4),
             " ".join(clean[:120] + block + clean[120:] + block),     # 60 of 260 words repeat: below the limit
             " ".join(clean + clean[:101]),                           # one stretch of 101 words twice
             "# a\nb\n# a\n\n" + " ".join(clean), " ".join(clean)]
    got = {r.doc_id: r for r in Q.quality_rules(_docs(spark, texts)).collect()}
    assert [got[i].kept for i in range(10)] == [True, False, False, False, False, False, True, False, True, True]
    assert (got[1].n_words, got[3].n_words, got[5].base_failed, got[7].base_failed) == (0, 0, True, True)
    assert (got[8].n_dup_lines, got[8].n_symbols) == (1, 2)
    assert (got[6].covered_words, got[6].longest_repeat, got[6].n_repeat_words) == (60, 30, 60)
    kept = Q.keep_good(_docs(spark, texts))
    assert kept.columns == _docs(spark, texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(10) if got[i].kept]
    assert Q.quality_rules(_docs(spark, texts).limit(0)).count() == 0


def test_repeats_do_not_cross_texts(spark):
    text = " ".join(_words(80))
    rows = Q.quality_rules(_docs(spark, [text] * 5)).collect()
    assert all(r.n_repeat_words == 0 and r.kept for r in rows)


def test_very_long_text(spark):
    text = " ".join(_words(300_000))
    r = Q.quality_rules(_docs(spark, [text])).first()
    assert r.n_words == 300_000 and r.kept


def _contained(text, item):
    words, inside = words_of(text), words_of(item)
    width = min(5, len(inside))
    windows = lambda ws: {tuple(ws[i:i + width]) for i in range(len(ws) - width + 1)}
    return len(windows(words) & windows(inside)) / len(windows(inside)) if inside else 0.0


def test_short_items_inside_long_documents(spark):
    docs = ["one two red green blue three four five six", "Red, green; BLUE", "red green", "green blue red", "x " * 5000 + "red green blue " + "y " * 5000, "red", None]
    items = spark.createDataFrame([(1, "red green blue"), (2, "red"), (3, "blue three"), (4, "six seven")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in D.contained_items(_docs(spark, docs), items).collect())
    assert [g[:2] for g in got] == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (2, 2), (3, 2), (4, 1), (4, 2), (5, 2)]
    assert {g[2:] for g in got} == {(1, 1)}
    assert [r.doc_id for r in D.drop_contaminated(_docs(spark, docs).withColumn("found", F.lit(1)), items).collect()] == [6]


def test_only_candidates_are_verified():
    """The sketch picks the contained items out of many, some of which share a few shingles with the document."""
    rng = random.Random(3)
    texts = [_words(60, 1000 + i) for i in range(200)]
    for i in range(100, 200):
        texts[i][:8] = texts[i - 100][:8]  # four shingles in common
    items = [(i, np.unique(shingles(" ".join(t)))) for i, t in enumerate(texts)]
    block = D.ItemBlock(items)
    verified = found = 0
    for k in range(50):
        inside = rng.sample(range(100), 2)
        document = " ".join(_words(2000, 5000 + k) + texts[inside[0]] + _words(500, 6000 + k) + texts[inside[1]])
        candidates = block.candidates(np.unique(shingles(document)), np.empty(0, np.uint64)).tolist()
        verified += len(candidates)
        found += len(set(inside) & set(candidates))
        assert sorted(i for i, _ in block.matches(document, 0.8)) == sorted(inside)
    assert found == 100 and verified <= 200  # of 10,000 pairs


def test_decontamination_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = _words(400, 9)
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 12, 40, 80]))) for _ in range(30)] + [None, "", items_dup()]
    docs = []
    for k in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 4, 50, 3000]))]
        item = (items[k % 30] or "").split()
        if k % 3 == 0:
            words[len(words) // 2:len(words) // 2] = item
        elif k % 3 == 1 and len(item) > 10:
            words += item[:-1] if k % 2 else item[: len(item) // 2]
        docs.append(" ".join(words))
    docs += [None, "", docs[0]]
    it = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(0, items[0])], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in D.contained_items(_docs(spark, docs), it).collect())
    want = sorted((d, i) for d, t in enumerate(docs) for i, x in enumerate(items) if t and x and _contained(t, x) >= 0.8)
    assert got == want and len(got) >= 20
    kept = D.drop_contaminated(_docs(spark, docs), it)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(docs))) - {d for d, _ in got})


def items_dup():
    return " ".join(_words(20, 77))


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    items = [" ".join(_words(30, s)) for s in range(6)]
    docs = _docs(spark, [items[2] + " tail", "head " + items[5], "nothing here at all today"])
    it = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, D.contained_items(docs, it).collect()))
    monkeypatch.setattr(D, "BLOCK_SHINGLES", 40)
    assert sorted(map(tuple, D.contained_items(docs, it).collect())) == whole and len(whole) == 2
    assert [r.doc_id for r in D.drop_contaminated(docs, it).collect()] == [2]


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_decontamination_of_empty_tables(spark, empty):
    docs = _docs(spark, ["one two three four five six"])
    it = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    found = D.contained_items(docs.limit(0) if empty == "docs" else docs, it.limit(0) if empty == "items" else it)
    assert found.columns == ["doc_id", "item_id", "n_shared", "n_item", "containment"] and found.count() == 0
