import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidewatch.llm import packing as P
from tidewatch.llm import sharding as S
from tidewatch.llm.tokenize import coder


def _check_plan(histogram, capacity):
    ranks, fill = defaultdict(list), defaultdict(list)
    for length, first, count, first_bin, offset in P.plan(histogram, capacity):
        for i in range(count):
            ranks[length].append(first + i)
            fill[first_bin + i].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items() if c}
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    return len(fill)


def _best_fit(histogram, capacity):
    """Plain best-fit decreasing, one piece after the other."""
    gaps = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


def test_plan_places_everything_once_and_packs_well():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([10, 64, 100])
        histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 200)))
        bins = _check_plan(dict(histogram), capacity)
        lower = -(-sum(n * c for n, c in histogram.items()) // capacity)
        assert lower <= bins <= _best_fit(histogram, capacity) * 1.05 + 1


def test_large_items_pair():
    # 60 + 40, 55 + 45: two sequences, not three
    assert _check_plan({60: 1, 55: 1, 45: 1, 40: 1}, 100) == 2
    assert _check_plan({34: 3}, 100) == 2  # at most two large ones together
    assert _check_plan({50: 1000}, 100) == 500


def test_token_ids_equal_the_tokenizer():
    k, rng = coder(), random.Random(8)
    letters = [chr(i) for i in range(256)] + list("'''sdtrevlm  \n\tABcéÉ")
    texts = ["", "It's DON'T we've", "naïve CAFÉ 12³ x²", "Straße İΣς", "日本 語x", "<|endoftext|> a", "a\x85b\xa0c\x1cd"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for t in texts:
        assert k.encode(t) == k.whole(t), repr(t)


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, length string").repartition(3)


def test_pack_round_trip(spark):
    texts = [None, "", "a b c", "a b c", "word " * 5000, "x1 " * 200] + ["tok " * (37 * i % 900) for i in range(60)]
    rows = P.pack(_docs(spark, texts), with_ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, t in enumerate(texts):
        got = sorted(by_doc[i], key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in got) == coder().whole(t or "") + np.array([1], "<u4").tobytes()
        assert [r.start for r in got] == [4096 * k for k in range(len(got))]
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(by_seq) <= -(-total // 4096) + 1
    assert P.pack(_docs(spark, texts).limit(0)).count() == 0


def test_differencing_is_exact_and_tight():
    rng = np.random.RandomState(2)
    for n in (1, 2, 9, 300):
        weights = rng.randint(1, 10_000, n)
        tuples = np.zeros((n, 4), np.int64)
        tuples[:, 0] = weights
        sums, to = S.difference(tuples)
        back = np.zeros(4, np.int64)
        for i in range(n):
            assert sorted(to[i]) == [0, 1, 2, 3]
            back[to[i, 0]] += weights[i]
        assert (back == sums).all()
    assert sums.max() - sums.min() <= 10
    # the textbook case: differencing gives 16 and 14 for 8 7 6 5 4
    tuples = np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    assert sorted(S.difference(tuples)[0]) == [14, 16]


def test_sharding_cases(spark):
    rng = random.Random(6)
    texts = [None, "", "same"] + ["same"] * 200 + ["".join(rng.choice("abcé") for _ in range(rng.randint(0, 60))) for _ in range(900)]
    docs = _docs(spark, texts)
    rows = S.shard(docs).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    place, slots, load = {}, defaultdict(list), Counter()
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None)
        assert place.setdefault(t, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert max(load.values()) - min(load.values()) <= 2
    assert S.shard(docs.limit(0)).count() == 0


def _spread(spark, weights, shards, **options):
    groups = spark.createDataFrame([(str(i).encode(), w) for i, w in enumerate(weights)], "text_key binary, weight long")
    sums, seen = Counter(dict.fromkeys(range(shards), 0)), set()
    for r in S.group_shards(groups, shards, **options).collect():
        seen.add(bytes(r.text_key))
        sums[r.shard] += weights[int(r.text_key)]
    assert len(seen) == len(weights)
    return max(sums.values()) - min(sums.values()), sum(weights)


def test_sharding_in_blocks_fills_around_large_groups(spark):
    rng = random.Random(9)
    small = [rng.randint(1, 3000) for _ in range(6000)]
    for large in ([], [400_000], [900_000, 300_000, 5_000]):
        spread, total = _spread(spark, small + large, 8, block_groups=300, least_class=100)
        assert spread <= 5, (large, spread)
    spread, total = _spread(spark, [1000] * 5000, 8, block_groups=300, least_class=100)  # all ties
    assert spread <= 1000
    # a group beyond an eighth can't be evened out: the others share the rest
    spread, total = _spread(spark, small + [sum(small)], 8, block_groups=300, least_class=100)
    assert abs(spread - (sum(small) - sum(small) / 7)) <= 0.01 * total


def test_deficits_fill_to_one_level():
    assert S._deficits([0, 0], 10) == [5, 5] and S._deficits([10, 0, 4], 5) == [0, 4, 0] and S._deficits([100, 0], 7) == [0, 7]
    assert S._deficits([3, 1], 0) == [0, 0]
