import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm import codes as C
from tidewatch.llm import lm as L
from tidewatch.llm import queries as Q
from tidewatch.llm import repair as R
from tidewatch.llm.common import mix64

# ---------------------------------------------------------------- op11


def test_limb_products_are_exact():
    rng = random.Random(3)
    for bits, top in ((3, 1000), (11, 1 << 27), (25, 1 << 27)):
        x = np.array([[rng.randint(-top, top) for _ in range(5)] for _ in range(40)], np.int64)
        c = np.array([[rng.choice((-top, top, rng.randint(-top, top))) for _ in range(5)] for _ in range(7)], np.int64)
        want = [[sum(int(a) * int(b) for a, b in zip(u, w)) for w in c] for u in x]
        assert C.exact_dots(x, c, bits).tolist() == want
        assert all(np.abs(limb).max() < 1 << bits for limb in C.limbs(x, bits))
        assert sum(limb.astype(np.int64) << (bits * i) for i, limb in enumerate(C.limbs(x, bits))).tolist() == x.tolist()
    for terms in (1, 4, 5, 1000):
        assert terms * (2 ** C.limb_bits(terms)) ** 2 <= 2 ** 53


def _plain_codes(rows, shape, rounds):
    kept = [(i, [math.floor(shape.scale * y) for y in v], lab) for i, v, lab in rows
            if v is not None and all(y is not None and math.isfinite(y) for y in v)]
    w = len(kept[0][1]) // shape.parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:shape.entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(shape.parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, book in enumerate(books):
            got = {}
            for _, v, _ in kept:
                got.setdefault(near(cut(v, p), book)[0], []).append(cut(v, p))
            for e, xs in got.items():
                book[e] = [sum(col) // len(xs) for col in zip(*xs)]
    sha = hashlib.sha256(",".join(str(y) for b in books for c in b for y in c).encode()).hexdigest()
    found = [(i, [near(cut(v, p), books[p]) for p in range(shape.parts)], lab) for i, v, lab in kept]
    sums = Counter()
    for _, f, lab in found:
        sums[lab] += sum(d for _, d in f)
    return sorted((repr(i), "".join(f"{c:02x}" for c, _ in f), sum(d for _, d in f), sums[lab], sha) for i, f, lab in found)


FIELDS11 = "vec_id bigint, embedding array<double>, label int, codes string, v int, `of` int"


@pytest.mark.parametrize("size,n", [(1.0, 150), (0.004, 150), (300_000.0, 60), (1.0, 5)])
def test_codes_equal_plain_rounds(spark, size, n):
    rng = random.Random(n)
    rows = [(i, [rng.uniform(-size, size) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += rows[:3] + [(None, rows[0][1], 7), (n, None, 1), (n + 1, [float("nan")] * 8, 1), (n + 2, [None] * 8, 1), (n + 3, [float("-inf")] * 8, 1)]
    rng.shuffle(rows)
    shape = C.Shape(parts=4, entries=16)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], FIELDS11).repartition(5)
    got = C.compress(df, shape).collect()
    assert sorted((repr(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == _plain_codes(rows, shape, 2)


def test_codes_of_odd_tables(spark):
    assert C.compress(spark.createDataFrame([], FIELDS11)).collect() == []
    assert C.compress(spark.createDataFrame([(1, None, 1, "", 1, 1)], FIELDS11)).collect() == []
    for wrong in ([[0.0] * 16, [0.0] * 32], [[0.0] * 9], [[1e30] * 16]):
        with pytest.raises(Exception, match="length|exactly"):
            C.compress(spark.createDataFrame([(i, v, 1, "", 1, 1) for i, v in enumerate(wrong)], FIELDS11)).collect()


# ---------------------------------------------------------------- op12

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def _cheapest(rows):
    """Least (cost, audit) with its repaired lines by a best-first search over (row, last role, edits so far)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        if i == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(lines)
        seen.add((i, last))
        push = lambda c, a, j, st, *line: heapq.heappush(heap, (cost + c, audit + a, j, st, (*lines, *line)))
        for r in NEXT[last].replace("s", ""):
            push(5, "I", i, r, {"u": "user:", "a": "assistant:"}[r])
        if i < len(rows):
            role, text, fault = rows[i]
            push(2, "D", i + 1, last)
            if fault not in ("blank", "duplicate"):
                pen = 5 if fault == "truncated" else 0
                if role[:1] and role[:1] in NEXT[last]:
                    push(pen, "K", i + 1, role[0], f"{role}:{text}")
                for r in NEXT[last].replace("s", ""):
                    push(1 + pen, "R", i + 1, r, {"u": "user:", "a": "assistant:"}[r] + text)


def _plain_repair(turns, ids):
    out = []
    for conv in ids:
        mine = sorted(((t is not None, t or 0, r, hashlib.md5(x.encode()).hexdigest(), x) for c, t, r, x in turns if c == conv))
        rows, seen, faults = [], set(), Counter()
        for _, _, role, _, text in mine:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            rows.append((role, text, fault))
        known = {t for there, t, *_ in mine if there}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = _cheapest(rows)
        out.append((repr(conv), gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                    hashlib.sha256(lines.encode()).hexdigest()))
    return sorted(out)


FIELDS12 = "conv_id bigint, turn bigint, role string, text string, block string, pos int, b int, cut int"


def _conversations(rng, sizes):
    text = ["Yes.", "No", " ", "", "So what?", "x" * 3000 + "!", "a.b", "Fine.\n", "é!\x0b", "..", "\x1c"]
    role = ["user", "assistant"] * 6 + ["system", "tool", "", "User", "assist"]
    rows = []
    for conv, n in sizes.items():
        for i in range(n):
            body = rng.choice(text) if rng.random() < 0.4 else f"Say {rng.randint(0, 10 ** 6)}" + rng.choice([".", "!", "", " ?"])
            rows.append((conv, rng.choice([i, i, i, None, i // 2]), rng.choice(role), body))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_rows", [4, 16, R.BLOCK_ROWS])
def test_repair_equals_a_search_over_all_edits(spark, block_rows):
    rng = random.Random(block_rows)
    sizes = {i: rng.randint(1, 9) for i in range(60)} | {None: 5, 1000: 150, -3: 40}
    turns = _conversations(rng, sizes)
    # one conversation of a single role each: vectors that converge late or never
    turns += [(2000, i, "system", f"s{i}.") for i in range(33)] + [(2001, i, "user", f"u{i}.") for i in range(30)]
    turns += [(2002, i, "user", "same.") for i in range(30)] + [(2003, i, "tool", f"cut {i}") for i in range(21)]
    ids = [*sizes, 2000, 2001, 2002, 2003]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in turns], FIELDS12).repartition(3)
    done = R.repair(df, rows=block_rows)
    got = R.report(df, done).collect()
    want = _plain_repair(turns, ids)
    assert sorted((repr(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got) == want
    if block_rows == 16:  # the other outputs agree with the report
        lines = {}
        for r in R.repaired_turns(done).orderBy("pos", "sub").collect():
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        shas = {repr(k): hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in lines.items()}
        assert shas == {w[0]: w[-1] for w in want if w[-1] != R.EMPTY_SHA}
        assert {repr(r.conv_id): (r.cost, r.audit) for r in R.audits(done).collect()} == {w[0]: w[6:8] for w in want}


def test_fix_up_stops_where_vectors_agree():
    rng = random.Random(5)
    for _ in range(300):
        letters = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(1, 30)))
        tails = [R._base([rng.randint(0, 9) for _ in range(4)]) for _ in range(2)]
        heads = [R.head_vector(letters, t) for t in tails]
        assert R.fixed_head(letters, tails[0], heads[0], tails[1]) == heads[1]
    before = R.step_back.cache_info()
    assert R.fixed_head("ua" * 50_000, (0, 0, 0, 0), R.head_vector("ua" * 50_000, (0, 0, 0, 0)), R.END)
    after = R.step_back.cache_info()
    assert after.hits + after.misses - before.hits - before.misses < 100_000 + 50  # the head, then a few rows again


def test_repair_of_empty_and_null_rows(spark):
    none = spark.createDataFrame([], FIELDS12)
    assert R.report(none, R.repair(none)).collect() == []
    rows = [(None, None, None, None, "", 1, 1, 1), (4, None, "user", "Hi.", "", 1, 1, 1), (4, 1, "assistant", "Yo.", "", 1, 1, 1)]
    df = spark.createDataFrame(rows, FIELDS12)
    got = {r.conv_id: r for r in R.report(df, R.repair(df)).collect()}
    assert (got[None].blank, got[None].audit, got[None].gaps, got[None].repaired_sha256) == (1, "D", 0, R.EMPTY_SHA)
    assert (got[4].audit, got[4].cost, got[4].gaps) == ("KK", 0, 0)


def test_damage_by_checksum(spark):
    rows = [(c, t, r, x) for c in (None, 3, 77) for t in (None, *range(30)) for r, x in [("assistant", f"A.b! {t}?"), (None, None)]]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], FIELDS12)
    want = []
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(repr, (tuple(r) for r in R.damage(df).collect()))) == sorted(map(repr, want))


# ---------------------------------------------------------------- op13

def test_levels_and_their_middle():
    counts = np.array([0, 1, 2, 3, 4, 7, 8, 1 << 40, (1 << 52) - 1])
    assert L.levels_of_counts(counts).tolist() == [int(c).bit_length() for c in counts]
    assert L.middle(np.arange(5)).tolist() == [0.0, 1.0, 2.5, 5.5, 11.5]


def test_filter_is_never_too_low_and_seldom_too_high():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2 ** 64, 60_000, dtype=np.uint64))
    held, absent = hashes[::2], hashes[1::2]
    counts = rng.zipf(1.5, len(held)).clip(1, 10 ** 9)
    for segments in (1, 7):
        of = L.segment_of(held, segments)
        parts = [(s, L.segment_bits(held[of == s], counts[of == s]).tobytes()) for s in range(segments)]
        f, exact = L.LogFilter(parts, segments), L.levels_of_counts(counts)
        got = f.levels(held)
        assert (got >= exact).all() and (got > exact).mean() < 0.02
        assert (f.levels(absent) > 0).mean() < 0.02
        assert sum(len(b) for _, b in parts) <= exact.sum() * 1.3 + 8 * segments


TEXTS = ["the cat sat on the mat", "The  dog\tsat on\nthe cat .", None, "", " \x0b\x0c", "a " * 5000, "É é É naïve \x1cword", "the cat sat on the mat",
         "the mat sat", "ünïcode stays one"]
FIELDS13 = "doc_id bigint, text string, train int, block int, counts string, payload int"


def _plain_lm(rows, learn, filter_of):
    words = lambda t: (t or "").encode().lower().split() + [b"\n"]
    counts, pairs = Counter(), Counter()
    for (_, text, *_), on in zip(rows, learn):
        if on:
            w = words(text)
            counts.update(w)
            pairs.update(zip([b"\n", *w], w))
    n, v = sum(counts.values()), len(counts)
    h = lambda w: xxhash.xxh64_intdigest(w)
    h2 = lambda a, b: int(mix64(np.array([h(a) * 0xD1342543DE82EF95 + h(b) & (1 << 64) - 1], np.uint64))[0])
    grams = {h(w): c for w, c in counts.items()} | {h2(a, b): c for (a, b), c in pairs.items()}
    f = filter_of(grams)
    level = lambda g: int(f.levels(np.array([g], np.uint64))[0])
    q = lambda k: (3 * 2 ** (k - 1) - 1) / 2 if k else 0
    out = []
    for key, text, *_ in rows:
        w, score = words(text), 0.0
        for a, b in zip([b"\n", *w], w):
            both = min(level(h2(a, b)), level(h(a)), level(h(b)))
            score += math.log10((q(both) + L.MU * (q(level(h(b))) + 1) / (n + v + 1)) / (q(level(h(a))) + L.MU))
        out.append((key, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), score))
    return sorted(out, key=repr)


def _whole_filter(grams):
    hashes = np.array(sorted(grams), np.uint64)
    return L.LogFilter([(0, L.segment_bits(hashes, np.array([grams[int(g)] for g in hashes])).tobytes())], 1)


@pytest.mark.parametrize("none_learned", [False, True])
def test_scores_equal_a_plain_model(spark, none_learned):
    rng = random.Random(2)
    vocabulary = "the a cat dog sat mat on runs".split()
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) for _ in range(40)]
    rows = [(i if i != 7 else None, t, 1, 2, "x", 3) for i, t in enumerate(texts)] + [(3, texts[0], 1, 2, "x", 3)]
    learn = [not none_learned and r[0] is not None and r[0] % 3 != 0 for r in rows]
    df = spark.createDataFrame(rows, FIELDS13).repartition(3)
    mark = F.lit(False) if none_learned else F.col("doc_id") % 3 != 0  # null for the null id: not learned
    got = L.score(df, mark).collect()
    want = _plain_lm(rows, learn, _whole_filter)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


def test_scores_by_shuffle_equal_those_by_broadcast(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learn = Q.fold(7) != 2
    ways = [L.score(docs, learn, segment_tokens=5_000, broadcast_bytes=size).orderBy("doc_id").collect() for size in (0, L.BROADCAST_BYTES)]
    assert ways[0] == ways[1] and len(ways[0]) == docs.count()


def test_held_out_texts_are_likelier_than_shuffled_words(spark):
    rng, words = random.Random(9), [f"w{i}" for i in range(40)]

    def chain(n):
        at, out = rng.randrange(40), []
        for _ in range(n):
            at = (3 * at + rng.randint(1, 3)) % 40  # three followers a word
            out.append(words[at])
        return out

    texts = [chain(60) for _ in range(300)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(-i - 1, " ".join(rng.sample(t, len(t)))) for i, t in enumerate(texts)]
    learn = (F.col("doc_id") >= 0) & (Q.fold(7) != 2)
    got = {r.doc_id: r for r in L.score(spark.createDataFrame(rows, "doc_id bigint, text string"), learn).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert held and all(got[i].score > got[-i - 1].score + 10 for i in held)
    per_token = sum(got[i].score for i in held) / sum(got[i].n_tokens for i in held)
    assert -0.62 < per_token < -0.47  # a third each: log10(1/3) = -0.477


def test_scores_of_an_empty_table(spark):
    assert L.score(spark.createDataFrame([], FIELDS13), F.lit(True)).collect() == []
