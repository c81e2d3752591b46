import random
import zlib

import numpy as np

from pyspark.sql import functions as F

from tidewatch.llm import language as L
from tidewatch.llm import toxicity as T
from tidewatch.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def _segmentations(word, index, other, p):
    """Brute force: the sum over all ways to cut a word into pieces."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        piece = index.get(word[:n], other if n == 1 else None)
        if piece is not None:
            total += p[piece] * _segmentations(word[n:], index, other, p)
    return total


def test_forward_sums_all_segmentations():
    import public_tokenizers
    import sentencepiece

    lat = L.lattice()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(L.VOCABULARY))
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    index = {x: i for i, x in enumerate(pieces)}
    assert len(index) == lat.other
    p = np.random.RandomState(1).rand(lat.size) * 1e-2
    words = ["the", "straße", "a", "ą一z", "internation", "x" * 12]
    got = lat.log_likelihoods(words, p[:, None])[:, 0]
    want = [np.log(_segmentations("▁" + w, index, lat.other, p)) for w in words]
    assert np.allclose(got, want)
    # long words: no cuts, no underflow; the plain recursion in logarithms
    for long in ("ab" * 40, "internation" * 300, "中" * 2000, "straße" * 7):
        word, logs = "▁" + long, [0.0]
        for end in range(1, len(word) + 1):
            terms = [logs[end - n] + np.log(p[i]) for n in range(1, min(end, 40) + 1)
                     if (i := index.get(word[end - n:end], lat.other if n == 1 else None)) is not None]
            logs.append(np.logaddexp.reduce(terms))
        assert np.isclose(lat.log_likelihoods(["a", long, "the"], p[:, None])[1, 0], logs[-1])


def test_em_counts_in_plain_python():
    """One round of expected counts on long and short words against forward and backward sums in logarithms."""
    from collections import Counter

    lat, counts = L.lattice(), Counter({"banana": 3, "na" * 60: 2, "ą": 1})
    p, words = lat.fit(counts, 0), ["▁" + w for w in counts]
    expected = np.zeros(lat.size)
    for w, c in zip(words, counts.values()):
        e = lat.edges([w])[:, 1:]
        a, b = np.full(len(w) + 1, -np.inf), np.full(len(w) + 1, -np.inf)
        a[0] = b[len(w)] = 0
        for s, t, i in sorted(e.tolist(), key=lambda x: x[1]):
            a[t] = np.logaddexp(a[t], a[s] + np.log(p[i]))
        for s, t, i in sorted(e.tolist(), key=lambda x: -x[0]):
            b[s] = np.logaddexp(b[s], b[t] + np.log(p[i]))
        for s, t, i in e.tolist():
            expected[i] += c * np.exp(a[s] + np.log(p[i]) + b[t] - a[len(w)])
    assert np.allclose(lat.fit(counts, 1), lat._normal(expected))


def test_em_raises_the_likelihood():
    from collections import Counter

    rng = random.Random(3)
    counts = Counter("".join(rng.choice(["ba", "na", "lo", "ri"]) for _ in range(rng.randint(1, 4))) for _ in range(500))
    lat, words = L.lattice(), sorted(counts)
    n = np.array([counts[w] for w in words])
    scores = [float(n @ lat.log_likelihoods(words, lat.fit(counts, r)[:, None])[:, 0]) for r in (0, 1, 3)]
    assert scores[0] < scores[1] <= scores[2]


def test_language_cases(spark):
    texts = [("the weather is nice and we are going out to the harbour", "en"), ("das Wetter ist schön und wir gehen an den Hafen", "de"),
             ("the children are playing with their friends in the garden", "en"), ("die Kinder spielen mit ihren Freunden im Garten", "de"),
             (None, "en"), ("", None), ("12 34 !?", "de"), ("the garden and the harbour", None), ("der Garten und der Hafen", None), ("the " * 50_000, None)]
    docs = spark.createDataFrame([(i, t, lang, "x") for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in L.identify(docs, F.col("doc_id") < 7).collect()}
    assert [got[i].lang_pred for i in range(10)] == ["en", "de", "en", "de", "und", "und", "und", "en", "de", "en"]
    assert got[4].score == 0.0 and all(0 <= r.score <= 1 for r in got.values())
    assert L.identify(docs.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in L.identify(docs, F.lit(False)).collect()} == {"und"}  # nothing to learn from


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = REGISTRY["op7_language_id"](spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert sum(held) / len(held) >= 0.97


def test_toxicity_features_and_copies():
    assert T.features(None) == set() and T.features("Abcdefg abcdefh") >= {"abcdefg", "^abcde", "^abcde#2", "^abcdef#2"}
    assert T.counterfactuals("Women came. The women left! men") == [("women", "men"), ("women", "men"), ("men", "muslims")]
    base = " ".join(f"w{i}" for i in range(60))
    prints = [T.fingerprint(t) for t in (base, base + " more words here", " ".join(f"v{i}" for i in range(60)), None)]
    a, b, c, d = T.near_copies(prints)
    assert a == b and len({a, c, d}) == 3


def test_counterfactual_penalty_evens_out_identity_terms():
    rows = [{"men"}] * 40 + [{"muslims"}] * 40 + [{"vile", "muslims"}] * 30 + [{"fine", "men"}] * 30
    toxic = [0] * 80 + [1] * 30 + [0] * 30
    chosen = ["vile", "fine", "men", "muslims"]
    _, free = T.train(rows, toxic, chosen, [])
    _, fair = T.train(rows, toxic, chosen, [("men", "muslims")] * 20)
    gap = lambda w: abs(w.get("men", 0.0) - w.get("muslims", 0.0))
    assert gap(fair) < 0.3 * gap(free) and fair["vile"] > 1


def test_swaps_are_feature_differences():
    text = "Muslims met here. Two muslims and a muslimah left!"
    whole = {(tuple(sorted(T.features(a) - T.features(b))), tuple(sorted(T.features(b) - T.features(a))))
             for a, b in ((x, x.lower().replace("muslims", "christians")) for x in [text, *text.split(".")])}
    assert set(T.swapped(text)) == whole and any("muslims#2" in lost for lost, _ in whole) and any("^musli" in lost for lost, _ in whole)
    assert not T.swapped(None) and not T.swapped("no group here")


def test_counterfactual_penalty_covers_beginnings_and_counts(spark):
    rng = random.Random(5)
    plain = [" ".join(f"w{rng.randrange(3000)}" for _ in range(40)) for _ in range(400)]
    # the toxic texts name one group, twice; the clean ones another
    texts = [t + (" vile stuff. muslims and muslims" if i % 2 else " fine stuff. christians and christians") for i, t in enumerate(plain)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    b, weights = T.fit(docs, labels)
    logit = lambda t: b + sum(weights.get(f, 0.0) for f in T.features(t))
    assert abs(logit("muslims met") - logit("christians met")) < 0.5
    assert abs(logit("muslims and muslims") - logit("christians and christians")) < 0.5
    assert logit("vile") - logit("fine") > 2


def test_neutral_phrases_give_pairs_to_texts_without_a_mention():
    text = "Nothing said here. Immigration and asiatic trade!"
    pairs = T.carried(text)
    assert len(pairs) == len(T._LISTS) and {t for _, t in pairs} <= T._SWAP.keys()
    for words, term in pairs:
        x, y = T.features(" ".join(words)), T.features(" ".join(T._SWAP[term] if w == term else w for w in words))
        assert T.changes([(words, term)]) == {(tuple(sorted(x - y)), tuple(sorted(y - x))): 1}
    assert T.carried(None) == T.carried("") == T.carried("... 12") == T.carried("the women met. all") == []
    assert all(a != b and b in T._SWAP for a, b in T._SWAP.items())


def test_score_gap_of_held_out_texts_with_and_without_the_penalty(spark):
    rng = random.Random(8)
    # no text names a group, but beginnings of the terms go with one class
    plain = [" ".join(f"w{rng.randrange(3000)}" for _ in range(40)) for _ in range(700)]
    texts = [t + (" immigration muslimgate blindly vile" if i % 2 else " refuge christianity fine") for i, t in enumerate(plain[:400])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    held = spark.createDataFrame([*enumerate(plain[400:]), (300, None), (301, "the muslims met")], "doc_id long, text string")
    gap = {}
    for fair in (0.0, T.FAIR):
        model = T.fit(docs, labels, fair)
        rows = T.swap_gap(held, model).collect()
        assert all((r.gap is None) == (r.pairs == 0) == (r.doc_id == 300) for r in rows)
        gap[fair] = np.mean([r.gap for r in rows if r.gap is not None])
        assert all((r.score >= 0.5) == r.doc_id % 2 for r in T.score(docs, model).collect())
    assert gap[T.FAIR] < 0.5 * gap[0.0] and gap[0.0] > 0.05


def test_a_shared_passage_makes_no_near_copies():
    rng = random.Random(2)
    words = lambda n: " ".join(f"u{rng.randrange(10 ** 9)}" for _ in range(n))
    passage, base = words(50), words(400)
    texts = [f"{passage} {words(50)}" for _ in range(300)] + [f"one {i}" for i in range(20)]
    copies = [f"{base} {words(3)}" for _ in range(30)] + [base, base]
    got = T.near_copies([T.fingerprint(t) for t in texts + copies])
    assert len(set(got[:320])) == 320 and len(set(got[320:])) == 1 and got[320] == 320


def test_near_copies_share_one_weight(spark):
    rows, toxic, chosen = [{"a"}] * 4 + [{"b"}], [1, 1, 1, 1, 0], ["a", "b"]
    halved = T.train(rows, toxic, chosen, [], [0.25] * 4 + [1])
    alone = T.train(rows[3:], toxic[3:], chosen, [])
    assert np.isclose(halved[0], alone[0]) and all(np.isclose(halved[1][k], alone[1][k]) for k in chosen)
    # toxic texts of one long shared passage, each with the same insult: all of them count
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(40))
    plain = [" ".join(f"w{rng.randrange(3000)}" for _ in range(60)) for _ in range(200)]
    texts = [f"{t} {passage} blockhead" if i % 4 == 0 else t for i, t in enumerate(plain)]
    docs = spark.createDataFrame([*enumerate(texts), (200, "you blockhead")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in T.classify(docs, labels, F.lit(True)).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(200))


def test_toxicity_cases(spark):
    rng = random.Random(1)
    plain = [" ".join(f"w{rng.randrange(3000)}" for _ in range(60)) for _ in range(240)]
    texts = [t + (" blockhead" if i % 6 == 0 else "") for i, t in enumerate(plain)] + [None, "", "women and blind refugees met"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "blockhead", "x")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(200)] + [(0, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in T.classify(docs, labels, F.lit(True)).collect()}
    assert len(got) == len(texts) + 1 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.7) == (i % 6 == 0) for i in range(240))
    assert got[None] >= 0.7 and got[240] == got[241] < 0.7 and got[242] < 0.7
    assert T.classify(docs.limit(0), labels, F.lit(True)).count() == 0
    assert T.classify(docs, labels.limit(0), F.lit(True)).count() == len(texts) + 1


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = REGISTRY["op6_toxicity"](spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    toxic, clean = [r.score for r in held if r.toxic == 1], [r.score for r in held if r.toxic == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc >= 0.85 and np.mean([s >= 0.7 for s in clean]) <= 0.02
