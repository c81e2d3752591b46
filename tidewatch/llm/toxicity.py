"""Toxicity: a counterfactual-regularised linear classifier.

Features are a text's distinct words and their beginnings, by how often they occur.  Loss of the logistic model over labelled texts:

    mean logloss + L2 |w|^2 + FAIR * mean over pairs (score(x) - score(x'))^2

where x' is a labelled text or sentence x with every mention of an identity term swapped for
another one (IDENTITY_TERMS, IDENTITY_SINGULARS), so the score can't lean on which group a text mentions.  A labelled text that names no
group gives pairs, too: a neutral phrase with a term (CARRIERS) is put into one of its sentences, and into x' with the other term.
If a sample has both kinds of pairs, each kind has a mean and a penalty of its own.  The
difference is over all keys a swap changes: words, their beginnings and occurrence counts.  ``swap_gap`` measures what is left of it.
These keys are always features, others enter if they differ more between the classes than
chance allows for as many words (z of the log odds, with a least support).
Copies and near copies of a text (Jaccard similarity of at least NEAR to the first of their class) share
the weight of one row a label, else the chance label of one copied text would make its words look
toxic.  No row is left out.

Fitted on a bounded sample of labelled rows (MAX_TOXIC, MAX_CLEAN: expected sizes of a hash sample), so the
broadcasts of its ids (about 12,000 rows) and the single tasks that group its near copies and run the
descent have a fixed bound; features are tallied by Spark.
Scoring reads every whole text once, without a shuffle; the model is at most MAX_FEATURES weights.

Defined cases: null and empty texts score the intercept; repeated ids in ``labels`` count
once (toxic if any row says so), null ids or labels are left out; without labels of both classes
the score is the share of toxic ones (0 if none); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import MEMO_ENTRIES, mix64, shared_table, shingles, slices
from tidewatch.llm.language import hash_share

MAX_TOXIC = 4_000
MAX_CLEAN = 8_000
MAX_FEATURES = 2_000
LEAST_SUPPORT = 5
Z_MARGIN = 0.4              # above sqrt(2 ln m), the largest z that m unrelated words reach by chance
PRINTS = 8                  # minima that find near copies in training
EQUAL = 6                   # of them equal: compared
NEAR = 0.8                  # Jaccard similarity of near copies
SKETCH = 256                # smallest shingle hashes of a text; up to so many shingles the similarity is exact
L2 = 5e-5
FAIR = 1.0
STEPS = 400
PREFIXES = (5, 6, 7, 8)      # lengths of word beginnings
LEVELS = (1, 2, 4)          # occurrence counts that are features of their own
THRESHOLD = 0.7

# fixed values: group mentions that are swapped for one another, by language
IDENTITY_TERMS = {
    "en": ["women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees",
           "gay", "lesbian", "straight", "transgender", "black", "white", "asian", "african", "disabled", "deaf", "blind", "elderly"],
    "de": ["frauen", "männer", "muslime", "christen", "juden", "hindus", "buddhisten", "migranten", "flüchtlinge", "schwule",
           "lesben", "schwarze", "weiße", "asiaten", "behinderte", "gehörlose", "blinde", "senioren"],
    "fr": ["femmes", "hommes", "musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "immigrés", "réfugiés", "gays",
           "lesbiennes", "noirs", "blancs", "asiatiques", "handicapés", "sourds", "aveugles", "aînés"],
    "es": ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "hindúes", "budistas", "inmigrantes", "refugiados",
           "gais", "lesbianas", "negros", "blancos", "asiáticos", "discapacitados", "sordos", "ciegos", "ancianos"],
}
IDENTITY_SINGULARS = {
    "en": ["woman", "man", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee"],
    "de": ["frau", "mann", "muslim", "muslimin", "christ", "christin", "jude", "jüdin", "hindu", "buddhist", "migrant", "migrantin", "flüchtling",
           "lesbe", "asiate", "behinderter", "gehörloser", "blinder", "seniorin"],
    "fr": ["femme", "homme", "musulman", "musulmane", "chrétien", "chrétienne", "juif", "juive", "hindou", "bouddhiste", "immigré", "immigrée",
           "réfugié", "réfugiée", "lesbienne", "asiatique", "handicapé", "sourd", "aveugle", "aîné"],
    "es": ["mujer", "hombre", "musulmán", "musulmana", "cristiano", "cristiana", "judío", "judía", "hindú", "budista", "inmigrante",
           "refugiado", "refugiada", "lesbiana", "asiático", "discapacitado", "sordo", "ciego", "anciano", "anciana"],
}
# fixed values: neutral phrases that name a group or one of it
CARRIERS = {
    "en": ("the people here are {}", "my neighbour is a {}"),
    "de": ("die leute hier sind {}", "jemand von nebenan ist {}"),
    "fr": ("les gens ici sont {}", "la personne ici est {}"),
    "es": ("las personas aquí son {}", "la persona de al lado es {}"),
}
_LISTS = [(CARRIERS[lang][one], terms) for one, table in enumerate((IDENTITY_TERMS, IDENTITY_SINGULARS)) for lang, terms in table.items()]
_SWAP: dict[str, str] = {}
for _, _terms in _LISTS:
    for _i, _t in enumerate(_terms):
        _SWAP.setdefault(_t, _terms[(_i + 1) % len(_terms)])  # a word of two languages swaps within the first
_LETTERS = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def keys(word: str) -> list[str]:
    """A word and its beginnings (insults inflect)."""
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]


def features(text: str | None, keys_of=keys) -> set[str]:
    """Keys of a text's words, by how often they occur (once, LEVELS times ...)."""
    counts: Counter[str] = Counter()
    for word, n in Counter(_LETTERS.findall(text.lower())).items() if text else ():
        for k in keys_of(word):
            counts[k] += n
    return {k if level == 1 else f"{k}#{level}" for k, n in counts.items() for level in LEVELS if n >= level}


# every key that a swap can change
_SWAP_KEYS = {k if level == 1 else f"{k}#{level}" for t in _SWAP for k in keys(t) for level in LEVELS}


def counterfactuals(text: str | None) -> list[tuple[str, str]]:
    """(term, other term) for every identity term in every sentence of a text."""
    out = []
    for sentence in _SENTENCE.split(text.lower()) if text else ():
        out += [(w, _SWAP[w]) for w in sorted(set(_LETTERS.findall(sentence)) & _SWAP.keys())]
    return out


def mentions(text: str | None) -> list[tuple[list[str], str]]:
    """(words, term) for every identity term of each sentence, and of the whole text if it has more sentences."""
    sentences = [w for w in map(_LETTERS.findall, _SENTENCE.split(text.lower())) if w] if text else []
    parts = [w for w in sentences if _SWAP.keys() & w]
    if len(sentences) > 1 and parts:
        parts.append([x for w in sentences for x in w])
    return [(words, term) for words in parts for term in sorted(_SWAP.keys() & words)]


def carried(text: str | None) -> list[tuple[list[str], str]]:
    """(words, term) for a text that names no group: one of its sentences with a neutral phrase on a term of each
    list, both chosen by a checksum of the text.  None for a text without words or with a mention."""
    sentences = [w for w in map(_LETTERS.findall, _SENTENCE.split(text.lower())) if w] if text else []
    if not sentences or any(_SWAP.keys() & w for w in sentences):
        return []
    at = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    sentence = sentences[at % len(sentences)]
    return [(sentence + phrase.format(terms[at % len(terms)]).split(), terms[at % len(terms)]) for phrase, terms in _LISTS]


def changes(pairs: list[tuple[list[str], str]]) -> Counter[tuple[tuple[str, ...], tuple[str, ...]]]:
    """How often swapping a term in its words loses some keys and gains others: the difference
    of ``features(x)`` and ``features(x')``."""
    out: Counter[tuple[tuple[str, ...], tuple[str, ...]]] = Counter()
    for words, term in pairs:
        near, n = {*keys(term), *keys(_SWAP[term])}, words.count(term)
        before: Counter[str] = Counter(dict.fromkeys(near, 0))
        for word, times in Counter(words).items():
            for k in near.intersection(keys(word)):
                before[k] += times
        after = before.copy()
        for k in keys(term):
            after[k] -= n
        for k in keys(_SWAP[term]):
            after[k] += n
        x, y = ({k if level == 1 else f"{k}#{level}" for k, n in c.items() for level in LEVELS if n >= level} for c in (before, after))
        out[tuple(sorted(x - y)), tuple(sorted(y - x))] += 1
    return out


def swapped(text: str | None) -> Counter[tuple[tuple[str, ...], tuple[str, ...]]]:
    """``changes`` of the swaps of a text's own mentions."""
    return changes(mentions(text))


def _difference(a: Column, n1: int, b: Column, n0: int) -> Column:
    """Signed root of the likelihood ratio of "a of n1 and b of n0" against one common rate
    (standard normal if the word is unrelated to the class)."""
    def loss(k, n, p):
        return F.when((k > 0) & (p > 0), k * F.log(p)).otherwise(0.0) + F.when((k < n) & (p < 1), (F.lit(n) - k) * F.log(1 - p)).otherwise(0.0)

    both = (a + b) / (n1 + n0)
    ratio = loss(a, n1, a / n1) + loss(b, n0, b / n0) - loss(a, n1, both) - loss(b, n0, both)
    return F.signum(a / n1 - b / n0) * F.sqrt(F.greatest(F.lit(0.0), 2 * ratio))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two texts by their fingerprints."""
    either, n = np.unique(np.concatenate([a, b]), return_counts=True)
    if max(len(a), len(b)) >= SKETCH:  # the smallest of the union, a sample of it
        n = n[:SKETCH]
    return float((n == 2).mean()) if len(either) else 0.0


def near_copies(prints: list[list[int]]) -> list[int]:
    """A class for each text, by fingerprints: that of the first text with a similarity of at least NEAR that heads a class
    and has EQUAL of PRINTS minima in common, else its own.  Members needn't be near one another, but no class is a chain."""
    salts = mix64(np.arange(1, PRINTS + 1, dtype=np.uint64))
    sketches = [np.array(p, np.uint64) for p in prints]
    heads: dict[tuple, list[int]] = {}
    same: dict[bytes, int] = {}
    out = []
    for i, a in enumerate(sketches):
        if not len(a):
            out.append(i)
            continue
        exact = a.tobytes()
        if exact not in same:
            least = mix64(a[:, None] ^ salts).min(axis=0).tolist()
            subsets = list(combinations(enumerate(least), EQUAL))
            tried = sorted({h for k in subsets for h in heads.get(k, ())})
            same[exact] = next((h for h in tried if similarity(a, sketches[h]) >= NEAR), i)
            if same[exact] == i:
                for k in subsets:
                    heads.setdefault(k, []).append(i)
        out.append(same[exact])
    return out


def fingerprint(text: str | None) -> list[int]:
    """The SKETCH smallest distinct shingle hashes, in order."""
    return (np.unique(shingles(text))[:SKETCH] >> np.uint64(1)).astype(np.int64).tolist()


def train(rows: list[set[str]], toxic: list[int], chosen: list[str], swaps: list[tuple],
          share: list[float] | None = None, fair: float = FAIR) -> tuple[float, dict[str, float]]:
    """(intercept, weights) of the regularised model over the chosen features and all keys of the
    swaps; a swap is (keys lost, keys gained) or (..., how often); a single key may be a string.  ``share``: the weight of each row (1)."""
    y = np.array(toxic, float)
    part = np.ones(len(y)) if share is None else np.array(share, float)
    n1, n0 = (part * y).sum(), (part * (1 - y)).sum()
    if not n1 or not n0:
        return (math.log(9) if n1 else -math.log(9)), {}
    pairs: Counter[tuple] = Counter()
    for lost, gained, *n in swaps:
        pairs[tuple((s,) if isinstance(s, str) else tuple(s) for s in (lost, gained))] += n[0] if n else 1
    names = sorted({*chosen, *(t for pair in pairs for side in pair for t in side)})
    index = {w: i for i, w in enumerate(names)}
    docs, cols = [], []
    for i, ws in enumerate(rows):
        for w in sorted(ws & index.keys()):
            docs.append(i)
            cols.append(index[w])
    docs, cols = np.array(docs, np.int64), np.array(cols, np.int64)
    changes = [(i, index[t], sign) for i, pair in enumerate(pairs) for side, sign in zip(pair, (1, -1)) for t in side]
    pair_of, key_of, sign_of = np.array(changes, np.int64).reshape(-1, 3).T
    often = np.array(list(pairs.values()), float)
    k = len(names)
    w, b = np.zeros(k), math.log(n1 / n0)
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(docs, w[cols], minlength=len(y)))))
        r = part * (p - y) / part.sum()
        g = np.bincount(cols, r[docs], minlength=k) + 2 * L2 * w
        if len(often):  # a swap changes the score by the weights it loses less those it gains
            d = 2 * fair * np.bincount(pair_of, sign_of * w[key_of], minlength=len(often)) * often / often.sum()
            g += np.bincount(key_of, sign_of * d[pair_of], minlength=k)
        g = np.r_[g, r.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:k], b - move[k]
    return float(b), {x: float(w[i]) for x, i in index.items() if abs(w[i]) > 1e-3}


def fit(docs: DataFrame, labels: DataFrame, fair: float = FAIR) -> tuple[float, dict[str, float]]:
    """Model from (doc_id, text) and (doc_id, toxic) rows."""
    one = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    most = {0: MAX_CLEAN, 1: MAX_TOXIC}
    share = F.when(F.col("toxic") == 1, most[1] / counts.get(1, 1)).otherwise(most[0] / counts.get(0, 1))
    ids = one.filter(hash_share(F.col("doc_id"), "toxicity") < share)  # about 12,000 rows at most
    sample = shared_table(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "toxicity-sample")

    # the texts of a group of near copies and label share one weight
    def prints(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([fingerprint(t) for t in b.column(2).to_pylist()], pa.list_(pa.int64()))],
                                             names=["doc_id", "toxic", "print"])

    def shares(pdf: pd.DataFrame) -> pd.DataFrame:
        # by the fingerprint after the id, so that repeated ids come in a fixed order
        pdf["print"] = pdf["print"].map(tuple)
        pdf = pdf.sort_values(["doc_id", "toxic", "print"], kind="stable")
        pdf["class"] = near_copies(pdf["print"].tolist())
        pdf["share"] = 1 / pdf.groupby(["class", "toxic"])["doc_id"].transform("size")
        return pdf.groupby(["doc_id", "toxic"], as_index=False)["share"].mean()

    weighed = (sample.select("doc_id", "toxic", "text").mapInArrow(prints, "doc_id bigint, toxic int, print array<bigint>")
               .groupBy(F.lit(0).alias("all")).applyInPandas(shares, "doc_id bigint, toxic int, share double"))
    rows = shared_table(sample.join(F.broadcast(weighed), ["doc_id", "toxic"]), "toxicity-rows")
    # sums are rounded, as their last digits depend on the order of the tasks
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.round(F.sum("share"), 6).alias("n")).collect()}

    def featured(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sorted(features(t)) for t in b.column(1).to_pylist()], pa.list_(pa.string())),
                                              b.column(2)], names=["toxic", "features", "share"])

    n1, n0 = size.get(1, 0), size.get(0, 0)
    chosen: list[str] = []
    if n1 and n0:
        tallies = (rows.select("toxic", "text", "share").mapInArrow(featured, "toxic int, features array<string>, share double")
                   .select("toxic", "share", F.explode("features").alias("feature"))
                   .groupBy("feature").agg(F.round(F.sum(F.col("toxic") * F.col("share")), 6).alias("a"), F.round(F.sum("share"), 6).alias("n"))
                   .filter(F.col("n") >= LEAST_SUPPORT))
        tallies = shared_table(tallies, "toxicity-tallies")
        least = math.sqrt(2 * math.log(max(2, tallies.count()))) + Z_MARGIN
        top = (tallies.withColumn("z", _difference(F.col("a"), n1, F.col("n") - F.col("a"), n0)).filter(F.abs("z") >= least)
               .orderBy(F.abs("z").desc(), "feature").limit(MAX_FEATURES).select("feature").collect())
        chosen = [r["feature"] for r in top]
    wanted = {*chosen, *_SWAP_KEYS}
    swap = pa.struct([("lost", pa.list_(pa.string())), ("gained", pa.list_(pa.string())), ("n", pa.float64()), ("own", pa.bool_())])

    def kept(batches):
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            swaps = [[{"lost": lost, "gained": gained, "n": n, "own": own}
                      for own, found in ((True, mentions(t)), (False, carried(t))) for (lost, gained), n in changes(found).items()] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted(wanted & features(t)) for t in texts], pa.list_(pa.string())),
                 pa.array(swaps, pa.list_(swap)), b.column(2)], names=["toxic", "features", "swaps", "share"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [(x, x["n"] * part) for s, part in zip(pdf["swaps"], pdf["share"]) for x in s]
        total = {own: sum(n for x, n in found if x["own"] == own) for own in (True, False)}
        kinds = sum(n > 0 for n in total.values())
        swaps = [(x["lost"], x["gained"], n / total[x["own"]]) for x, n in found]
        b, weights = train([set(x) for x in pdf["features"]], pdf["toxic"].tolist(), chosen, swaps, pdf["share"].tolist(), fair * kinds)
        return pd.DataFrame({"feature": [None, *weights], "weight": [b, *weights.values()]})

    fitted = (rows.select("toxic", "text", "share")
              .mapInArrow(kept, "toxic int, features array<string>, swaps array<struct<lost:array<string>,gained:array<string>,n:double,own:boolean>>, share double")
              .groupBy(F.lit(0).alias("all")).applyInPandas(run, "feature string, weight double").collect())
    weights = {r["feature"]: r["weight"] for r in fitted}
    return weights.pop(None, -math.log(9)), weights


def score(docs: DataFrame, model: tuple[float, dict[str, float]]) -> DataFrame:
    """doc_id, score for (doc_id, text) rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        b0, weights = shared.value
        bases = {f.split("#")[0] for f in weights}

        class Memo(dict):
            def __missing__(self, word):
                if len(self) >= MEMO_ENTRIES:
                    self.clear()
                found = self[word] = [k for k in keys(word) if k in bases]
                return found

        keys_of = Memo().__getitem__
        for b in slices(batches):
            s = [1 / (1 + math.exp(-(b0 + sum(weights[f] for f in sorted(features(t, keys_of) & weights.keys())))))
                 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id bigint, score double")


def swap_gap(docs: DataFrame, model: tuple[float, dict[str, float]]) -> DataFrame:
    """doc_id, pairs, gap for (doc_id, text) rows: how many swaps a text gives (its own mentions, else the neutral phrases) and
    the largest difference of the scores of x and x' (null without a pair)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        b0, weights = shared.value

        def one(words):
            return 1 / (1 + math.exp(-(b0 + sum(weights[f] for f in sorted(features(" ".join(words)) & weights.keys())))))

        for b in slices(batches):
            found = [mentions(t) or carried(t) for t in b.column(1).to_pylist()]
            gaps = [max((abs(one(words) - one([_SWAP[term] if w == term else w for w in words])) for words, term in f), default=None) for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array(gaps, pa.float64())],
                                             names=["doc_id", "pairs", "gap"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, pairs bigint, gap double")


def classify(docs: DataFrame, labels: DataFrame, learn_from: Column, text: str = "text", key: str = "doc_id",
             label: str = "toxic", label_key: str = "doc_id") -> DataFrame:
    """Fit on labels where ``learn_from`` (over doc_id) holds; score every document."""
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    known = labels.select(F.col(f"`{label_key}`").cast("bigint").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("toxic"))
    return score(rows, fit(rows, known.filter(learn_from)))
