"""Language identification by segmentation-marginalised unigrams.

A fixed public sub-word vocabulary gives the pieces; every language gets its own
piece probabilities.  A word's likelihood is the sum over all its segmentations into
pieces (forward algorithm), so no single segmentation is preferred; a text's is the
product over its words.  Probabilities are fitted by expectation-maximisation
(forward-backward over the same lattice) on a bounded sample of labelled texts per
language (``DOCS_PER_LANGUAGE``, chosen by a hash of the id), one task a language.

Scoring is one pass without a shuffle: the model (languages x vocabulary floats) is
broadcast; a worker keeps the scores of words it has met in a bounded memo.

Defined cases: null text or text without a letter is ``und`` with score 0; letters outside the
vocabulary have a floor probability; a word of any length is summed over all segmentations into
pieces of any length (in logarithms, so nothing underflows; words go in batches of bounded size);
ties go to the language first in order; with no
labelled text at all everything is ``und``; an empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import slices

VOCABULARY = "piece_bpe_32k.model"
DOCS_PER_LANGUAGE = 400     # bound of the training sample per language (expected value; hash sample)
ROUNDS = 3                  # EM rounds
SMOOTH = 0.05               # added to each expected count
FLOOR = 1e-7                # probability of a letter that is no piece
BATCH_CELLS = 1_000_000     # words times places summed at once
MEMO_WORDS = 400_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> list[str]:
    """Lower-cased letter runs."""
    return _LETTERS.findall(text.lower()) if text else []


def marked(word: str) -> str:
    """A word with the vocabulary's word start."""
    return "▁" + word


def batches(words: list[str]):
    """Places of words of similar length, at most BATCH_CELLS cells (or one word) at a time."""
    by, lo = sorted(range(len(words)), key=lambda i: len(words[i])), 0
    while lo < len(by):
        hi = lo + 1
        while hi < len(by) and (hi + 1 - lo) * (len(words[by[hi]]) + 2) <= BATCH_CELLS:
            hi += 1
        yield by[lo:hi]
        lo = hi


def _roll(h: np.ndarray, letter: np.ndarray) -> np.ndarray:
    h = (h + letter + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Lattice:
    """The vocabulary; finds all pieces in a list of stretches at once."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.longest = max(map(len, pieces))
        self.size = len(pieces) + 1  # the last stands for any other letter
        self.other = len(pieces)
        # pieces by a hash of their letters; a bitmap answers most of the misses
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        by = np.argsort(keys)
        self.keys, self.ids = keys[by], by
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[keys >> np.uint64(42)] = True

    @staticmethod
    def _hash(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = _roll(h, np.array([ord(c)], np.uint64))
        return h[0]

    def edges(self, words: list[str]) -> np.ndarray:
        """Rows (word, start, end, piece), ordered by end; all substrings of all words at once."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        room = sizes[owner] - start
        at, h, found = np.arange(len(letters)), np.zeros(len(letters), np.uint64), []
        for length in range(1, self.longest + 1):
            inside = room[at] >= length
            if not inside.any():
                break
            at, h = at[inside], _roll(h[inside], letters[at[inside] + length - 1])
            hit = np.flatnonzero(self.bitmap[h >> np.uint64(42)])
            place = np.minimum(np.searchsorted(self.keys, h[hit]), len(self.keys) - 1)
            real = self.keys[place] == h[hit]
            x, piece = at[hit[real]], self.ids[place[real]]
            if length == 1:
                alone = np.full(len(letters), self.other)
                alone[x] = piece
                x, piece = at, alone
            found.append(np.stack([owner[x], start[x], start[x] + length, piece], axis=1))
        e = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
        return e[np.argsort(e[:, 2], kind="stable")]

    def forward(self, words: list[str], logs: np.ndarray, edges: np.ndarray | None = None) -> np.ndarray:
        """log alpha[word, place, model]: the sum over all segmentations up to that place; ``logs``: log probabilities."""
        e = self.edges(words) if edges is None else edges
        width = max(map(len, words), default=0) + 1
        alpha = np.zeros((len(words), width, logs.shape[1]))
        cuts = np.searchsorted(e[:, 2], np.arange(1, width + 1))
        for end in range(1, width):
            x = e[cuts[end - 1]:cuts[end]]
            if len(x):
                self._add(alpha, end, end - 1, x[:, 0], x[:, 1], logs[x[:, 3]])
        return alpha

    @staticmethod
    def _add(table: np.ndarray, to: int, near: int, word: np.ndarray, place: np.ndarray, logs: np.ndarray) -> None:
        """table[word, to] = log of the sum of exp(table[word, place] + logs), relative to the place ``near``."""
        ref = table[:, near]
        total = np.zeros_like(ref)
        np.add.at(total, word, np.exp(table[word, place] - ref[word] + logs))
        met = np.unique(word)
        table[met, to] = ref[met] + np.log(total[met])

    def log_likelihoods(self, words: list[str], probability: np.ndarray) -> np.ndarray:
        """(word, model) log of the sum over all segmentations."""
        out = np.zeros((len(words), probability.shape[1]))
        logs = np.log(probability.astype(np.float64))
        for part in batches(words):
            some = [marked(words[i]) for i in part]
            out[part] = self.forward(some, logs)[np.arange(len(some)), [len(w) for w in some]]
        return out

    def fit(self, counts: Counter, rounds: int = ROUNDS) -> np.ndarray:
        """Piece probabilities by EM over word counts (all segmentations weighted)."""
        words = sorted(counts)
        groups = [([marked(words[i]) for i in part], np.array([counts[words[i]] for i in part], float)) for part in batches(words)]
        lattices = [self.edges(ws) for ws, _ in groups]
        expected = np.zeros(self.size)
        for e, (_, c) in zip(lattices, groups):  # start: how often a piece could be used
            np.add.at(expected, e[:, 3], c[e[:, 0]])
        p = self._normal(expected)
        for _ in range(rounds):
            expected, logs = np.zeros(self.size), np.log(p)[:, None]
            for e, (ws, c) in zip(lattices, groups):
                alpha = self.forward(ws, logs, e)
                beta = np.zeros_like(alpha)
                by = e[np.argsort(-e[:, 1], kind="stable")]
                cuts = np.searchsorted(-by[:, 1], np.arange(-alpha.shape[1] + 1, 2))
                for k, start in enumerate(range(alpha.shape[1] - 1, -1, -1)):
                    x = by[cuts[k]:cuts[k + 1]]
                    if len(x):
                        self._add(beta, start, start + 1, x[:, 0], x[:, 2], logs[x[:, 3]])
                whole = beta[e[:, 0], 0, 0]
                share = np.exp(alpha[e[:, 0], e[:, 1], 0] + logs[e[:, 3], 0] + beta[e[:, 0], e[:, 2], 0] - whole)
                np.add.at(expected, e[:, 3], c[e[:, 0]] * share)
            p = self._normal(expected)
        return p

    def _normal(self, expected: np.ndarray) -> np.ndarray:
        p = (expected + SMOOTH) / (expected.sum() + SMOOTH * self.size)
        p[self.other] = FLOOR
        return p


_lattices: dict[str | None, Lattice] = {}


def lattice(path: str | None = None) -> Lattice:
    if path not in _lattices:
        _lattices[path] = Lattice(path)
    return _lattices[path]


def hash_share(c: Column, salt: str) -> Column:
    """A repeatable number in [0, 1) from a column's value."""
    return F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def fit(labelled: DataFrame, per_language: int = DOCS_PER_LANGUAGE, vocabulary: str | None = None) -> list[tuple[str, np.ndarray]]:
    """[(lang, piece probabilities)] from (doc_id, text, lang) rows, by language."""
    known = labelled.filter("lang is not null and text is not null")
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    sample = known.join(F.broadcast(counts), "lang").filter(
        hash_share(F.col("doc_id"), "language") * F.col("n") < per_language)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = Counter()
        for t in pdf["text"]:
            c.update(words_in(t))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "p": [lattice(vocabulary).fit(c).tolist()]}) if c else pd.DataFrame({"lang": [], "p": []})

    rows = sample.select("lang", "text").groupBy("lang").applyInPandas(run, "lang string, p array<double>").collect()
    return sorted((r["lang"], np.array(r["p"])) for r in rows)


def predict(docs: DataFrame, model: list[tuple[str, np.ndarray]], vocabulary: str | None = None) -> DataFrame:
    """doc_id, lang_pred, score for (doc_id, text) rows."""
    langs = [lang for lang, _ in model]
    p = np.stack([x for _, x in model], axis=1).astype(np.float32) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(p)

    def run(batches):
        probability = shared.value
        memo: dict[str, int] = {}
        scores = np.zeros((0, len(langs)))
        for b in slices(batches):
            texts = [words_in(t) for t in b.column(1).to_pylist()]
            if len(memo) > MEMO_WORDS:
                memo, scores = {}, scores[:0]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            if langs:
                new = list({w for ws in texts for w in ws if w not in memo})
                memo.update(zip(new, range(len(memo), len(memo) + len(new))))
                scores = np.concatenate([scores, lattice(vocabulary).log_likelihoods(new, probability)])
                for i, ws in enumerate(texts):
                    if ws:
                        s = scores[np.fromiter(map(memo.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
                        best = int(np.argmax(s))
                        lang[i] = langs[best]
                        score[i] = float(1.0 / np.exp(s - s[best]).sum())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame, learn_from: Column, text: str = "text", key: str = "doc_id", lang: str = "lang",
             per_language: int = DOCS_PER_LANGUAGE, vocabulary: str | None = None) -> DataFrame:
    """Fit on the rows where ``learn_from`` holds (over the columns doc_id, text, lang) and predict all rows."""
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                       F.col(f"`{lang}`").cast("string").alias("lang"))
    return predict(rows.select("doc_id", "text"), fit(rows.filter(learn_from), per_language, vocabulary), vocabulary)
