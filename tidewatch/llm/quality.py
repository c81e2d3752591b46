"""Quality rules with a suffix-array repetition test.

Every text is split into words (runs of anything but space and U+0009..U+000D).
Within one text a suffix array over words is built by prefix doubling; the longest
common prefix of neighbouring suffixes gives, for every position, the longest
stretch from there that occurs elsewhere in the text too (the LCP intervals'
maximal repeats).  The union of the spans of repeats of at least ``min_repeat``
words and the longest repeat decide:

    kept = not base_failed and covered <= max_covered * n_words and longest <= max_longest

Many texts share one numpy pass: symbols are made distinct per text, so no repeat
crosses two texts.  Work is row-local: no shuffle, memory bounded by a batch.

Defined cases: null and blank texts have no words and are rejected (fewer than
``min_words``); repeated rows give repeated rows; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import slices, word_hashes

MIN_WORDS = 50
MAX_REPEAT_SHARE = 0.5      # base rule: words in repeated 3-word windows
MIN_REPEAT = 8              # shortest repeated stretch that counts as covered
MAX_COVERED = 0.25          # share of words in such stretches
MAX_LONGEST = 100           # longest single repeated stretch, in words
BATCH_WORDS = 400_000       # words per numpy pass (a longer text is a pass of its own)

_WORDS = re.compile(r"[^ \t-\r]+")
_SYMBOLS = "#*$%&|<>"
SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, covered_words bigint, longest_repeat bigint")


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For every position the length of the longest stretch starting there that also
    starts at another position (0: the symbol itself is unique)."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    # rank = start of the symbol's group in sorted order; a group of one is final
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    size = np.diff(np.r_[head, n])
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(head, size)
    levels = [rank]
    active = np.sort(order[np.repeat(size > 1, size)])
    width = 1
    while len(active):
        behind = active + width
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1).astype(np.int64)
        first = rank[active].astype(np.int64)
        by = np.argsort(first * (n + 2) + second + 1, kind="stable")
        a, f, s = active[by], first[by], second[by]
        new_group = np.r_[True, f[1:] != f[:-1]]
        new_run = new_group | np.r_[True, s[1:] != s[:-1]]
        at = np.arange(len(a))
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        run_at = np.maximum.accumulate(np.where(new_run, at, 0))
        rank = rank.copy()
        rank[a] = f + (run_at - group_at)
        runs = np.flatnonzero(new_run)
        size = np.diff(np.r_[runs, len(a)])
        active = np.sort(a[np.repeat(size > 1, size)])
        levels.append(rank)
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    # common prefix of neighbours in suffix order, by descending widths
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n + 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        r = levels[level]
        inside = np.flatnonzero((left < n) & (right < n))
        same = inside[r[left[inside]] == r[right[inside]]]
        step = 1 << level
        left[same] += step
        right[same] += step
        common[1:n][same] += step
    out = np.empty(n, np.int64)
    out[suffixes] = np.maximum(common[:-1], common[1:])
    return out


def covered(lengths: np.ndarray, least: int, within: np.ndarray | None = None) -> np.ndarray:
    """Which positions lie in the union of spans [i, i + lengths[i]) of at least ``least``."""
    n = len(lengths)
    start = np.flatnonzero(lengths >= least)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + lengths[start], -1)
    return np.cumsum(depth[:-1]) > 0


def _measure(texts: list[str | None], min_repeat: int) -> list[list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered, longest; a list per measure."""
    words = [_WORDS.findall(t) if t else [] for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    chars = [sum(map(len, w)) for w in words]
    symbols = [sum(map(t.count, _SYMBOLS)) if t else 0 for t in texts]
    dup = []
    for t in texts:
        lines = [x for x in (t or "").split("\n") if _WORDS.search(x)]
        dup.append(len(lines) - len(set(lines)))
    hashes = word_hashes([w for ws in words for w in ws])
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), n)
    reach = longest_repeats((hashes ^ (owner * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93))
    ends = np.cumsum(n)
    sums = []
    for least in (3, min_repeat):
        total = np.r_[0, np.cumsum(covered(reach, least))]
        sums.append((total[ends] - total[ends - n]).tolist())
    longest = [int(reach[e - k:e].max()) if k else 0 for e, k in zip(ends, n)]
    return [n.tolist(), chars, symbols, dup, *sums, longest]


def _passes(texts: list[str | None]):
    """Ranges of texts of about BATCH_WORDS words (estimated by characters)."""
    start, load = 0, 0
    for i, t in enumerate(texts):
        load += len(t) // 6 if t else 0
        if load >= BATCH_WORDS:
            yield start, i + 1
            start, load = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def repetition_measures(docs: DataFrame, text: str = "text", key: str = "doc_id",
                        min_repeat: int = MIN_REPEAT) -> DataFrame:
    """One row per document with the base counts, covered words and longest repeat."""
    def run(batches):
        for b in slices(batches):
            texts, ids = b.column(1).to_pylist(), b.column(0)
            for lo, hi in _passes(texts):
                cols = _measure(texts[lo:hi], min_repeat)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo)] + [pa.array(c, pa.int64()) for c in cols],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           "n_repeat_words", "covered_words", "longest_repeat"])

    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)


def with_verdict(measures: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEAT_SHARE) * F.col("n_words"))
    repeats = (F.col("covered_words") > max_covered * F.col("n_words")) | (F.col("longest_repeat") > max_longest)
    return measures.withColumn("base_failed", base).withColumn("kept", ~base & ~repeats)


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    return with_verdict(repetition_measures(docs, text, key))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents (all their columns) that the rules keep; decided row by row in one
    pass, so repeated or null ids need no join."""
    names = docs.columns

    def run(batches):
        for b in slices(batches):
            texts = b.column(names.index("text")).to_pylist()
            keep = []
            for lo, hi in _passes(texts):
                n, _, _, _, repeat, cover, longest = _measure(texts[lo:hi], MIN_REPEAT)
                keep += [w >= MIN_WORDS and r <= MAX_REPEAT_SHARE * w and c <= MAX_COVERED * w and m <= MAX_LONGEST
                         for w, r, c, m in zip(n, repeat, cover, longest)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
