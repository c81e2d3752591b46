"""Character n-grams inside word boundaries (``char_wb``) (V1).

Rule: lower-cased word padded with one blank on both sides; every substring of
length n (lo <= n <= hi) that fits in the padded word.  N-grams never cross
words, so counts of a text are the sum over its words.

In bulk (:func:`window_counts`) only the longest n-gram at each place is counted, its *window* of ``hi`` characters or
fewer at a word's end: the n-grams of a place are the prefixes of its window (:func:`explode_prefixes`).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_wb_ngrams(word: str | Column, lo: int = 2, hi: int = 4) -> Column:
    """Array of the word's n-grams (for expressions and tests; the bulk path
    is :func:`window_counts`)."""
    padded = F.concat(F.lit(" "), _col(word), F.lit(" "))
    plen = F.length(padded)

    def grams(n: int) -> Column:
        return F.when(
            plen >= n, F.transform(F.sequence(F.lit(1), plen - n + 1), lambda i: F.substring(padded, i, F.lit(n)))
        ).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[grams(n) for n in range(lo, hi + 1)]))


def explode_ngrams(df: DataFrame, word: str = "word", lo: int = 2, hi: int = 4,
                   keep: list[str] | None = None) -> DataFrame:
    """One row per n-gram occurrence of each word row: ``keep..., term``.

    Positions 1..len-lo+1 of the padded word are exploded once; each position
    yields the n-grams of every length that fits (plain ``substring`` calls,
    no higher-order functions, so the whole step is code-generated).
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != word]
    padded = F.concat(F.lit(" "), F.col(word), F.lit(" "))
    x = df.select(*keep, padded.alias("_p")).withColumn("_l", F.length("_p"))
    x = x.select(*keep, "_p", "_l", F.explode(F.sequence(F.lit(1), F.col("_l") - (lo - 1))).alias("_i"))
    parts = [F.when(F.col("_i") + (n - 1) <= F.col("_l"), F.substring(F.col("_p"), F.col("_i"), F.lit(n)))
             for n in range(lo, hi + 1)]
    return (x.select(*keep, F.explode(F.array(*parts)).alias("term"))
            .filter(F.col("term").isNotNull()))


# ---- fixed values: places sorted at once (in a core's cache), places counted at once, characters of all keys kept back in a task ----
BLOCK = 1 << 16
CHUNK = 1 << 20
KEPT = 1 << 23


def padded_line(text: str) -> str:
    """The padded words of a text, a line each (a line break is whitespace, so no word holds one)."""
    words = " \n ".join(text.split())
    return f" {words} \n" if words else ""


def count_windows(line: str, places: int, lo: int = 2, hi: int = 4) -> tuple[list[str], list[int]]:
    """Distinct windows that start in the first ``places`` characters of padded lines, and their counts."""
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4")
    seen = np.bincount(codes, minlength=11) > 0
    seen[10] = False
    letters = np.flatnonzero(seen)
    bits = int(letters.size).bit_length()
    if bits * hi > 64:  # more different characters than fit in one integer
        windows = (line[i:i + hi].split("\n", 1)[0] for i in range(places))
        counts = Counter(w for w in windows if len(w) >= lo)
        return list(counts), list(counts.values())
    number = np.zeros(seen.size, np.uint64)  # 0: the line's end and all after it
    number[letters] = np.arange(1, letters.size + 1, dtype=np.uint64)
    blocks = []
    for start in range(0, places, BLOCK):
        n = min(BLOCK, places - start)
        ids = np.zeros(n + hi, np.uint64)
        near = number[codes[start:start + n + hi - 1]]
        ids[:near.size] = near
        inside, keys = np.ones(n, np.uint64), np.zeros(n, np.uint64)
        for k in range(hi):
            at = ids[k:k + n] * inside
            inside = (at > 0).astype(np.uint64)
            if k == lo - 1:
                long_enough = at > 0
            keys <<= np.uint64(bits)
            keys |= at
        blocks.append(np.unique(keys[long_enough], return_counts=True))
    parts = np.concatenate([keys for keys, _ in blocks]) if blocks else np.zeros(0, np.uint64)
    keys, places_of = np.unique(parts, return_inverse=True)
    counts = np.zeros(keys.size, np.int64)
    np.add.at(counts, places_of, np.concatenate([n for _, n in blocks]) if blocks else np.zeros(0, np.int64))
    shifts = np.arange(hi - 1, -1, -1, dtype=np.uint64) * np.uint64(bits)
    found = ((keys[:, None] >> shifts) & np.uint64((1 << bits) - 1)).astype(np.int64)
    ends = np.cumsum((found > 0).sum(axis=1)).tolist()
    spelled = letters[found[found > 0] - 1].astype("<u4").tobytes().decode("utf-32-le")
    return [spelled[a:b] for a, b in zip([0, *ends], ends)], counts.tolist()


def window_counts(texts: DataFrame, keys: list[str], text: str = "text", lo: int = 2, hi: int = 4) -> DataFrame:
    """``keys..., window, n``: windows of the lower-cased texts, counted per key over at most ``CHUNK`` places at a time
    (add them up over rows).  A task keeps back at most ``KEPT`` characters and a batch of texts."""
    from tidewatch.session import ship_package

    ship_package(texts.sparkSession)
    x = texts.select(*keys, F.lower(F.make_valid_utf8(F.col(text))).alias("_text")).filter(F.col("_text").isNotNull())
    schema = x.drop("_text").withColumns({"window": F.lit(""), "n": F.lit(1).cast("bigint")}).schema

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, list[str]] = {}
        size: Counter = Counter()
        types: list[pa.DataType] = []

        def emit(key):
            line = "".join(kept.pop(key))
            del size[key]
            for at in range(0, len(line), CHUNK):
                part = line[at:at + CHUNK + hi - 1]
                windows, counts = count_windows(part, min(CHUNK, len(line) - at), lo, hi)
                columns = [pa.repeat(pa.scalar(v, t), len(windows)) for v, t in zip(key, types)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(windows, pa.string()), pa.array(counts, pa.int64())],
                                                 names=[*keys, "window", "n"])

        for batch in batches:
            types = types or [batch.schema.field(k).type for k in keys]
            owners = zip(*[batch.column(i).to_pylist() for i in range(len(keys))])
            for key, value in zip(owners, batch.column(len(keys))):
                line = padded_line(value.as_py())
                if line:
                    kept.setdefault(key, []).append(line)
                    size[key] += len(line)
                    if size[key] >= CHUNK:
                        yield from emit(key)
            if size.total() >= KEPT:
                for key in list(kept):
                    yield from emit(key)
        for key in list(kept):
            yield from emit(key)

    return x.mapInArrow(counted, schema)


def explode_prefixes(df: DataFrame, window: str = "window", lo: int = 2, hi: int = 4, keep: list[str] | None = None) -> DataFrame:
    """One row per n-gram of each window row: ``keep..., term``."""
    parts = [F.when(F.length(window) >= n, F.substring(window, 1, n)) for n in range(lo, hi + 1)]
    keep = [c for c in (keep if keep is not None else df.columns) if c != window]
    return df.select(*keep, F.explode(F.array(*parts)).alias("term")).filter(F.col("term").isNotNull())
