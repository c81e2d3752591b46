"""Helpers shared by the training-data operators: shared-folder tables, word and
shingle hashing inside tasks, and the JVM-side text digest."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.session import ensure_checkpoint_dir

SHINGLE_WORDS = 5
MEMO_ENTRIES = 400_000  # words kept in a worker's memo before it is emptied

# Large-text batches: rows handed to Python at once (a text may be megabytes long).
BATCH_ROWS = 512


def ship_package(spark) -> None:
    """Let Python workers import this package from where the driver has it, whatever the working
    folder (on a cluster the package is installed or sent with ``--py-files``; this changes nothing there)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files.  The folder is the one the
    cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/llm"


def plain(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named inputs, under the operator's own names, so that extra or
    clashing columns of the caller can't interfere."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(k) for k, c in columns.items()])


def whole_rows(df: DataFrame) -> DataFrame:
    """The caller's rows as one struct ``row``: whatever its columns are called, they can't clash with an operator's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def row_columns(names: list[str], **replaced: Column) -> list[Column]:
    """The columns of :func:`whole_rows` again, some of them replaced."""
    return [replaced.get(c, F.col("row").getField(c)).alias(c) for c in names]


def text_key(c: str | Column = "text") -> Column:
    """128-bit digest of a text (null: as empty), JVM side."""
    return F.unhex(F.md5(text_or_empty(c).cast("binary")))


class _Memo(dict):
    """word -> 64-bit hash; emptied when full, so a worker's memory is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_memo = _Memo()
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of word characters."""
    return _WORD.findall(text.lower()) if text else []


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_memo.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every window of ``k`` words; a shorter, non-empty text is one shingle."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width, count = (k, n - k + 1) if n >= k else (n, 1)
    out = np.full(count, np.uint64(width))
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + count]
    return mix64(out)


def shingles(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    return shingle_hashes(word_hashes(words_of(text)), k)


def slices(batches: Iterable, rows: int = BATCH_ROWS):
    """Arrow record batches cut to at most ``rows`` rows (bounds Python memory)."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
