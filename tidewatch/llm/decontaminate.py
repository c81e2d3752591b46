"""Benchmark decontamination: size-partitioned MinHash containment search.

Short benchmark items are looked for inside (possibly very long) documents.  A plain
MinHash of a long document says nothing about a short passage in it, so documents are
partitioned by size and every partition gets a sketch that grows with its size (the
ensemble idea: a containment threshold t for an item of q shingles against a document
of at most u becomes the Jaccard threshold t*q / (u + q - t*q), and the number of
minima must grow as u to keep the recall).  The sketch is one-permutation MinHash: the
hash space is cut into ``bins(u) = u / SHINGLES_PER_BIN`` equal ranges, and each range
keeps its smallest shingle hash.  An item is a candidate if one of its own shingles is
the minimum of its range in the document.

With d document shingles a bin (at most SHINGLES_PER_BIN = 2), a contained shingle is its
bin's minimum with probability (1 - exp(-d)) / d >= 0.43, so an item with m contained
shingles is missed with probability 0.57^m at most (5e-7 for the least m that counts, 26); an item of fewer than
``EXACT_BELOW`` shingles is compared with all shingles of a document instead, which has
no miss at all.  Only candidates are verified, by exact containment of their shingle sets:
|S(item) & S(doc)| / |S(item)| >= threshold.

An item of fewer than five words is one shingle of its own width, and documents are searched for it in
windows of that width, so short items are found inside long documents.

Items are the stated query set; they go out in blocks of at most ``BLOCK_SHINGLES``
shingle hashes (8 bytes each), so what is broadcast has a fixed bound and a larger
benchmark costs more passes, not more memory.

Defined cases: null or blank texts (item or document) have no shingles and never match;
a document shorter than an item's width can't contain it; items whose containment ties with the threshold count;
repeated documents give repeated rows, repeated items (same id and text) count once; an item with null id keeps its null id; empty tables
give an empty result; only the named columns are read, all others pass :func:`drop_contaminated` as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import SHINGLE_WORDS, shingle_hashes, slices, word_hashes, words_of

THRESHOLD = 0.8
SHINGLES_PER_BIN = 2
EXACT_BELOW = 32
BLOCK_SHINGLES = 1_000_000

MATCH_SCHEMA = "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint, containment double"


class ItemBlock:
    """Shingles of a block of items, sorted by hash, with the owners of each; ``widths``: those below five words."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], widths: set[int] = frozenset()):
        self.widths, self.items = sorted(widths), [s for _, s in items]
        self.ids = [i for i, _ in items]
        self.sizes = np.array([len(s) for _, s in items], np.int64)
        hashes = np.concatenate([s for _, s in items]) if items else np.empty(0, np.uint64)
        owners = np.repeat(np.arange(len(items)), self.sizes)
        by = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[by], owners[by]
        short = (self.sizes < EXACT_BELOW)[self.owners]
        self.short_hashes = np.unique(self.hashes[short])

    def _owners_of(self, found: np.ndarray) -> np.ndarray:
        lo = np.searchsorted(self.hashes, found, "left")
        hi = np.searchsorted(self.hashes, found, "right")
        n = hi - lo
        if not n.sum():
            return np.empty(0, np.int64)
        at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return self.owners[at]

    def _present(self, sorted_hashes: np.ndarray, among: np.ndarray) -> np.ndarray:
        if not len(among) or not len(sorted_hashes):
            return np.empty(0, np.uint64)
        at = np.searchsorted(among, sorted_hashes)
        at[at == len(among)] = 0
        return sorted_hashes[among[at] == sorted_hashes]

    def candidates(self, doc: np.ndarray, narrow: np.ndarray) -> np.ndarray:
        """Positions of the items that the sketch of a document finds, and of short items with a shingle in it.

        ``doc``: sorted distinct shingles; ``narrow``: windows of the short widths."""
        if not len(self.hashes):
            return np.empty(0, np.int64)
        minima = doc[_bin_heads(doc)] if len(doc) else doc
        found = [self._present(minima, self.hashes), self._present(doc, self.short_hashes), self._present(narrow, self.short_hashes)]
        return np.unique(np.concatenate([self._owners_of(f) for f in found]))

    def matches(self, text: str | None, threshold: float):
        """(item position, shared) of the items contained in a text."""
        words = word_hashes(words_of(text))
        doc = np.unique(shingle_hashes(words))
        narrow = np.unique(np.concatenate([np.empty(0, np.uint64), *(shingle_hashes(words, w) for w in self.widths if w < len(words))]))
        found = []
        for i in self.candidates(doc, narrow).tolist():
            item = self.items[i]
            shared = len(self._present(item, doc)) or len(self._present(item, narrow))
            if shared >= threshold * len(item) - 1e-9:
                found.append((i, shared))
        return found


def size_partition(n: int) -> int:
    """Partition of a document of ``n`` distinct shingles: its size rounded up to a power of two."""
    return 1 << max(0, int(n - 1).bit_length())


def _bin_heads(doc: np.ndarray) -> np.ndarray:
    """Positions of the smallest hash in each bin, for sorted hashes."""
    bins = max(1, size_partition(len(doc)) // SHINGLES_PER_BIN)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    of = doc >> shift if bins > 1 else np.zeros(len(doc), np.uint64)
    return np.flatnonzero(np.r_[True, of[1:] != of[:-1]])


def _blocks(items: DataFrame, text: str, key: str):
    """Item blocks of at most BLOCK_SHINGLES shingles (a larger item is its own block);
    the rows stream to the driver, which holds one block at a time."""
    rows = items.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").cast("string").alias("t")).distinct()
    block, load, widths = [], 0, set()
    for r in rows.toLocalIterator():
        words = words_of(r["t"])
        s = np.unique(shingle_hashes(word_hashes(words)))
        if not len(s):
            continue
        if block and load + len(s) > BLOCK_SHINGLES:
            yield ItemBlock(block, widths)
            block, load, widths = [], 0, set()
        block.append((r["k"], s))
        load += len(s)
        if len(words) < SHINGLE_WORDS:
            widths.add(len(words))
    if block:
        yield ItemBlock(block, widths)


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, *, text: str = "text",
                    key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per (document row, item) with containment of at least ``threshold``."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = None
    for block in _blocks(items, item_text, item_key):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for b in slices(batches):
                found = shared.value
                rows = []
                for doc_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for i, n in found.matches(t, threshold):
                        q = int(found.sizes[i])
                        rows.append((doc_id, found.ids[i], n, q, n / q))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 4 + [pa.float64()])],
                        names=["doc_id", "item_id", "n_shared", "n_item", "containment"])

        part = narrow.mapInArrow(run, MATCH_SCHEMA)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], MATCH_SCHEMA) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all their columns) that contain no item; one pass per item block,
    decided row by row, so no join back is needed."""
    spark, names = docs.sparkSession, docs.columns
    out = docs
    for block in _blocks(items, "text", "item_id"):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for b in slices(batches):
                found = shared.value
                keep = [not found.matches(t, threshold) for t in b.column(names.index("text")).to_pylist()]
                yield b.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
