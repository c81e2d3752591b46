"""Best-fit packing by large-item matching.

1. One pass turns every document into token ids (plus an end id), cuts documents longer
   than ``capacity`` into pieces, and numbers the pieces of each length inside its task.
   The narrow piece table (no text) is written to the shared folder.
2. Piece lengths are integers up to ``capacity``, so the whole corpus is described by a
   histogram of at most ``capacity`` rows.  The plan is made on that histogram: pieces
   longer than a third of the capacity are matched greedily, at most two to a sequence
   (the longest open one with the longest other that still fits); the smaller ones go,
   longest first, into the tightest gap, and open a sequence where none fits.  Equal
   bins are handled as one run (a count), so the plan's work and size depend on the
   capacity alone, not on the corpus.
3. A piece's rank among its length (task offset + number inside the task) finds its run,
   and so its sequence and place.  No shuffle of pieces is needed for that.

Defined cases: null text is packed as an empty document (only the end id); repeated rows are
separate pieces; ties in length are broken by input order; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import shared_table, slices
from tidewatch.llm.tokenize import coder

CAPACITY = 4096
END_ID = 1
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
           text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per piece: place in its document, crc32 of its ids, the task (``part``)
    and its number among the task's pieces of that length (``nth``)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, part, seen = coder(tokenizer).encode, TaskContext.get().partitionId(), defaultdict(int)
        for b in slices(batches):
            rows = []
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode(t or "") + end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    n = len(cut) // 4
                    rows.append((doc_id, i, at // 4, n, zlib.crc32(cut), part, seen[n], cut)[:8 if with_ids else 7])
                    seen[n] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return narrow.mapInArrow(run, schema)


class _Gaps:
    """Open bins by remaining gap: gap -> runs of (first bin, count)."""

    def __init__(self):
        self.runs: dict[int, deque] = defaultdict(deque)
        self.sizes: list[int] = []

    def add(self, gap: int, first: int, count: int) -> None:
        if count <= 0 or gap <= 0:
            return
        if not self.runs[gap]:
            bisect.insort(self.sizes, gap)
        runs = self.runs[gap]
        if runs and runs[-1][0] + runs[-1][1] == first:
            runs[-1][1] += count
        else:
            runs.append([first, count])

    def tightest(self, least: int) -> int | None:
        i = bisect.bisect_left(self.sizes, least)
        return self.sizes[i] if i < len(self.sizes) else None

    def take(self, gap: int, most: int) -> tuple[int, int]:
        runs = self.runs[gap]
        first, count = runs[0]
        n = min(most, count)
        if n == count:
            runs.popleft()
            if not runs:
                self.sizes.remove(gap)
        else:
            runs[0] = [first + n, count - n]
        return first, n


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first bin, offset): the pieces of that length
    with ranks first .. first+count-1 go to consecutive bins at that offset."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    out, gaps, bins = [], _Gaps(), 0

    def place(length, count, first_bin, offset):
        out.append((length, used[length], count, first_bin, offset))
        used[length] += count
        left[length] -= count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    ascending = large[::-1]
    for n in large:
        while left[n] > 0:
            # the longest other large piece that fits beside n
            i = bisect.bisect_right(ascending, capacity - n) - 1
            while i >= 0 and left[ascending[i]] < (2 if ascending[i] == n else 1):
                i -= 1
            if i < 0:
                count = left[n]
                place(n, count, bins, 0)
                gaps.add(capacity - n, bins, count)
            else:
                mate = ascending[i]
                count = left[n] // 2 if mate == n else min(left[n], left[mate])
                place(n, count, bins, 0)
                place(mate, count, bins, n)
                gaps.add(capacity - n - mate, bins, count)
            bins += count
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n] > 0:
            gap = gaps.tightest(n)
            if gap is None:
                each = capacity // n
                whole, rest = divmod(left[n], each)
                for count, copies in ((whole, each), (1 if rest else 0, rest)):
                    if count:
                        for k in range(copies):
                            place(n, count, bins, k * n)
                        gaps.add(capacity - copies * n, bins, count)
                        bins += count
                continue
            each = gap // n
            if left[n] < each:
                first, count, copies = *gaps.take(gap, 1), left[n]
            else:
                first, count = gaps.take(gap, left[n] // each)
                copies = each
            for k in range(copies):
                place(n, count, first, capacity - gap + k * n)
            gaps.add(gap - copies * n, first, count)
    return out


def assign(numbered: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece of a materialised :func:`pieces` table."""
    spark = numbered.sparkSession
    per_task = numbered.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shared_table(per_task.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-offsets")
    # at most ``capacity`` rows, whatever the corpus
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(plan(histogram, capacity))
    table = np.array(runs, np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    columns = [c for c in numbered.columns if c not in ("part", "nth")]

    def run(batches):
        t = shared.value
        wide = int(t[:, 1].max()) + int(t[:, 2].max()) + 1 if len(t) else 1
        if len(t) and (int(t[:, 0].max()) + 1) * wide >= 2**63:
            raise OverflowError("too many pieces of one length for exact places")
        keys = t[:, 0] * wide + t[:, 1]
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * wide + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in columns]
                + [pa.array(t[at, 3] + rank - t[at, 1], pa.int64()), pa.array(t[at, 4], pa.int64())],
                names=columns + ["sequence_id", "offset"])

    ranked = (numbered.join(offsets.select("length", "part", "first").hint("merge"), ["length", "part"])
              .select(*columns, (F.col("first") + F.col("nth")).alias("rank")))
    fields = ", ".join(f"{c} {dict(numbered.dtypes)[c]}" for c in columns)
    return ranked.mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
         text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return assign(shared_table(pieces(docs, capacity, end_id, tokenizer, text, key, with_ids), "pack-pieces"), capacity)
