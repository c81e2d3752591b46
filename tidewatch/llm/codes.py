"""Vector code compression: product codes trained and assigned by exact integer arithmetic.

Components become integers, floor(scale * x); a vector is cut into ``parts`` equal consecutive
parts, each with a codebook of at most ``entries`` integer entries.  A round assigns every part
to its nearest entry and moves the entries to the floored means of their parts.

Limb-split exact GEMM: squared distances are |x|^2 - 2 x.c + |c|^2, and the dot products of a
batch are one matrix product.  float64 products are exact only below 2^53, so integers are split
into limbs of ``limb_bits(d)`` bits (d products of two limbs then stay below 2^53), every pair of
limbs is one BLAS product, and the products are shifted and added in int64.  The first minimum
of a row is the code, so ties go to the lower index.  No float is ever rounded: the result
depends neither on the batches nor on the number of tasks.

Each pass reads the vectors once, without a shuffle: a task adds up its parts by entry and hands
out at most parts * entries rows, which Spark sums (decimals).  Only the codebooks, of a fixed
size, are on the driver and go out with the tasks.

Defined cases: a vector that is null or holds null or non-finite components is dropped; vectors of
another length than the first, or not of a multiple of ``parts``, are an error, as are components so
large that a squared distance might not fit a long (``largest_component``).  Repeated rows each
get their row and their weight.  The first entries are the smallest ids, nulls last, equal ids by
their vectors; with fewer rows than ``entries`` there are as many entries as rows.  Null labels are
one label.  An empty table gives no rows.  Only the three named columns are read, so other
columns, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import plain, shared_table

PARTS = 16
ENTRIES = 64
SCALE = 256
ROUNDS = 2
BATCH = 4096  # vectors in one matrix product


class Shape(NamedTuple):
    parts: int = PARTS
    entries: int = ENTRIES
    scale: int = SCALE


def limb_bits(terms: int) -> int:
    """Bits of a limb: ``terms`` products of two limbs add up to at most 2^53."""
    return (53 - max(0, terms - 1).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 limbs, lowest first, with sum(limb[i] << (bits * i)) = x; each keeps x's sign."""
    sign, rest = np.sign(x), np.abs(x)
    out = []
    while True:
        out.append((sign * (rest & ((1 << bits) - 1))).astype(np.float64))
        rest = rest >> bits
        if not rest.any():
            return out


def exact_dots(x: np.ndarray, c: np.ndarray, bits: int | None = None) -> np.ndarray:
    """x @ c.T for int64 matrices whose true products fit int64."""
    bits = bits or limb_bits(x.shape[1])
    out = np.zeros((len(x), len(c)), np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def largest_component(width: int) -> int:
    """Largest |component| for which a squared distance of ``width`` components fits a long."""
    return math.isqrt((2 ** 63 - 1) // max(1, width)) // 2


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first nearest entry, squared distance) of each row."""
    d = (x * x).sum(1)[:, None] - 2 * exact_dots(x, book) + (book * book).sum(1)[None, :]
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code]


def _integers(column: pa.Array, shape: Shape, width: int | None) -> np.ndarray:
    """[rows, parts, width of a part] int64 of a list column without nulls."""
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes[0]) if width is None else width
    if (sizes != width).any() or width % shape.parts:
        raise ValueError(f"vectors must all have the same length, a multiple of {shape.parts}")
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * shape.scale)
    if len(x) and np.abs(x).max() > largest_component(width):
        raise ArithmeticError(f"a component beyond {largest_component(width) // shape.scale} can't be coded exactly")
    return x.astype(np.int64).reshape(len(sizes), shape.parts, width // shape.parts)


def _slices(batches, at: int):
    for b in batches:
        for i in range(0, b.num_rows, BATCH):
            piece = b.slice(i, BATCH)
            yield piece, piece.column(at)


def kept_vectors(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, v) of the rows whose vector has only finite components."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.col(f"`{vector}`").cast("array<double>")
    return plain(vectors, vec_id=F.col(f"`{key}`").cast("bigint"), label=label, v=v).filter(F.col("v").isNotNull() & ~bad)


def first_books(kept: DataFrame, shape: Shape) -> np.ndarray:
    """[parts, entries, width] of the vectors with the smallest ids (at most ``entries`` rows come to the driver)."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(shape.entries).select("v").collect()
    if not rows:
        return np.zeros((shape.parts, 0, 0), np.int64)
    x = _integers(pa.array([r["v"] for r in rows], pa.list_(pa.float64())), shape, None)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def improved(kept: DataFrame, books: np.ndarray, shape: Shape) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to the floored mean of its parts."""
    parts, entries, width = books.shape

    def tally(batches):
        n = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for _, column in _slices(batches, 0):
            x = _integers(column, shape, parts * width)
            for p in range(parts):
                code, _ = nearest(x[:, p], books[p])
                n[p] += np.bincount(code, minlength=entries)
                np.add.at(sums[p], code, x[:, p])
        p, e = np.nonzero(n)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]),
                 pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "s"])

    whole = "decimal(38,0)"
    tallied = kept.select("v").mapInArrow(tally, "part int, entry int, n bigint, s array<bigint>")
    rows = tallied.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i].cast(whole)) for i in range(width)]).alias("s")).collect()
    out = books.copy()
    for r in rows:
        out[r["part"], r["entry"]] = [int(s) // r["n"] for s in r["s"]]
    return out


def train(kept: DataFrame, shape: Shape = Shape(), rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` rounds over all kept vectors: int64 [parts, entries, width of a part]."""
    books = first_books(kept, shape)
    for _ in range(rounds if books.size else 0):
        books = improved(kept, books, shape)
    return books


def encode(kept: DataFrame, books: np.ndarray, shape: Shape = Shape()) -> DataFrame:
    """(vec_id, label, codes binary: one byte a part, error): the parts' nearest entries and the squared
    distance of the whole vector.  No shuffle."""
    parts, entries, width = books.shape
    if entries > 256:
        raise ValueError("a code is one byte: at most 256 entries")

    def run(batches):
        for b, column in _slices(batches, 2):
            x = _integers(column, shape, parts * width)
            found = [nearest(x[:, p], books[p]) for p in range(parts)]
            codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(sum(d for _, d in found))],
                names=["vec_id", "label", "codes", "error"])

    fields = f"vec_id bigint, label {kept.schema['label'].dataType.simpleString()}, codes binary, error bigint"
    return kept.select("vec_id", "label", "v").mapInArrow(run, fields)


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, shape: Shape = Shape(), rounds: int = ROUNDS, *, key: str = "vec_id",
             vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per kept vector: vec_id, code (hex, two digits a part), error, label_error (the errors of
    all vectors with the same label), codebooks_sha256.

    The coded rows and the labels' sums are written, so that Spark joins them by their measured sizes
    (few labels: broadcast; many: by shuffle, where AQE splits a hot label)."""
    kept = kept_vectors(vectors, key, vector, label)
    books = train(kept, shape, rounds)
    coded = shared_table(encode(kept, books, shape), "codes")
    sums = shared_table(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "codes-labels")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                    F.lit(book_digest(books)).alias("codebooks_sha256")))
