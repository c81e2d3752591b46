"""Language-model scoring with a log-frequency Bloom filter.

Words are runs of non-space characters (A-Z lower-cased), with an end token after each text; the end token is
also what comes before a text's first word.  Unigram and bigram counts c of the training texts are quantised
to levels, ``level = floor(log2 c) + 1``, and the filter holds the pairs (n-gram, 1) to (n-gram, level).
A look-up probes (n-gram, 1), (n-gram, 2), ... until one is missing; the level before stands for the middle
of its range of counts.  A Bloom filter has no false negatives, so a level is never too low; it is
one too high with probability ``2^-HASHES`` about, and a bigram's level is cut to those of its two words.  Smoothing:

    p1(w)   = (q(w) + 1) / (N + V + 1)
    p(w|h)  = (q(h, w) + MU * p1(w)) / (q(h) + MU)

How it runs.  One pass over the texts writes blocks of about ``BLOCK_TOKENS`` tokens: documents as numbers
into the block's list of distinct token hashes.  The distinct n-grams of a block and their counts go, packed, to
segments by ranges of their hash; a segment adds up its counts and becomes that segment of the filter (in
proportion to what it holds, so the filter grows with the corpus), and answers each block's
tokens by their exact counts, which the add-one base score needs.  A popular n-gram is one entry a block, whatever its
count.  The number of segments grows with the corpus; a segment is about ``SEGMENT_TOKENS`` tokens' share.

The filter is broadcast to the workers if its measured size is at most ``BROADCAST_BYTES``.  Beyond, nothing is
dropped and nothing large is sent to everyone: the blocks' distinct n-grams go to the segments and their levels come
back, by shuffle.  Both ways probe the same bits and give the same scores.

Defined cases: a null or blank text is the end token alone; a text without training rows, or no training text at all
(N = V = 0), is scored by the same formulas; rows whose ``train`` is null don't train; repeated rows count as often as they
occur and each get their row; an empty table gives no rows.  A text must fit a row; a long one is a block of its own.
Tokens are told apart by 64-bit hashes.  Only the named columns are read, so other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import mix64, shared_table

BLOCK_TOKENS = 1_000_000
SEGMENT_TOKENS = 2_000_000
BROADCAST_BYTES = 128 << 20
HASHES = 7
BITS_PER_PAIR = 10.1  # HASHES / ln 2: half of the bits are set
MU = 8.0
END = b"\n"  # no word holds white space
TOP_LEVEL = 62


def pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


# ---------------------------------------------------------------- filter

def levels_of_counts(counts: np.ndarray) -> np.ndarray:
    """floor(log2 c) + 1, exact for integers below 2^53; 0 for 0."""
    return np.frexp(counts.astype(np.float64))[1] * (counts > 0)


def middle(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level: [2^(l-1), 2^l - 1]."""
    return np.where(levels > 0, (3.0 * np.exp2(levels - 1.0) - 1) / 2, 0.0)


def _places(hashes: np.ndarray, level: int, bits: np.ndarray | int, i: int, mixed: np.ndarray | None = None):
    """Place of the i-th bit of (n-gram, level) in a segment of ``bits`` bits."""
    g = mix64(hashes + np.uint64(level * 0x9E3779B97F4A7C15 % 2 ** 64)) if mixed is None else mixed
    low, high = g & np.uint64(0xFFFFFFFF), (g >> np.uint64(32)) | np.uint64(1)
    return g, (low + np.uint64(i) * high) % np.uint64(bits) if np.isscalar(bits) else (low + np.uint64(i) * high) % bits


def segment_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Filter segment (a byte holds 8 bits) of distinct n-grams with counts > 0."""
    levels = levels_of_counts(counts)
    m = max(64, -(-int(levels.sum() * BITS_PER_PAIR) // 64) * 64)
    bits = np.zeros(m, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        of, mixed = hashes[levels >= level], None
        for i in range(HASHES):
            mixed, at = _places(of, level, m, i, mixed)
            bits[at] = 1
    return np.packbits(bits, bitorder="little")


class LogFilter:
    """A filter of one or more segments; ``segments`` is their number in the whole filter."""

    def __init__(self, parts: list[tuple[int, bytes]], segments: int):
        self.segments = segments
        self.sizes, self.starts = np.ones(segments, np.uint64), np.zeros(segments, np.uint64)
        at = 0
        for s, b in parts:
            self.sizes[s], self.starts[s] = len(b) * 8, at * 8
            at += len(b)
        self.bytes = np.frombuffer(b"".join(b for _, b in parts) or b"\0", np.uint8)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Level of each n-gram: the first missing level less one."""
        found = np.zeros(len(hashes), np.int64)
        here = segment_of(hashes, self.segments)
        alive, h, size, start = np.arange(len(hashes)), hashes, self.sizes[here], self.starts[here]
        for level in range(1, TOP_LEVEL + 1):
            mixed = None
            for i in range(HASHES):
                mixed, at = _places(h, level, size, i, mixed)
                at += start
                hit = (self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if not hit.all():
                    alive, h, size, start, mixed = alive[hit], h[hit], size[hit], start[hit], mixed[hit]
            if not len(alive):
                break
            found[alive] = level
        return found


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Equal ranges of the hash space, so that sorted hashes are sorted by segment."""
    return ((hashes >> np.uint64(40)) * np.uint64(segments) >> np.uint64(24)).astype(np.int64)


def _by_segment(hashes: np.ndarray, segments: int):
    """(segment, first, end) of the ranges of sorted hashes."""
    of = segment_of(hashes, segments)
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(of)]):
        yield int(of[lo]), lo, hi


# ---------------------------------------------------------------- blocks of documents

class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class Block(NamedTuple):
    """Documents as numbers (``ids``) into ``vocab`` (64-bit hashes); each document's last token is the end token, number 0."""

    ids: np.ndarray
    vocab: np.ndarray
    lengths: np.ndarray
    train: np.ndarray

    def bigrams(self) -> np.ndarray:
        """Hash of (the token before, the token) at every place."""
        h = self.vocab[self.ids]
        before = np.r_[self.vocab[:1], h[:-1]]  # a document's first word comes after an end token
        return mix64(before * np.uint64(0xD1342543DE82EF95) + h)

    def trained(self) -> np.ndarray:
        return np.repeat(self.train, self.lengths)


BLOCK_FIELDS = ("block bigint, doc_ids array<bigint>, train array<boolean>, lengths array<int>, ids binary, vocab binary, "
                "train_tokens bigint, n_tokens bigint")


def _blocks(batches):
    """Rows of BLOCK_FIELDS from (doc_id, train, text as bytes)."""
    task, made = TaskContext.get().partitionId(), 0
    keys, train, lengths, parts, numbers, n = [], [], [], [], _Numbers({END: 0}), 0

    def row():
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        values = [task << 32 | made, keys, train, lengths, pack(np.concatenate(parts)), hashes.tobytes(),
                  sum(k for k, t in zip(lengths, train) if t), n]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)

    for b in batches:
        for key, learn, text in zip(*(c.to_pylist() for c in b.columns)):
            words = text.lower().split()
            words.append(END)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            keys.append(key)
            train.append(learn)
            lengths.append(len(words))
            n += len(words)
            if n >= BLOCK_TOKENS:
                yield row()
                made += 1
                keys, train, lengths, parts, numbers, n = [], [], [], [], _Numbers({END: 0}), 0
    if n:
        yield row()


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
                          ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()), ("vocab", pa.binary()),
                          ("train_tokens", pa.int64()), ("n_tokens", pa.int64())])


def _block(r: dict) -> Block:
    return Block(unpack(r["ids"], np.uint32), np.frombuffer(r["vocab"], np.uint64), np.array(r["lengths"], np.int64),
                 np.array(r["train"], bool))


def _rows(batches):
    """One row at a time: a block is megabytes."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def corpus_blocks(docs: DataFrame, train: Column, text: str, key: str) -> DataFrame:
    given = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"))
    return shared_table(given.mapInArrow(_blocks, BLOCK_FIELDS), "lm-blocks")


# ---------------------------------------------------------------- counts and filter segments

GRAM_SCHEMA = pa.schema([("segment", pa.int32()), ("block", pa.int64()), ("tokens", pa.binary()), ("token_counts", pa.binary()),
                         ("grams", pa.binary()), ("gram_counts", pa.binary())])
GRAM_FIELDS = "segment int, block bigint, tokens binary, token_counts binary, grams binary, gram_counts binary"
SEGMENT_SCHEMA = pa.schema([("segment", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()), ("known", pa.int64())])
SEGMENT_FIELDS = "segment int, block bigint, payload binary, known bigint"


def _grams(segments: int):
    def run(batches):
        for r in _rows(batches):
            block = _block(r)
            learn = block.trained()
            counts = np.bincount(block.ids[learn], minlength=len(block.vocab))
            by = np.argsort(block.vocab)
            tokens, token_counts = block.vocab[by], counts[by]
            grams, gram_counts = np.unique(block.bigrams()[learn], return_counts=True)
            share = {s: (lo, hi) for s, lo, hi in _by_segment(grams, segments)}
            for s, (lo, hi) in {s: (lo, hi) for s, lo, hi in _by_segment(tokens, segments)}.items():
                a, z = share.pop(s, (0, 0))
                yield _gram_row(s, r["block"], tokens[lo:hi], token_counts[lo:hi], grams[a:z], gram_counts[a:z])
            for s, (a, z) in share.items():
                yield _gram_row(s, r["block"], tokens[:0], token_counts[:0], grams[a:z], gram_counts[a:z])

    return run


def _gram_row(segment, block, tokens, token_counts, grams, gram_counts):
    values = [segment, block, tokens.tobytes(), pack(token_counts.astype(np.uint32)), grams.tobytes(), pack(gram_counts.astype(np.uint32))]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, GRAM_SCHEMA)], schema=GRAM_SCHEMA)


def _added(hashes: list[np.ndarray], counts: list[np.ndarray]):
    """(distinct hashes, total counts, place of each given hash)."""
    of, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(len(of), np.int64)
    np.add.at(total, inverse, np.concatenate(counts).astype(np.int64))
    return of, total, inverse


def _segment(table: pa.Table) -> pa.Table:
    """One segment: a row with its part of the filter (no block; ``known``: its distinct trained tokens), and for every
    block the exact counts of the block's tokens, in the order of their hashes."""
    rows = table.to_pylist()
    hashes = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
    tokens, totals, at = _added(hashes, [unpack(r["token_counts"], np.uint32) for r in rows])
    grams, gram_totals, _ = _added([np.frombuffer(r["grams"], np.uint64) for r in rows],
                                   [unpack(r["gram_counts"], np.uint32) for r in rows])
    known = totals > 0
    bits = segment_bits(np.r_[tokens[known], grams], np.r_[totals[known], gram_totals])
    segment, found = rows[0]["segment"], totals[at]
    ends = np.cumsum([len(h) for h in hashes])
    answers = [pack(found[e - len(h):e]) for e, h in zip(ends, hashes)]
    return pa.Table.from_arrays([pa.array([segment] * (len(rows) + 1), pa.int32()), pa.array([None, *(r["block"] for r in rows)], pa.int64()),
                                 pa.array([bits.tobytes(), *answers], pa.binary()),
                                 pa.array([int(known.sum()), *[0] * len(rows)], pa.int64())], schema=SEGMENT_SCHEMA)


# ---------------------------------------------------------------- scoring

def _keys(block: Block):
    """(distinct n-grams of the block sorted, place of each vocabulary entry, place of each bigram) ."""
    keys, at = np.unique(np.r_[block.vocab, block.bigrams()], return_inverse=True)
    return keys, at[:len(block.vocab)], at[len(block.vocab):]


def score_block(block: Block, token_counts: np.ndarray, keys_levels, n: int, v: int):
    """Per document: n_tokens, n_known, base score, score.  ``token_counts``: exact counts by vocabulary number;
    ``keys_levels``: (places of vocabulary entries, places of bigrams, levels)."""
    tokens_at, grams_at, levels = keys_levels
    counts = token_counts[block.ids]
    base = np.log10((token_counts + 1) / (n + v + 1))[block.ids]
    single = levels[tokens_at]
    before = np.r_[np.zeros(1, block.ids.dtype), block.ids[:-1]]
    both = np.minimum(levels[grams_at], np.minimum(single[before], single[block.ids]))
    of = middle(single)
    p1 = (of + 1) / (n + v + 1)
    logs = np.log10((middle(both) + MU * p1[block.ids]) / (of[before] + MU))
    out, lo = [], 0
    base, logs = base.tolist(), logs.tolist()
    known = np.r_[0, np.cumsum(counts > 0)]
    for length in block.lengths.tolist():
        hi = lo + length
        out.append((length, int(known[hi] - known[lo]), math.fsum(base[lo:hi]), math.fsum(logs[lo:hi])))
        lo = hi
    return out


SCORE_FIELDS = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _pieces(parts, kind) -> np.ndarray:
    """Answers of a block's segments, in order."""
    return np.concatenate([unpack(p["payload"], kind) for p in sorted(parts, key=lambda p: p["segment"])])


def _scores(n: int, v: int, shared):
    names = [f.split()[0] for f in SCORE_FIELDS.split(", ")]

    def run(batches):
        for r in _rows(batches):
            block = _block(r)
            counts = np.empty(len(block.vocab), np.int64)
            counts[np.argsort(block.vocab)] = _pieces(r["counts"], np.int64)
            keys, tokens_at, grams_at = _keys(block)
            levels = shared.value.levels(keys) if shared is not None else _pieces(r["levels"], np.uint8).astype(np.int64)
            rows = score_block(block, counts, (tokens_at, grams_at, levels), n, v)
            columns = [r["doc_ids"], r["train"], *(list(c) for c in zip(*rows))]
            columns.insert(4, [n] * len(rows))
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


PROBE_SCHEMA = pa.schema([("segment", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
PROBE_FIELDS = "segment int, block bigint, payload binary"


def _probes(segments: int):
    """A block's distinct n-grams by segment."""

    def run(batches):
        for r in _rows(batches):
            keys, _, _ = _keys(_block(r))
            for s, lo, hi in _by_segment(keys, segments):
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([s, r["block"], keys[lo:hi].tobytes()], PROBE_SCHEMA)],
                                                 schema=PROBE_SCHEMA)

    return run


def _answered(segments: int):
    """Levels of the probes of one segment, by its part of the filter."""

    def run(probes: pa.Table, bits: pa.Table) -> pa.Table:
        part = LogFilter([(r["segment"], r["payload"]) for r in bits.to_pylist()], segments)
        rows = probes.to_pylist()
        levels = [pack(part.levels(np.frombuffer(r["payload"], np.uint64)).astype(np.uint8)) for r in rows]
        return pa.Table.from_arrays([pa.array([r["segment"] for r in rows], pa.int32()), pa.array([r["block"] for r in rows], pa.int64()),
                                     pa.array(levels, pa.binary())], schema=PROBE_SCHEMA)

    return run


def _per_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("segment", "payload")).alias(name))


def score(docs: DataFrame, train: Column, *, text: str = "text", key: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES,
          segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """One row per document row: key, train, n_tokens, n_known, train_tokens, base_score (add-one unigrams, exact counts)
    and score (log10 probability by the filter's smoothed bigrams).  ``train`` marks the rows to learn from."""
    spark = docs.sparkSession
    blocks = corpus_blocks(docs, train, text, key)
    totals = blocks.agg(F.sum("train_tokens"), F.sum("n_tokens")).first()
    n, segments = totals[0] or 0, max(1, -(-(totals[1] or 0) // segment_tokens))
    grams = blocks.mapInArrow(_grams(segments), GRAM_FIELDS)
    made = shared_table(grams.groupBy("segment").applyInArrow(_segment, SEGMENT_FIELDS), "lm-segments")
    parts = made.filter(F.col("block").isNull())
    v, size = parts.agg(F.sum("known"), F.sum(F.length("payload"))).first()
    ready = blocks.join(_per_block(made.filter(F.col("block").isNotNull()), "counts"), "block")
    shared = None
    if (size or 0) <= broadcast_bytes:
        rows = parts.select("segment", "payload").toLocalIterator()
        shared = spark.sparkContext.broadcast(LogFilter([(r["segment"], bytes(r["payload"])) for r in rows], segments))
    else:
        probes = blocks.mapInArrow(_probes(segments), PROBE_FIELDS).groupBy("segment")
        levels = probes.cogroup(parts.select("segment", "payload").groupBy("segment")).applyInArrow(_answered(segments), PROBE_FIELDS)
        ready = ready.join(_per_block(levels, "levels"), "block")
    return ready.mapInArrow(_scores(n, v or 0, shared), SCORE_FIELDS)
