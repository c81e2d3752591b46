"""Sharding by Karmarkar-Karp differencing.

Rows with equal texts form one indivisible group.  A partial partition is a tuple of
``shards`` subset sums; differencing takes the two with the largest spread and joins
them oppositely ordered (largest with smallest), until one is left.

At scale the large groups come first, as in the flat method, and the others fill up:

1. Groups are classed by the power of two of their weight (at most 64 classes).  Classes of fewer than
   ``LEAST_CLASS`` groups, so all exceptionally large ones, are differenced together in one task (at
   most 64 * LEAST_CLASS groups, whatever the corpus).
2. The level to which the remaining weight can fill the shards gives every shard's deficit.
3. The other classes are dealt by hash to blocks of about ``BLOCK_GROUPS`` groups of *similar* weight.  A block
   is differenced in a task together with one more partial partition, the deficits' inverse
   scaled to the block's weight, so its sums come out in proportion to the deficits.  A block of thousands of similar groups
   leaves a spread of a group or less, so the shards stay even to about 1 / BLOCK_GROUPS.
4. About BLOCK_GROUPS groups of these classes (by hash) are held back for the end and differenced with the
   sums of all others, which evens out what the blocks left over; a small corpus has no other blocks.

A task never holds more than a block, and only the 64 class counts and one tuple of sums reach the driver.

The law is ``bytes``: shard sizes near equal (size: UTF-8 bytes plus 1).  A group is counted before
anything is shuffled by its digest, so a text held by a third of all rows is one row here;
rows meet their group's shard in a join that adaptive execution can split.

Defined cases: null text counts as empty; repeated rows stay together; an empty table
gives an empty result; ties are broken by position (hash order), so results are repeatable.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import shared_table, text_key, text_or_empty

SHARDS = 8
BLOCK_GROUPS = 20_000
LEAST_CLASS = 2_000
SLOT_ROWS = 20_000


def difference(tuples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over ``tuples`` (n x k subset sums).

    Returns (sums, to): the k sums of the final partition, descending, and to[i, j] = the final
    subset of subset j of input i.
    """
    n, k = tuples.shape
    by = np.argsort(-tuples, axis=1, kind="stable")
    sums = [tuples[i, by[i]].tolist() for i in range(n)]
    heap = [(s[-1] - s[0], i) for i, s in enumerate(sums)]  # negative spread
    heapq.heapify(heap)
    steps = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        merged = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(k), key=lambda j: -merged[j])
        new = len(sums)
        sums.append([merged[j] for j in order])
        steps.append((new, a, b, order))
        sums[a] = sums[b] = None
        heapq.heappush(heap, (sums[new][-1] - sums[new][0], new))
    root = heap[0][1]
    final = sums[root]
    place = {root: list(range(k))}
    for new, a, b, order in reversed(steps):
        up = place.pop(new)
        at = [0] * k
        for position, j in enumerate(order):
            at[j] = up[position]
        place[a], place[b] = at, at[::-1]
    to = np.empty((n, k), np.int64)
    for i in range(n):
        to[i, by[i]] = place[i]
    return np.array(final, np.int64), to


def _deficits(sums: list[int], light: int) -> list[int]:
    """How much each shard takes of ``light`` more so that all end as even as they can."""
    order = sorted(range(len(sums)), key=lambda j: sums[j])
    for k in range(len(order), 0, -1):
        level = (light + sum(sums[j] for j in order[:k])) / k
        if level >= sums[order[k - 1]]:
            return [max(0, round(level - sums[j])) if j in order[:k] else 0 for j in range(len(sums))]
    return [0] * len(sums)


def _solve(k: int, deficits: list[int]):
    """Shards of one block's groups; the block's sums come out in proportion to the deficits."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("text_key", kind="stable")
        weights = pdf["weight"].to_numpy(np.int64)
        share = int(weights.sum()) / max(1, sum(deficits))
        # rotated by block, so that what is left over doesn't fall to the same shard everywhere
        turn = int(pdf["block"].iloc[0]) % k
        fill = np.roll([int((max(deficits) - d) * share) for d in deficits], turn)
        tuples = np.zeros((len(pdf) + 1, k), np.int64)
        tuples[0] = fill
        tuples[1:, 0] = weights
        _, to = difference(tuples)
        shard_of = np.empty(k, np.int64)
        shard_of[to[0]] = (np.arange(k) - turn) % k
        return pd.DataFrame({"text_key": pdf["text_key"], "weight": weights, "shard": shard_of[to[1:, 0]]})
    return run


def group_shards(groups: DataFrame, shards: int = SHARDS, block_groups: int = BLOCK_GROUPS,
                 least_class: int = LEAST_CLASS) -> DataFrame:
    """(text_key, shard) for groups (text_key binary, weight bigint of at least 1), one row each."""
    schema = "text_key binary, weight bigint, shard int"
    groups = shared_table(groups.select("text_key", "weight", F.floor(F.log2("weight")).cast("int").alias("size_class")), "kk-groups")
    classes = groups.groupBy("size_class").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()  # at most 64 rows
    few = [r["size_class"] for r in classes if r["n"] < least_class]
    heavy = shared_table(groups.filter(F.col("size_class").isin(few)).withColumn("block", F.lit(0))
                         .groupBy("block").applyInPandas(_solve(shards, [0] * shards), schema), "kk-heavy")
    light = groups.filter(~F.col("size_class").isin(few))
    n_light = sum(r["n"] for r in classes if r["n"] >= least_class)
    last = F.pmod(F.xxhash64("text_key", F.lit("last")), F.lit(max(1, round(n_light / block_groups)))) == 0
    held = light.filter(last)
    w_held = held.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    w_light = sum(r["w"] for r in classes if r["n"] >= least_class)
    blocks = F.lit(1)
    for r in classes:
        blocks = F.when(F.col("size_class") == r["size_class"], max(1, round(r["n"] / block_groups))).otherwise(blocks)
    placed = heavy.unionByName(
        light.filter(~last).withColumn("block", F.pmod(F.xxhash64("text_key"), blocks)).groupBy("size_class", "block")
        .applyInPandas(_solve(shards, _deficits(_sums(heavy, shards), w_light - w_held)), schema))
    placed = shared_table(placed, "kk-placed")
    held = held.withColumn("block", F.lit(0)).groupBy("block").applyInPandas(
        _solve(shards, _deficits(_sums(placed, shards), w_held)), schema)
    return shared_table(placed.unionByName(held).select("text_key", "shard"), "kk-shards")


def _sums(placed: DataFrame, shards: int) -> list[int]:
    by = {r["shard"]: r["w"] for r in placed.groupBy("shard").agg(F.sum("weight").alias("w")).collect()}
    return [by.get(j, 0) for j in range(shards)]


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per document."""
    body = text_or_empty(F.col(f"`{text}`"))
    rows = shared_table(docs.select(
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), text_key(body).alias("text_key")), "kk-rows")
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("weight"))
    placed = rows.join(group_shards(groups, shards), "text_key")
    # slots: rows are dealt to bands by id, counted per (shard, band), and numbered inside
    bands = max(1, rows.count() // SLOT_ROWS + 1) * shards
    banded = shared_table(placed.select("doc_id", "size", "text_crc32", "shard", "text_key",
                                        F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(bands)).cast("int").alias("band")), "kk-banded")
    counts = banded.groupBy("shard", "band").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "band", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "band").orderBy("doc_id", "text_key")) - 1
    return (banded.withColumn("inside", inside).join(first, ["shard", "band"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("inside")).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
