"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles, weight = tf * idf with the smoothed

    idf = 1 + IDF_SHARE * ln((N + 1) / (df + 1)) / ln(N + 1)

Document frequencies are counted over all documents in 2^18 hashed buckets (their expected
share of collisions taken off), so the statistics are a fixed megabyte whatever the corpus.
The similarity is the weighted Jaccard  sum min / sum max.

1. Exact copies (equal text digest) become one node; only digests are shuffled for that.
2. Every node draws BANDS * ROWS consistent samples (ICWS: per shingle and sample r, c ~
   Gamma(2,1), b ~ U(0,1); t = floor(ln w / r + b); the shingle with the least c / (exp(r (t - b)) exp(r))
   is drawn, together with t).  Two texts of similarity s agree in a sample with probability s, so they
   share at least one of 8 bands of 2 samples with probability 0.9997 at s = 0.8.
3. Texts meet per band value, in blocks of at most BLOCK: a task compares all texts of a block exactly
   and emits a star per class found (each text with the class's least one), never the pairs.
   First band 0; then the other bands, but only values whose members are not in one class yet
   (no link could change anything elsewhere); last, for values of several blocks, pairs of blocks
   that are still of different classes.  So every pair that shares a band is compared unless its
   texts already are in one class: no partner is capped and no link between classes is lost.
4. Classes are the connected components of the links (minimum label with shortcuts, in DataFrames).

Defined cases: null and empty texts are one class of exact copies and have no shingles, so no near copies;
texts of fewer than five words are one shingle; ids may repeat or be null (a null id counts as
larger than all others when the kept row is chosen, repeated rows keep one row); an empty table gives an
empty result; other columns don't matter.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import mix64, row_columns, shared_table, shingles, slices, text_key, text_or_empty, whole_rows

THRESHOLD = 0.8
IDF_SHARE = 0.25
BANDS, ROWS = 8, 2
BUCKETS = 1 << 18
CHUNKS = 64                # pieces of the bucket table while it is summed
BLOCK = 512                # texts compared in one task step
CELLS = 8_000_000          # cells of the dense work matrix
DRAWS = 1 << 16            # entries of the tables of random draws
BATCH_SHINGLES = 500_000


# -- document frequencies ------------------------------------------------------------

def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 18)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(estimated df of a shingle in each bucket, number of documents with a shingle)."""
    width = BUCKETS // CHUNKS

    def count(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in slices(batches):
            for t in b.column(0).to_pylist():
                h = np.unique(shingles(t))
                if len(h):
                    n += 1
                    total += np.bincount(_bucket(h), minlength=BUCKETS) if len(h) > 4096 else 0
                    if len(h) <= 4096:
                        np.add.at(total, _bucket(h), 1)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS)), pa.array([part] * CHUNKS, pa.int64()), pa.array([n] * CHUNKS, pa.int64()),
             pa.array([total[i * width:(i + 1) * width].astype("<i8").tobytes() for i in range(CHUNKS)], pa.binary())],
            names=["chunk", "part", "n", "counts"])

    def add(pdf):
        counts = sum(np.frombuffer(x, "<i8") for x in pdf["counts"])
        return pdf.head(1).assign(part=pdf["part"] // 256, n=pdf["n"].sum(), counts=[counts.tobytes()])

    schema = "chunk bigint, part bigint, n bigint, counts binary"
    level = shared_table(docs.select("text").mapInArrow(count, schema), "dup-df")
    while True:  # 256 tasks' tables at a time, until one is left
        level = shared_table(level.groupBy("chunk", F.floor(F.col("part") / 256).alias("up")).applyInPandas(lambda k, p: add(p), schema), "dup-df")
        if level.filter("part > 0").isEmpty():
            break
    rows = level.orderBy("chunk").collect()  # CHUNKS rows of fixed size
    if not rows:
        return np.zeros(BUCKETS), 0
    counts = np.concatenate([np.frombuffer(r["counts"], "<i8") for r in rows]).astype(float)
    chance = (counts.sum() - counts) / (BUCKETS - 1)
    return np.maximum(counts - chance, 1.0), int(rows[0]["n"])


def idf_table(df: np.ndarray, n: int, share: float = IDF_SHARE) -> np.ndarray:
    return (1 + share * np.clip(np.log((n + 1) / (df + 1)) / np.log(n + 1.0), 0, 1) if n else np.ones(BUCKETS)).astype(np.float32)


# -- sampling ------------------------------------------------------------------------

@lru_cache(maxsize=1)
def _draws():
    rng = np.random.RandomState(20240229)
    u = 1.0 - rng.random_sample((BANDS * ROWS, 5, DRAWS))
    r, c = -np.log(u[:, 0] * u[:, 1]), -np.log(u[:, 2] * u[:, 3])
    odd = rng.randint(1, 1 << 62, BANDS * ROWS).astype(np.uint64) | np.uint64(1)
    return odd, r.astype(np.float32), np.log(c).astype(np.float32), u[:, 4].astype(np.float32)


def weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their weights."""
    h, tf = np.unique(shingles(text), return_counts=True)
    return h, tf * idf[_bucket(h)]


def band_values(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(text, band) values of non-empty weighted sets."""
    sizes = np.array([len(h) for h, _ in sets])
    h = np.concatenate([x for x, _ in sets])
    log_w = np.log(np.concatenate([w for _, w in sets])).astype(np.float32)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    odd, r, log_c, b = _draws()
    out = np.zeros((len(sets), BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        at = ((h * odd[k]) >> np.uint64(48)).astype(np.int64)
        rk = r[k][at]
        t = np.floor(log_w / rk + b[k][at])
        a = log_c[k][at] - rk * (t - b[k][at]) - rk
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
        _, first = np.unique(np.searchsorted(starts, least, "right"), return_index=True)
        drawn = least[first]
        sample = mix64(h[drawn] + t[drawn].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, k // ROWS] = mix64(out[:, k // ROWS] * np.uint64(31) + sample + np.uint64(k + 1))
    return out


def _signatures(docs: DataFrame, idf) -> DataFrame:
    """node, doc_id, bands (null without a shingle) per row."""
    def run(batches):
        for b in slices(batches):
            texts = b.column(2).to_pylist()
            bands: list[list[int] | None] = [None] * len(texts)
            pending, load = [], 0
            for i, t in enumerate(texts):
                s = weighted(t, idf.value)
                if len(s[0]):
                    pending.append((i, s))
                    load += len(s[0])
                if pending and (load >= BATCH_SHINGLES or i == len(texts) - 1):
                    for (j, _), v in zip(pending, band_values([s for _, s in pending]).view(np.int64).tolist()):
                        bands[j] = v
                    pending, load = [], 0
            if pending:
                for (j, _), v in zip(pending, band_values([s for _, s in pending]).view(np.int64).tolist()):
                    bands[j] = v
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bands, pa.list_(pa.int64()))], names=["node", "doc_id", "bands"])

    return docs.select("node", "doc_id", "text").mapInArrow(run, "node binary, doc_id bigint, bands array<bigint>")


# -- exact comparison inside a block ---------------------------------------------------

def similarities(sets: list[tuple[np.ndarray, np.ndarray]], tfs: list[np.ndarray]) -> np.ndarray:
    """Weighted Jaccard of all pairs.  The j-th occurrence of a shingle is an element of its own,
    so sum min is the weight of the common elements: a matrix product over shared elements."""
    n = len(sets)
    element, weight, owner = [], [], []
    for i, ((h, w), tf) in enumerate(zip(sets, tfs)):
        nth = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
        element.append(np.repeat(h, tf) + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        weight.append(np.repeat(w / tf, tf))
        owner.append(np.full(len(nth), i))
    element, weight, owner = np.concatenate(element), np.concatenate(weight), np.concatenate(owner)
    total = np.bincount(owner, weight, minlength=n)
    by = np.argsort(element, kind="stable")
    element, weight, owner = element[by], weight[by], owner[by]
    head = np.r_[True, element[1:] != element[:-1]] if len(element) else np.zeros(0, bool)
    of = np.cumsum(head) - 1
    several = np.bincount(of)[of] > 1
    of, weight, owner = of[several], weight[several], owner[several]
    common = np.zeros((n, n))
    if len(of):
        of = np.cumsum(np.r_[True, of[1:] != of[:-1]]) - 1
        step = max(1, CELLS // n)
        for lo in range(0, of[-1] + 1, step):
            a, z = np.searchsorted(of, [lo, lo + step])
            x = np.zeros((n, min(step, of[-1] + 1 - lo)), np.float32)
            x[owner[a:z], of[a:z] - lo] = np.sqrt(weight[a:z])
            common += x @ x.T
    return common / np.maximum(total[:, None] + total[None, :] - common, 1e-12)


def stars(linked: np.ndarray, nodes: list, labels: list) -> list[tuple]:
    """(node, least node of its component) for the nodes that a link joins to others; nodes with
    equal labels count as joined already."""
    up = list(range(len(nodes)))

    def root(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    seen: dict = {}
    for i, label in enumerate(labels):
        up[root(i)] = root(seen.setdefault(label, i))
    joined = False
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = root(int(i)), root(int(j))
        if a != b:
            up[a], joined = b, True
    if not joined:
        return []
    least: dict = {}
    for i, node in enumerate(nodes):
        least[root(i)] = min(node, least.get(root(i), node))
    return [(node, least[root(i)]) for i, node in enumerate(nodes) if least[root(i)] != node]


def _compare(grouped: DataFrame, idf, threshold: float) -> DataFrame:
    """Links found inside each group of (group, node, label, text) rows: (a, b), b the least
    node of a's component there."""
    def solve(rows):
        if len(rows) < 2 or len({r[1] for r in rows}) < 2:
            return []
        sets, tfs = [], []
        for _, _, t in rows:
            h, tf = np.unique(shingles(t), return_counts=True)
            sets.append((h, tf * idf.value[_bucket(h)]))
            tfs.append(tf)
        return stars(similarities(sets, tfs) >= threshold - 1e-6, [r[0] for r in rows], [r[1] for r in rows])

    def run(batches):
        group, rows = None, []
        for b in batches:
            links = []
            for g, node, label, text in zip(*(c.to_pylist() for c in b.columns)):
                if g != group:
                    links += solve(rows)
                    group, rows = g, []
                rows.append((node, label, text))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])
        if links := solve(rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])

    dealt = grouped.repartition("group").sortWithinPartitions("group")
    return dealt.select("group", "node", "label", "text").mapInArrow(run, "a binary, b binary")


# -- connected components --------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, for all nodes of the links (a, b)."""
    both = shared_table(links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "dup-links")
    labels = shared_table(both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("label")), "dup-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = shared_table(lower.join(up, "label", "left").select(
            "node", "old", F.coalesce("above", "label").alias("label")), "dup-labels")
        labels = moved.select("node", "label")
        if moved.filter("old <> label").isEmpty():
            return labels


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links between nodes (a node without a label is its own)."""
    links = shared_table(links, "dup-found")
    if links.isEmpty():
        return labels
    def lifted(c):
        return F.coalesce("label", c)
    x = links.join(labels.withColumnRenamed("node", "a"), "a", "left").select(lifted("a").alias("a"), "b")
    x = x.join(labels.withColumnRenamed("node", "b"), "b", "left").select("a", lifted("b").alias("b"))
    over = components(x.filter("a <> b"))
    old = labels.join(over.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    new = over.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return shared_table(old.unionByName(new).groupBy("node").agg(F.min("label").alias("label")), "dup-labels")


# -- the operator ------------------------------------------------------------------------

def near_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows: node, doc_id per input row; classes: node, label for nodes linked to others)."""
    spark = docs.sparkSession
    body = text_or_empty(F.col(f"`{text}`"))
    narrow = docs.select(text_key(body).alias("node"), F.col(f"`{key}`").cast("bigint").alias("doc_id"), body.alias("text"))
    df, n = document_frequencies(narrow)
    idf = spark.sparkContext.broadcast(idf_table(df, n))
    rows = shared_table(_signatures(narrow, idf), "dup-signatures")
    nodes = rows.groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("first"), F.first("bands").alias("bands"))
    spread = nodes.filter("bands is not null").select("node", "first", F.posexplode("bands").alias("band", "value"))
    # written, so that the join below is between two exchanges and a hot value can be split
    shared = shared_table(spread.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1"), "dup-values")
    members = shared_table(spread.join(shared, ["band", "value"]).select(
        "band", "value", "n", "node", "first", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / block)).alias("block")), "dup-members")
    wanted = members.select("node", "first").distinct()
    texts = shared_table(narrow.withColumn("first", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
                         .join(wanted, ["node", "first"]).groupBy("node").agg(F.first("text").alias("text")), "dup-texts")
    members = members.drop("first")

    def with_labels(m: DataFrame, labels: DataFrame) -> DataFrame:
        return m.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def mixed(m: DataFrame, *by: str) -> DataFrame:
        """The members of groups that aren't of one class yet."""
        several = m.groupBy(*by).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select(*by)
        return m.join(shared_table(several, "dup-mixed"), list(by), "left_semi")

    def compared(m: DataFrame, *by: str) -> DataFrame:
        grouped = m.select(F.xxhash64(*by).alias("group"), "node", "label")
        return _compare(grouped.join(texts, "node"), idf, threshold)

    # a node is in one block of band 0, so what a block finds there are its classes already
    labels = shared_table(compared(members.filter("band = 0").withColumn("label", F.col("node")), "band", "value", "block")
                          .select(F.col("a").alias("node"), F.col("b").alias("label")), "dup-labels")
    rest = mixed(with_labels(members.filter("band > 0"), labels), "band", "value", "block")
    labels = _joined(labels, compared(rest, "band", "value", "block"))
    # values of several blocks: pairs of blocks (i < j) that aren't of one class
    large = shared_table(mixed(with_labels(members.filter(F.col("n") > block), labels), "band", "value"), "dup-large")
    if not large.isEmpty():
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / block) - 1)).alias("other")
        pairs = (large.select("band", "value", "node", "label", "block", other).filter("other <> block")
                 .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
        labels = _joined(labels, compared(mixed(pairs, "band", "value", "i", "j"), "band", "value", "i", "j"))
    return rows.select("node", "doc_id"), labels


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_rows, kept: one row per document row."""
    rows, labels = near_classes(docs, text, key, threshold)
    labelled = shared_table(rows.join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label")), "dup-rows")
    classes = shared_table(labelled.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows")), "dup-classes")
    return (labelled.join(classes, "label")
            .select("doc_id", "class_id", "class_rows", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class (all its columns): the least doc_id, one row of repeated ones."""
    rows, labels = near_classes(docs)
    last = F.lit((1 << 63) - 1)
    labelled = rows.join(labels, "node", "left").select(F.coalesce("doc_id", last).alias("id"), "node", F.coalesce("label", "node").alias("label"))
    kept = labelled.groupBy("label").agg(F.min(F.struct("id", "node")).alias("k")).select("k.id", "k.node")
    row = F.col("row")
    tagged = whole_rows(docs).withColumns({"node": text_key(row.getField("text")),
                                           "id": F.coalesce(row.getField("doc_id").cast("bigint"), last)})
    chosen = tagged.join(kept, ["node", "id"], "left_semi")
    # rows of the same id and text: the first by all columns that have an order, so that a rerun keeps the same one
    ordered = [row.getField(f.name) for f in docs.schema if f.dataType.typeName() not in ("map", "variant") and f.name not in ("doc_id", "text")]
    one = F.row_number().over(Window.partitionBy("node", "id").orderBy(*ordered or [F.lit(0)]))
    return chosen.withColumn("one", one).filter("one = 1").select(*row_columns(docs.columns))
