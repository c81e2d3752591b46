r"""WARC archives: writing with payload dedup, reading by boundary-chain verification.

Writing.  A record is one row; Spark's text writer puts CR LF CR LF behind it, which is just
the format's record end.  Of equal payloads of at least ``LEAST_REVISIT`` bytes the one with the
largest page_id is the response, the others are revisits without a payload.  Only
(digest, page_id) pairs are grouped and joined, so a payload that a third of all pages
share moves as short rows.  The revisits' keys make a bit map of ``REVISIT_BITS`` bits, which goes to all tasks: a page without a bit
there is written straight from its scan.  Only pages with one (the revisits, and others by chance: n / REVISIT_BITS of them for n
revisits) meet the table of revisits by shuffle.

Reading.  Files are cut at every occurrence of the magic ``WARC/1.0 CR LF`` by the text reader
(splittable, by any path Spark reads).  The magic may occur inside payloads, so each occurrence is only a
candidate: a task emits (file, offset, successor), the successor from the candidate's own
header length and Content-Length.  True records are those reachable from the file start:

* inside a block of ``BLOCK`` bytes, a task follows the pointers and gives each candidate its
  exit, the first offset beyond the block;
* pointer jumping (doubling) over the exits finds the offsets at which the chain from the
  file start enters each block, in log2(blocks of a file) rounds;
* each block then walks from its entry and keeps what it meets.

A record whose payload holds the magic consists of several stretches; these are read once more and joined.

Defined cases: null html is an empty payload, null url an empty URI (line breaks in it become
spaces), null page_id the id ``none`` and null again when read; rows with equal payload and the same largest page_id
are all responses; a broken chain keeps the records before the break; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewatch.llm.common import shared_folder, shared_table, slices, text_or_empty

MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
LEAST_REVISIT = 1000
REVISIT_BITS = 1 << 23          # 1 MB
BLOCK = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"   # the pages table has no crawl time

_CANDIDATE = ("file string, split bigint, local bigint, bytes bigint, header bigint, length bigint, type string, id string, "
              "uri string, stated string, refers string, digest string")
_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)[ \t]*$", re.M)


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                  least_revisit: int = LEAST_REVISIT) -> None:
    """One .warc text file per input partition below ``path``."""
    rows = pages.select(F.col(f"`{key}`").cast("bigint").alias("page_id"),
                        F.regexp_replace(text_or_empty(F.col(f"`{url}`")), "[\r\n]+", " ").alias("url"),
                        text_or_empty(F.col(f"`{html}`")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("bigint")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = rows.filter(F.col("bytes") >= least_revisit).select("page_id", "digest")
    # written, so that the join below is between two exchanges and a hot digest can be split
    first = shared_table(long.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
                         .filter("n > 1 and refers_to is not null"), "warc-first")
    revisits = shared_table(long.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
                            .select(F.coalesce("page_id", F.lit(-1 << 63)).alias("k"), "digest", "refers_to").distinct(), "warc-revisits")
    rows = rows.withColumn("k", F.coalesce("page_id", F.lit(-1 << 63)))
    maybe, others = _split_by_bits(rows, revisits)
    rows = maybe.join(revisits, ["k", "digest"], "left").unionByName(others.withColumn("refers_to", F.lit(None).cast("bigint")))
    is_revisit = F.col("refers_to").isNotNull()

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))

    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")), line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(is_revisit, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(is_revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"), F.when(is_revisit, "").otherwise(F.col("html")))
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def _split_by_bits(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose (k, digest) may be among ``keys``, and those whose isn't, by a bit map of fixed size."""
    place = F.pmod(F.xxhash64("k", "digest"), F.lit(REVISIT_BITS))
    bit = F.bitmap_bit_position(place)
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    marked = rows.withColumn("bucket", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "bucket", "left")  # at most REVISIT_BITS bits
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.pmod(bit, F.lit(8))).cast("int")) != 0, F.lit(False))
    columns = rows.columns
    return marked.filter(is_set).select(*columns), marked.filter(~is_set).select(*columns)


def _stretches(spark: SparkSession, path: str) -> DataFrame:
    """Bytes between magics with the split they were read in, in file order inside a task."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.col("value").cast("binary").alias("value")))


class _Places:
    """Running byte position inside each split."""

    def __init__(self):
        self.at, self.split = 0, None

    def next(self, split, size: int) -> int:
        if split != self.split:
            self.at, self.split = 0, split
        here = self.at
        self.at += size + len(MAGIC)
        return here


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    def run(batches):
        places = _Places()
        for b in slices(batches, 256):
            rows = []
            for file, split, value in zip(*(b.column(i).to_pylist() for i in range(3))):
                local = places.next((file, split), len(value))
                head = value.find(b"\r\n\r\n")
                fields = dict(_FIELD.findall(value[:head].replace(b"\r", b""))) if head >= 0 else {}
                length = fields.get(b"Content-Length", b"")
                length = int(length) if length.isdigit() and len(length) < 18 else None
                body = head + 4
                whole = length is not None and body + length + len(RECORD_END) == len(value)
                said = [fields[k].decode("utf-8", "replace") if k in fields else None for k in
                        (b"WARC-Type", b"WARC-Record-ID", b"WARC-Target-URI", b"WARC-Payload-Digest", b"WARC-Refers-To")]
                rows.append((file, split, local, len(value), body if length is not None else None, length, *said,
                             hashlib.sha1(value[body:body + length]).hexdigest() if whole else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    names = [x.split()[0] for x in _CANDIDATE.split(", ")]
    kinds = [pa.string()] + [pa.int64()] * 5 + [pa.string()] * 6
    return _stretches(spark, path).mapInArrow(run, _CANDIDATE)


def _exits(block: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        end = (int(pdf["block"].iloc[0]) + 1) * block
        out: dict[int, int | None] = {}
        for start, nxt in sorted(zip(pdf["start"], pdf["next"]), reverse=True):
            out[start] = nxt if nxt >= end else out.get(nxt)
        starts = [s for s, e in out.items() if e is not None]
        return pd.DataFrame({"file": pdf["file"].iloc[0], "start": starts, "exit": [out[s] for s in starts]})
    return run


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    after = {s: n for s, n, entry in zip(pdf["start"], pdf["next"], pdf["entry"]) if not entry}
    kept = []
    for at in sorted(pdf["start"][pdf["entry"]]):
        while at in after:
            kept.append(at)
            at = after.pop(at)
    return pd.DataFrame({"file": pdf["file"].iloc[0], "start": kept})


def reachable(candidates: DataFrame, block: int = BLOCK) -> DataFrame:
    """(file, start) of the candidates (file, start, next) on the chain from offset 0."""
    candidates = candidates.select("file", "start", "next", F.floor(F.col("start") / block).alias("block"))
    exits = candidates.groupBy("file", "block").applyInPandas(_exits(block), "file string, start bigint, exit bigint")
    entries = exits.select("file", F.col("exit").alias("start")).distinct()
    jump = shared_table(exits.join(entries, ["file", "start"], "left_semi")
                        .unionByName(exits.filter("start = 0")).distinct(), "warc-jumps")
    reach = shared_table(candidates.filter("start = 0").select("file", "start").distinct(), "warc-reach")
    n = reach.count()
    while True:
        step = reach.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
        reach = shared_table(reach.unionByName(step).distinct(), "warc-reach")
        if (more := reach.count()) == n:
            break
        n = more
        onward = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("beyond"))
        jump = shared_table(jump.join(onward, ["file", "exit"]).select("file", "start", F.col("beyond").alias("exit")), "warc-jumps")
    entry = reach.select("file", "start", F.lit(0).cast("bigint").alias("next"),
                         F.floor(F.col("start") / block).alias("block"), F.lit(True).alias("entry"))
    return (candidates.withColumn("entry", F.lit(False)).unionByName(entry)
            .groupBy("file", "block").applyInPandas(_walk, "file string, start bigint"))


def read_archive(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """One row per true record: file, start, type, id, uri, refers, stated (digest in the header), payload_bytes, payload_digest."""
    found = shared_table(_candidates(spark, path), "warc-candidates")
    sizes = found.groupBy("file", "split").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = shared_table(sizes.select("file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "warc-bases")
    start = (F.col("base") + F.col("local") - len(MAGIC)).alias("start")
    placed = found.join(bases, ["file", "split"]).select("*", start).filter("start >= 0")
    total = F.col("header") + F.col("length") + len(RECORD_END)
    pointers = placed.filter("length is not null").select("file", "start", (F.col("start") + len(MAGIC) + total).alias("next"))
    records = shared_table(placed.join(reachable(pointers, block), ["file", "start"])
                           .select("file", "start", "type", "id", "uri", "refers", "stated", "header", "length", "digest"), "warc-records")
    parted = records.filter("digest is null")
    if not parted.isEmpty():
        # payloads with the magic inside: read their stretches again, by range of the record
        head, tail = len(MAGIC), len(RECORD_END)
        spans = parted.select("file", F.col("start").alias("record"), "header", "length",
                              (F.col("start") + head + F.col("header") + F.col("length") + tail).alias("end"))
        near = max(1, block // 16)  # both sides by small stretches of the file, so a join partner is always close
        spans = spans.withColumn("near", F.explode(F.sequence(F.floor(F.col("record") / near), F.floor((F.col("end") - 1) / near))))
        keys = (placed.select("file", "split", "local", "start", F.floor(F.col("start") / near).alias("near")).join(spans, ["file", "near"])
                .filter("start >= record and start < end").select("file", "split", "local", "start", "record", "header", "length"))

        def run(batches):
            places = _Places()
            for b in slices(batches, 256):
                local = [places.next((f, s), n) for f, s, n in
                         zip(b.column(0).to_pylist(), b.column(1).to_pylist(), map(len, b.column(2).to_pylist()))]
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(local, pa.int64()), b.column(2)],
                                                 names=["file", "split", "local", "value"])

        def join(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("start")
            data = MAGIC.encode().join(pdf["value"])
            at, n = int(pdf["header"].iloc[0]), int(pdf["length"].iloc[0])
            payload = data[at:at + n]
            return pd.DataFrame({"file": pdf["file"].iloc[:1], "start": pdf["record"].iloc[:1],
                                 "joined": [hashlib.sha1(payload).hexdigest() if len(payload) == n else None]})

        again = _stretches(spark, path).mapInArrow(run, "file string, split bigint, local bigint, value binary")
        joined = (again.join(shared_table(keys, "warc-parts"), ["file", "split", "local"])
                  .groupBy("file", "record").applyInPandas(join, "file string, start bigint, joined string"))
        records = records.join(joined, ["file", "start"], "left").withColumn("digest", F.coalesce("digest", "joined")).drop("joined")
    return records.select("file", "start", "type", "id", "uri", "refers", "stated",
                          F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"))


def pages_of(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit's payload is its response's."""
    def page(c):
        return F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)

    def number(c):
        return F.when(page(c) != "", page(c).cast("bigint"))

    rows = records.select(number("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                          number("refers").alias("refers_to"), F.regexp_replace("stated", "^sha1:", "").alias("stated"))
    responses = rows.filter("record_type = 'response'")
    full = (responses.filter("page_id is not null").select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"),
                                                           "payload_bytes", "payload_digest").distinct())
    revisits = rows.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(full, ["refers_to", "stated"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(columns).unionByName(revisits.select(columns))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path)
    return pages_of(shared_table(read_archive(spark, path), "warc-read"))
