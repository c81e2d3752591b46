import hashlib
import random
import tempfile

from pyspark.sql import functions as F

from tidewatch.llm import chat as C
from tidewatch.llm import warc as W

HARD = ["", "\\", "\\\\", "</turn>", "<\\/turn>", "<\\\\/turn>", " </turn>\n", "### User: ", "### Assistant: x </turn>\n### User: y", "##\\# ", "##\\\\# ",
        "#### System: ", "\\### Assistant: </turn> ok", "a\nb\r\n", "<</turn></turn>", "### =41: ", "héé\U0001F600", " ", "\n", "x" * 50_000]


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")


def test_hard_texts_round_trip(spark):
    rng = random.Random(5)
    parts = ["\\", "</turn>", "<\\/turn>", "### ", "##\\# ", "User: ", "\n", " ", "a", "/", "#", "<", ">", "Assistant: "]
    texts = HARD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    roles = ["user", "assistant", "system", "", "tool: x", "### User: ", "User", "\\"]
    rows = [(i % 60, i, roles[i % len(roles)] if i % 60 != 7 else "assistant", t, "clash") for i, t in enumerate(texts)]
    out = C.read_back(C.format_conversations(_turns(spark, rows)))
    want = {}
    for conv, _, role, t, _ in rows:
        want.setdefault(conv, []).append((role, t))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for role, t in turns if role == "assistant")


def test_only_conflicting_texts_are_escaped(spark):
    rows = [(1, 0, "user", "plain \\ text ### here", None), (2, 0, "user", "an </turn> end", None), (3, 0, "user", "### User: \\", None)]
    got = {r.conv_id: r.formatted for r in C.format_conversations(_turns(spark, rows)).collect()}
    assert got == {1: "### User: plain \\ text ### here </turn>\n", 2: "### User: an <\\/turn> end </turn>\n",
                   3: "### User: ##\\# User: \\\\ </turn>\n"}


def test_a_broken_rendering_is_not_parsed(spark):
    broken = ["### User: a", "### User: a </turn>\ntail", "User: a </turn>\n", "### User: a ### Assistant: b </turn>\n"]
    df = spark.createDataFrame([(x,) for x in broken], "formatted string")
    got = [r.t for r in df.select(C.parse(F.col("formatted")).alias("t")).collect()]
    assert all(t is None or any(x.text is None for x in t) for t in got)


def test_chat_nulls_ties_and_empty(spark):
    rows = [(None, 1, None, None, None), (None, None, "user", "first", None), (5, 1, "user", "b", None), (5, 1, "assistant", "z", None),
            (5, 1, "assistant", "z", None)]
    got = {r.conv_id: r for r in C.digests(C.format_conversations(_turns(spark, rows))).collect()}
    assert got[None].n_turns == 2 and got[5].n_turns == 3
    assert got[None].turns_sha256 == hashlib.sha256(b"user\nfirst\n\n\n").hexdigest()
    assert got[5].turns_sha256 == hashlib.sha256(b"assistant\nz\nassistant\nz\nuser\nb\n").hexdigest()
    assert got[5].loss_chars == 2 and got[None].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert C.digests(C.format_conversations(_turns(spark, []))).count() == 0


MAGIC = "WARC/1.0\r\n"


def _fake(n=5, tail=""):
    return f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: {n}\r\n\r\n{'q' * n}\r\n\r\n{tail}"


def test_warc_round_trip_with_magic_in_payloads(spark):
    big = "b" * 2000
    pages = [None, "", "short", "short", big, big, big, _fake(), "x" + _fake(5, "more"), MAGIC, MAGIC * 3 + "é", "a\r\n\r\nb\r\n\r\n",
             _fake(100_000), "tail " + MAGIC[:-1], "y" * 1500 + _fake(3), "y" * 1500 + _fake(3), "z" * 300_000]
    urls = [None, "http://a\r\nWARC-Type: x"] + ["http://h/é"] * (len(pages) - 2)
    rows = [(i, urls[i], h, "clash") for i, h in enumerate(pages)] + [(None, "u", big, "c"), (None, "u", "n", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    got = W.round_trip(df).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got if r.page_id is not None}
    for i, h in enumerate(pages):
        data = (h or "").encode()
        top = max(j for j, x in enumerate(pages) if (x or "") == (h or ""))
        revisit = len(data) >= 1000 and i != top
        assert (by_id[i].payload_bytes, by_id[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest()), i
        assert (by_id[i].record_type, by_id[i].refers_to) == (("revisit", top) if revisit else ("response", None)), i
    nulls = sorted((r.record_type, r.refers_to or -1, r.payload_bytes) for r in got if r.page_id is None)
    assert nulls == [("response", -1, 1), ("revisit", 6, 2000)]


def test_warc_chain_over_blocks_and_splits(spark):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", "".join(rng.choice(["ab", _fake(4), "\r\n", MAGIC]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = tempfile.mkdtemp(prefix="tw-warc-") + "/a"
    W.write_archive(df, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = W.pages_of(W.read_archive(spark, path, block=4096)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert sorted((r.page_id, r.payload_digest) for r in got) == sorted((i, sha(t)) for i, _, t in rows)


def test_reachable_keeps_only_the_chain(spark):
    # chain 0 -> 90 -> 250 -> 700 (end); 120 and 300 are decoys, one of which points into the chain
    rows = [("f", 0, 90), ("f", 90, 250), ("f", 250, 700), ("f", 120, 250), ("f", 300, 310), ("g", 0, 50), ("g", 60, 99)]
    got = W.reachable(spark.createDataFrame(rows, "file string, start long, next long"), block=100).collect()
    assert sorted(map(tuple, got)) == [("f", 0), ("f", 90), ("f", 250), ("g", 0)]


def test_warc_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.round_trip(df).count() == 0


def test_bit_map_keeps_every_key(spark, monkeypatch):
    """Rows of the keys are all among those that may match; few others are, and with a full map all of them."""
    rows = spark.range(4000).select(F.col("id").alias("k"), F.sha1(F.col("id").cast("string").cast("binary")).alias("digest"), F.lit("x").alias("html"))
    keys = rows.filter("k % 7 = 3").select("k", "digest")
    wanted = {r.k for r in keys.collect()}
    for bits, most in ((W.REVISIT_BITS, 20), (1 << 15, 200), (8, 4000)):
        monkeypatch.setattr(W, "REVISIT_BITS", bits)
        maybe, others = W._split_by_bits(rows, keys)
        a, b = [{r.k for r in x.collect()} for x in (maybe, others)]
        assert wanted <= a and a | b == set(range(4000)) and not a & b and len(a - wanted) <= most
    assert W._split_by_bits(rows, keys.limit(0))[0].count() == 0
