"""Conversation structure repair: rank-convergence parallel Viterbi over edit costs.

The roles of a conversation's turns must read ``(s?(ua)+)?`` (system first if at all, then user and
assistant in turn).  Every row is kept (K, cost 0), given another role (R to user or assistant, 1) or deleted
(D, 2; the only choice for blank and repeated rows); empty user or assistant turns may be inserted anywhere
(I, 5); a truncated row that is not deleted costs 5 more.  The audit is the cheapest edits' initials in order,
of equally cheap ones the least in ASCII.  The states (nothing yet, after system, after user, after
assistant) decide which role an R or I gives, so an audit stands for one repair.

How it runs.  All rows are sorted by range over the cluster (conversation, turn), and cut into blocks of at
most ``rows`` rows, so that a conversation with any share of the rows is many blocks:

1. *Backward costs.*  ``B[i][state]`` is the least cost of the rest of the conversation.  All blocks run
   at once; a block whose last conversation goes on in the next one starts from a speculative cost
   vector.  In fix-up passes, a block whose true incoming vector turns out to differ from the assumed one by
   more than a constant reruns, and stops as soon as the new and the old vectors differ by a constant only (from
   there on, its result stands); passes go on until no block's incoming vector differs.  A conversation's end resets the
   vector, so only blocks that lie wholly inside one conversation can pass a change on.
2. *Tracing.*  The stitched vectors say which edits are cheapest in every state; the least letter among them is
   taken.  A block that starts inside a conversation doesn't know its entry state: it gives its exit for each
   of them, and pointer jumping over blocks composes these maps (logarithmic number of steps).

Vectors are kept relative to their least element; then only few different ones occur, and a step is one
look-up in a memo.  Duplicates are found by a pre-aggregated first position per (conversation, role, text)
and a join on the unique position, so that no popular text meets in one task.  The lines of a repaired conversation are
hashed where its block is; only conversations cut by a block's edge are hashed in a second step (a SHA-256
has to see its text in order: a conversation of very many rows streams through one task, never held).

The worst case of the fix-up passes is a very long stretch of one conversation that never
converges (say, nothing but system turns over k blocks): the change then moves by one block a pass.

Defined cases: null roles and texts are one space (blank); a null conversation id is a conversation; null
turns come first.  Rows of the same turn are ordered by role, then by md5 of the text; equal rows are
repeated rows (the later ones are duplicates).  Roles are judged by their first character, case included; other roles can only be
deleted or changed.  An empty table gives no rows.  Texts may have any length.  Only the named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import plain, shared_table

BLOCK_ROWS = 1 << 14  # a power of two
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States of the role sequence and where a role leads from each (None: not allowed there).
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
NEXT_ROLE = ("u", "u", "a", "u")  # what may follow a state, system apart
END = (0, 10, 5, 0)  # cost of completing the sequence by inserts
STATES = range(4)


def _options(state: int, letter: str, rest: tuple):
    """(audit letter, edit, cost, next state, cost of the rest) of a row's edits in ASCII order, inserts apart.

    ``letter``: the role's initial ('o': another), upper case if truncated, 'x' if it must be deleted."""
    yield "D", "D", DELETE, state, rest[state]
    if letter == "x":
        return
    cut = TRUNCATED * letter.isupper()
    kept = AFTER.get(letter.lower(), (None,) * 4)[state]
    if kept is not None:
        yield "K", "K", KEEP + cut, kept, rest[kept]
    role = NEXT_ROLE[state]
    to = AFTER[role][state]
    yield "R", role, REROLE + cut, to, rest[to]


def _base(v) -> tuple:
    least = min(v)
    return tuple(x - least for x in v)


def _costs(letter: str, rest: tuple) -> list:
    """Absolute backward costs at a row, given those after it."""
    now = [min(cost + after for _, _, cost, _, after in _options(s, letter, rest)) for s in STATES]
    for _ in range(2):
        now = [min(now[s], INSERT + now[AFTER[NEXT_ROLE[s]][s]]) for s in STATES]
    return now


@functools.cache
def step_back(letter: str, rest: tuple) -> tuple:
    """Backward cost vector at a row from that after it, both relative to their least element."""
    return _base(_costs(letter, rest))


@functools.cache
def step_on(letter: str, rest: tuple, state: int) -> tuple[str, str, int, int]:
    """(audit, edits, cost, next state) of a row entered in ``state``: cheapest, then least in ASCII."""
    now, audit, edits, cost = _costs(letter, rest), "", "", 0
    while True:
        choices = list(_options(state, letter, rest))
        role = NEXT_ROLE[state]
        to = AFTER[role][state]
        choices.insert(1, ("I", role.upper(), INSERT, to, now[to]))
        a, e, c, after, _ = next(x for x in choices if x[2] + x[4] == now[state])
        audit, edits, cost, state = audit + a, edits + e, cost + c, after
        if a != "I":
            return audit, edits, cost, state


@functools.cache
def finish(state: int) -> tuple[str, str, int]:
    """(audit, edits, cost) of completing the sequence at a conversation's end."""
    edits = ""
    while state in (SYSTEM, USER):
        role = NEXT_ROLE[state]
        edits, state = edits + role.upper(), AFTER[role][state]
    return "I" * len(edits), edits, INSERT * len(edits)


# ---------------------------------------------------------------- one block

def run_starts(convs: pa.Array) -> list[int]:
    """Positions at which another conversation starts, the block's start first, its length last."""
    n = len(convs)
    null = convs.is_null().to_numpy(zero_copy_only=False)
    ids = convs.fill_null(0).to_numpy(zero_copy_only=False)
    change = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    return [0, *(np.flatnonzero(change) + 1).tolist(), n]


def head_vector(letters: str, tail: tuple) -> tuple:
    """Vector before a conversation's rows, from the vector after them."""
    for letter in reversed(letters):
        tail = step_back(letter, tail)
    return tail


def fixed_head(letters: str, old_tail: tuple, old_head: tuple, tail: tuple) -> tuple:
    """The head for another tail: rerun until the vectors agree (both are relative: they differ by a constant)."""
    for letter in reversed(letters):
        if tail == old_tail:
            return old_head
        old_tail, tail = step_back(letter, old_tail), step_back(letter, tail)
    return tail


def vectors_after(letters: str, starts: list[int], tail: tuple) -> list[tuple]:
    """For each row, the vector after it."""
    out, v, ends = [END] * len(letters), tail, set(starts[1:-1])
    for i in range(len(letters) - 1, -1, -1):
        if i + 1 in ends:
            v = END
        out[i] = v
        v = step_back(letters[i], v)
    return out


def exits(letters: str, starts: list[int], tail: tuple) -> list[int]:
    """State after the block for each state at its start."""
    at = starts[-2]
    after = vectors_after(letters[at:], [0, len(letters) - at], tail)
    found = []
    for state in STATES if at == 0 else [START]:
        for letter, v in zip(letters[at:], after):
            state = step_on(letter, v, state)[3]
        found.append(state)
    return found if at == 0 else found * 4


LEGAL = {"su", "ua", "au"}


def trace_block(convs: list, initials: str, faults: str, letters: str, starts: list[int], tail: tuple, entry: int,
                goes_on: bool, comes_from: str | None):
    """(runs, edits) of a block: counts and audit of each conversation's rows here, and each row's edits.

    ``comes_from`` is the initial of the row before the block if it is of the same conversation."""
    after, edits, runs = vectors_after(letters, starts, tail), [], []
    for k, (lo, hi) in enumerate(zip(starts, starts[1:])):
        state, audit, cost = entry if k == 0 else START, [], 0
        for i in range(lo, hi):
            a, e, c, state = step_on(letters[i], after[i], state)
            audit.append(a)
            edits.append(e)
            cost += c
        if not (goes_on and hi == len(letters)):
            a, e, c = finish(state)
            audit.append(a)
            edits[-1] += e
            cost += c
        roles = ((comes_from or "") if k == 0 else "") + initials[lo:hi]
        part = faults[lo:hi]
        runs.append({"conv_id": convs[lo], "blank": part.count("b"), "duplicate": part.count("d"),
                     "truncated": part.count("t"), "illegal": sum(roles[i:i + 2] not in LEGAL for i in range(len(roles) - 1)),
                     "cost": cost, "audit": "".join(audit)})
    return runs, edits


def letters_of(initials: str, faults: str) -> str:
    return "".join("x" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initials, faults))


# ---------------------------------------------------------------- Spark

RUNS = ("array<struct<conv_id: bigint, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, "
        "cost: bigint, audit: string>>")


class Repair(NamedTuple):
    """``turns``: (pos, block, at, conv_id, turn, role, text) in order; ``blocks``: per block the
    traced runs and edits of its rows."""

    turns: DataFrame
    blocks: DataFrame


def sorted_turns(conversations: DataFrame, rows: int, *, key: str, turn: str, role: str, text: str) -> DataFrame:
    """All rows in order, written; ``pos`` grows along the order, ``block`` and ``at`` are its parts."""
    if rows & (rows - 1) or not 0 < rows <= 1 << 32:
        raise ValueError("rows of a block: a power of two")
    shift = rows.bit_length() - 1
    given = plain(conversations, conv_id=F.col(f"`{key}`").cast("bigint"), turn=F.col(f"`{turn}`").cast("bigint"),
                  role=F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")),
                  text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")))
    # the last key deals equal rows to several ranges; the rows being equal, their order doesn't matter
    order = ["conv_id", "turn", "role", "text_md5", "given"]
    ranged = (given.withColumns({"text_md5": F.md5(F.col("text").cast("binary")), "given": F.monotonically_increasing_id()})
              .repartitionByRange(*order).sortWithinPartitions(*order))
    numbered = ranged.withColumn("pos", F.monotonically_increasing_id()).drop("given")
    return shared_table(numbered.withColumns({"block": F.shiftright("pos", shift),
                                              "at": F.col("pos").bitwiseAND(rows - 1).cast("int")}), "repair-turns")


def _faulty(turns: DataFrame) -> DataFrame:
    """Each row's role initial and first fault (b, d, t or -)."""
    seen = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = turns.select("pos", "block", "at", "conv_id", "role", "text_md5", (seen == "").alias("blank"),
                        (~F.substring(seen, -1, 1).isin(".", "!", "?")).alias("cut"),
                        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"))
    firsts = rows.filter(~F.col("blank")).groupBy("conv_id", "role", "text_md5").agg(F.min("pos").alias("pos"))
    fault = (F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("cut"), "t").otherwise("-"))
    return (rows.join(firsts.select("pos", F.lit(True).alias("first")), "pos", "left")
            .select("block", "at", "conv_id", "initial", fault.alias("fault")))


def _numbered(blocks: DataFrame) -> DataFrame:
    """``b``: consecutive numbers of the blocks.  A block's number is its range's number and its place
    there; only the ranges' counts (one row per task of the sort) meet in one task."""
    from pyspark.sql import Window

    of_task = F.shiftright("first_pos", 33)
    counts = blocks.groupBy(of_task.alias("task")).agg(F.count("*").alias("n"), F.min("block").alias("first_block"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("task", (F.coalesce(before, F.lit(0)) - F.col("first_block")).alias("less"))
    return blocks.withColumn("task", of_task).join(F.broadcast(starts), "task").withColumn("b", F.col("block") + F.col("less")).drop("task", "less", "first_pos")


def _blocks(turns: DataFrame, rows: int) -> DataFrame:
    """One row per block: b, block, convs, initials, faults, goes_on, comes_from."""
    shift = rows.bit_length() - 1
    gathered = _faulty(turns).groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("at", "conv_id", "initial", "fault"))).alias("r"))
    text = lambda f: F.array_join(F.transform("r", lambda x: x[f]), "")
    flat = gathered.select("block", F.shiftleft("block", shift).alias("first_pos"), F.col("r.conv_id").alias("convs"),
                           text("initial").alias("initials"), text("fault").alias("faults"))
    blocks = shared_table(_numbered(flat), "repair-blocks")
    ends = blocks.select("b", F.col("convs")[0].alias("head"), F.element_at("convs", -1).alias("last"),
                         F.substring("initials", -1, 1).alias("last_initial"))
    follows = ends.alias("x").join(ends.alias("y"), (F.col("x.b") + 1 == F.col("y.b")) & F.col("x.last").eqNullSafe(F.col("y.head")))
    cut = shared_table(follows.select(F.col("x.b").alias("b"), F.col("x.last_initial").alias("comes_from")), "repair-cuts")
    linked = (blocks.join(cut.select("b", F.lit(True).alias("goes_on")), "b", "left")
              .join(cut.select((F.col("b") + 1).alias("b"), "comes_from"), "b", "left"))
    return shared_table(linked.withColumn("goes_on", F.coalesce("goes_on", F.lit(False))), "repair-linked")


def _per_block(df: DataFrame, fn, fields: str, names: list[str]) -> DataFrame:
    """``fn(row as dict, convs as an Arrow array)`` to a dict, for each block."""

    def run(batches):
        for b in batches:
            convs = b.column(names.index("convs"))
            rows = b.select([n for n in names if n != "convs"]).to_pylist()
            for i, r in enumerate(rows):
                yield pa.RecordBatch.from_pylist([fn(r, convs[i].values)], schema=schema)

    schema = _schema(fields)
    return df.select(*names).mapInArrow(run, fields)


def _stitched(blocks: DataFrame) -> DataFrame:
    """(b, tail): the true vector after each block, up to a constant.  See the module's step 1."""
    lone = "b bigint, tail array<int>, head array<int>"
    names = ["b", "convs", "initials", "faults"]

    def speculate(r, convs):
        starts = run_starts(convs)
        letters = letters_of(r["initials"], r["faults"])
        head = head_vector(letters[:starts[1]], END)  # the first conversation's rows give the head
        return {"b": r["b"], "tail": list(END), "head": list(head)}

    def rerun(r, convs):
        starts, tail = run_starts(convs), tuple(r["incoming"])
        head = tuple(r["head"])
        if len(starts) == 2:
            head = fixed_head(letters_of(r["initials"], r["faults"]), tuple(r["tail"]), head, tail)
        return {"b": r["b"], "tail": list(tail), "head": list(head)}

    state = shared_table(_per_block(blocks, speculate, lone, names), "repair-pass")
    on = blocks.filter("goes_on").select("b")
    while True:
        incoming = on.join(state.select((F.col("b") - 1).alias("b"), F.col("head").alias("incoming")), "b")
        pending = shared_table(state.join(incoming, "b").filter(F.col("tail") != F.col("incoming")), "repair-pending")
        if pending.isEmpty():
            return state.select("b", "tail")
        again = _per_block(blocks.join(pending, "b"), rerun, lone, [*names, "tail", "head", "incoming"])
        state = shared_table(state.join(pending.select("b"), "b", "left_anti").unionByName(again), "repair-pass")


def _entries(blocks: DataFrame) -> DataFrame:
    """(b, entry): the state in which the trace enters each block, by pointer jumping over the blocks' exits."""

    def leave(r, convs):
        return {"b": r["b"], "exits": exits(letters_of(r["initials"], r["faults"]), run_starts(convs), tuple(r["tail"]))}

    left = shared_table(_per_block(blocks, leave, "b bigint, exits array<int>", ["b", "convs", "initials", "faults", "tail"]), "repair-exits")
    cut = blocks.filter(F.col("comes_from").isNotNull()).select("b")
    fresh = blocks.filter(F.col("comes_from").isNull()).select("b", F.lit(None).cast("bigint").alias("src"), F.array(*[F.lit(START)] * 4).alias("m"))
    # entry(b) = m[entry(src)]; a constant m needs no source
    settled = F.size(F.array_distinct("m")) == 1
    hop = left.select((F.col("b") + 1).alias("b"), F.col("b").alias("src"), F.col("exits").alias("m"))
    known = fresh.unionByName(cut.join(hop, "b"))
    while True:
        known = shared_table(known.withColumn("src", F.when(~settled, F.col("src"))), "repair-entries")
        if known.filter(F.col("src").isNotNull()).isEmpty():
            return known.select("b", F.col("m")[0].alias("entry"))
        source = known.select(F.col("b").alias("src"), F.col("src").alias("src2"), F.col("m").alias("m2"))
        known = known.join(source, "src", "left").select(
            "b", F.col("src2").alias("src"),
            F.when(F.col("m2").isNull(), F.col("m")).otherwise(F.transform("m2", lambda s: F.get("m", s))).alias("m"))


def repair(conversations: DataFrame, rows: int = BLOCK_ROWS, *, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> Repair:
    turns = sorted_turns(conversations, rows, key=key, turn=turn, role=role, text=text)
    linked = _blocks(turns, rows)
    stitched = shared_table(linked.join(_stitched(linked), "b"), "repair-stitched")
    ready = stitched.join(_entries(stitched), "b")

    def trace(r, convs):
        starts, goes_on = run_starts(convs), r["goes_on"]
        runs, edits = trace_block(convs.to_pylist(), r["initials"], r["faults"], letters_of(r["initials"], r["faults"]),
                                  starts, tuple(r["tail"]), r["entry"], goes_on, r["comes_from"])
        return {"b": r["b"], "block": r["block"], "runs": runs, "edits": edits,
                "head_cut": starts[1] if r["comes_from"] is not None else 0,
                "tail_cut": starts[-2] if goes_on else starts[-1]}

    fields = f"b bigint, block bigint, runs {RUNS}, edits array<string>, head_cut int, tail_cut int"
    names = ["b", "block", "convs", "initials", "faults", "tail", "entry", "goes_on", "comes_from"]
    return Repair(turns, shared_table(_per_block(ready, trace, fields, names), "repair-traced"))


def _replay(batches):
    """Rows of sorted (block's edits, then its turns) as repaired rows, one turn at a time."""
    edits, head_cut, tail_cut = [], 0, 0
    for b in batches:
        for r in b.to_pylist():
            if r["edits"] is not None:
                edits, head_cut, tail_cut = r["edits"], r["head_cut"], r["tail_cut"]
                continue
            cut = r["at"] < head_cut or r["at"] >= tail_cut
            for sub, e in enumerate(edits[r["at"]]):
                if e != "D":
                    role = r["role"] if e == "K" else "user" if e in "uU" else "assistant"
                    yield {"conv_id": r["conv_id"], "pos": r["pos"], "sub": sub, "role": role,
                           "text": r["text"] if e in "Kua" else "", "cut": cut}


def _with_edits(done: Repair) -> DataFrame:
    """Turns and edits of a block in one partition, the edits first: one shuffle of the texts, no join."""
    turns = done.turns.select("block", "at", "pos", "conv_id", "role", "text")
    edits = done.blocks.select("block", F.lit(-1).alias("at"), "edits", "head_cut", "tail_cut")
    return edits.unionByName(turns, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "at")


def _schema(fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(fields))


def _out(rows, schema: pa.Schema, size: int = 1 << 22):
    """Record batches of bounded size (characters) from row dicts."""
    held, load = [], 0
    for r in rows:
        held.append(r)
        load += 64 + len(r["text"] or "")
        if load > size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, load = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def repaired_turns(done: Repair) -> DataFrame:
    """The repaired conversations: conv_id, role, text, in the order of pos (the row's place) and sub."""
    fields = "conv_id bigint, pos bigint, sub int, role string, text string"
    schema = _schema(fields)
    return _with_edits(done).mapInArrow(lambda batches: _out(_replay(batches), schema), fields)


def audits(done: Repair) -> DataFrame:
    """Per conversation with rows: counts of faults, cost and audit."""
    runs = done.blocks.select("b", F.explode("runs").alias("r")).select("b", "r.*")
    return runs.groupBy("conv_id").agg(*_sums())


COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _sums() -> list[Column]:
    pieces = F.array_sort(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("b", "audit"))))
    return [*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS], F.array_join(pieces["audit"], "").alias("audit")]


def _hashed(rows):
    """One row with ``sha`` for consecutive rows of a conversation: SHA-256 of their newline-joined role:text lines;
    rows of cut conversations pass as they are.  Holds one hash, whatever the number of rows."""
    current, h = None, None
    for r in rows:
        if r["cut"]:
            yield r
            continue
        if h is not None and r["conv_id"] == current:
            h.update(b"\n")
        else:
            if h is not None:
                yield {"conv_id": current, "text": None, "sha": h.hexdigest()}
            current, h = r["conv_id"], hashlib.sha256()
        h.update(f"{r['role']}:{r['text']}".encode())
    if h is not None:
        yield {"conv_id": current, "text": None, "sha": h.hexdigest()}


def repaired_hashes(done: Repair) -> DataFrame:
    """(conv_id, sha) of the repaired ``role:text`` lines, of conversations with any."""
    fields = "conv_id bigint, pos bigint, sub int, role string, text string, sha string"
    schema = _schema(fields)

    def whole(batches):
        return _out(_hashed(_replay(batches)), schema)

    def joined(batches):
        return _out(_hashed(r | {"cut": False} for b in batches for r in b.to_pylist()), schema)

    hashed = shared_table(_with_edits(done).mapInArrow(whole, fields), "repair-hashes")
    rest = hashed.filter(F.col("sha").isNull()).repartition("conv_id").sortWithinPartitions("conv_id", "pos", "sub")
    return hashed.filter(F.col("sha").isNotNull()).select("conv_id", "sha").unionByName(
        rest.mapInArrow(joined, fields).select("conv_id", "sha"))


EMPTY_SHA = hashlib.sha256().hexdigest()


def report(original: DataFrame, done: Repair, *, key: str = "conv_id") -> DataFrame:
    """Per conversation of ``original``: gaps, faults, cost, audit and the digest of the repaired turns.

    Everything is added up in one aggregation by conversation, so a null id needs no special case."""
    runs = done.blocks.select("b", F.explode("runs").alias("r")).select("b", "r.*")
    every = (plain(original, conv_id=F.col(f"`{key}`").cast("bigint")).distinct()
             .unionByName(runs, allowMissingColumns=True)
             .unionByName(done.turns.select("conv_id", "turn").distinct(), allowMissingColumns=True)
             .unionByName(repaired_hashes(done), allowMissingColumns=True))
    wide = lambda f: f("turn").cast("decimal(38,0)")
    gaps = (wide(F.max) - wide(F.min) + 1 - F.count("turn")).cast("bigint")
    return every.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), *_sums(), F.coalesce(F.max("sha"), F.lit(EMPTY_SHA)).alias("repaired_sha256"))


def damage(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32("key:turn") % 20: 0 drops, 1 empties the text, 2 removes its [.!?], 3 repeats the row,
    4 makes it a user's; nulls (also in the key) are one space."""
    given = plain(conversations, conv_id=F.col(f"`{key}`").cast("bigint"), turn=F.col(f"`{turn}`").cast("bigint"),
                  role=F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")),
                  text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")))
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return given.withColumn("kind", kind).filter("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("copy")).drop("copy")
