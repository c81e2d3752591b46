r"""Chat formatting with a grammar round trip (DataFrame expressions only).

Grammar of a rendered conversation:

    conversation := turn*
    turn         := "### " role ": " body " </turn>" NEWLINE
    role         := "System" | "User" | "Assistant" | "=" HEX*      (other roles: hex of their UTF-8 bytes)
    body         := text, in which a backslash may escape

Control strings are the header of a turn ("### " role ": ") and its end ("</turn>").  The
parser is deterministic: it cuts at the ends, reads one header from the start of each stretch,
rejects a stretch with a second header, and unescapes the body.

A text is first rendered as it is.  The rendered turn is parsed again and compared with its source; where they
differ (the text holds a control string or something that reads as an escape) the next,
stronger escape of ``ESCAPES`` is tried, until the result is identical.  The last level always
is: it doubles every backslash and breaks every control string, and unescaping inverts it.

``loss_spans`` are (start, length) code-point ranges of the assistant bodies in the rendered text.

Defined cases: null text is an empty text, null role an empty role (the hex form of nothing); null
conv_id is a conversation of its own; turns are ordered by turn (null first), then role and text, so ties
and repeated rows have one order; an empty table gives an empty result; further columns are ignored.
A conversation is one output value, so it has to fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

END = " </turn>\n"
_ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_HEADER = "### (System|User|Assistant|=[0-9A-F]*): "
ASSISTANT = "assistant"


def _escape_all(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("### "), F.lit("##\\# "))


def _escape_ends(text: Column) -> Column:
    return F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(body: Column) -> Column:
    body = F.replace(body, F.lit("##\\# "), F.lit("### "))
    body = F.replace(body, F.lit("<\\/turn>"), F.lit("</turn>"))
    return F.replace(body, F.lit("\\\\"), F.lit("\\"))


ESCAPES = (lambda text: text, _escape_ends, _escape_all)


def role_name(role: Column) -> Column:
    name = F.concat(F.lit("="), F.hex(F.encode(role, "UTF-8")))
    for source, shown in _ROLES.items():
        name = F.when(role == source, F.lit(shown)).otherwise(name)
    return name


def _role_source(name: Column) -> Column:
    role = F.decode(F.unhex(F.substring(name, 2, 1 << 30)), "UTF-8")
    for source, shown in _ROLES.items():
        role = F.when(name == shown, F.lit(source)).otherwise(role)
    return role


def parse(rendered: Column) -> Column:
    """Array of (role, text); a stretch that isn't exactly one turn gives a null text."""
    stretches = F.split(rendered, "</turn>", -1)
    last = F.element_at(stretches, -1)

    def turn(s: Column, i: Column) -> Column:
        s = F.when(i > 0, F.regexp_replace(s, "^\n", "")).otherwise(s)
        name = F.regexp_extract(s, f"(?s)^{_HEADER}", 1)
        body = F.regexp_extract(s, f"(?s)^{_HEADER}(.*) $", 2)
        one = F.regexp_like(s, F.lit(f"(?s)^{_HEADER}.* $")) & (F.regexp_count(s, F.lit(_HEADER)) == 1)
        return F.struct(_role_source(name).alias("role"), F.when(one, unescape(body)).alias("text"))

    inner = F.slice(stretches, F.lit(1), F.size(stretches) - 1)
    # what follows the last end is only the newline
    return F.when((last == "\n") | (rendered == ""), F.transform(inner, turn))


def _render(name: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), name, F.lit(": "), body, F.lit(END))


def render_turns(turns: DataFrame) -> DataFrame:
    """Adds ``body`` (the weakest escape that survives the round trip) to (role, text) rows."""
    name = role_name(F.col("role"))
    source = F.array(F.struct(F.col("role"), F.col("text")))
    body = ESCAPES[-1](F.col("text"))
    for escape in reversed(ESCAPES[:-1]):
        tried = escape(F.col("text"))
        body = F.when(parse(_render(name, tried)) == source, tried).otherwise(body)
    return turns.withColumn("name", name).withColumn("body", body)


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans: one row per conversation."""
    rows = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rendered = render_turns(rows).withColumn("turn_text", _render(F.col("name"), F.col("body")))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.length("name") + 6  # "### " and ": "
    placed = rendered.select(
        "conv_id", F.row_number().over(in_order).alias("nth"), "turn_text",
        F.when(F.col("role") == ASSISTANT, F.struct(
            (F.coalesce(F.sum(F.length("turn_text")).over(before), F.lit(0)) + head).cast("bigint").alias("start"),
            F.length("body").cast("bigint").alias("length"))).alias("span"))
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("nth", "turn_text", "span"))).alias("turns"))
    return joined.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.concat_ws("", F.col("turns.turn_text")).alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses the output alone: conv_id, turns (role, text) and loss_text, the unescaped
    text under the mask."""
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", parse(F.col("formatted")).alias("turns"), F.concat_ws("", masked).alias("loss_text"),
                            F.length("formatted").cast("bigint").alias("formatted_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back."""
    back = read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(F.concat_ws("", lines), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")
