"""Text predicates and cleanup with Python string semantics, as Spark expressions.

Python's ``str.split()`` / ``str.strip()`` treat every Unicode whitespace code
point as a separator while Spark's ``trim`` only drops blanks, so the whitespace
class is built from the rule ``str.isspace`` and used in regular expressions that
both Java and RE2 accept (``\\x{...}`` escapes).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewatch import constants as C


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whitespace_class() -> str:
    cps = [cp for cp in range(0x10000) if chr(cp).isspace()]
    parts, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        parts.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        if cp is not None:
            start = prev = cp
    return "[" + "".join(parts) + "]"


#: Regex character class of Python's whitespace (``str.isspace``).
PY_WHITESPACE_CLASS = _whitespace_class()
#: The same characters as a plain string (for character-set trims).
PY_WHITESPACE_CHARS = "".join(chr(cp) for cp in range(0x10000) if chr(cp).isspace())
_NON_WS = "[^" + PY_WHITESPACE_CLASS[1:]


def py_strip(c: str | Column) -> Column:
    """``str.strip()`` with Unicode whitespace (a character-set trim, no regex)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def clip(c: str | Column, n: int, strip: bool = True) -> Column:
    """Strip (optionally) and keep the first ``n`` characters (code points)."""
    x = py_strip(c) if strip else _col(c)
    return F.substring(x, 1, n)


def not_blank(c: str | Column) -> Column:
    """True when the text has a non-whitespace character (``bool(s.strip())``)."""
    return F.coalesce(_col(c).rlike(_NON_WS), F.lit(False))


def is_blank(c: str | Column) -> Column:
    return ~not_blank(c)


def words(c: str | Column, lower: bool = True) -> Column:
    """``s.lower().split()`` as an array column."""
    x = F.lower(_col(c)) if lower else _col(c)
    return F.filter(F.split(F.coalesce(x, F.lit("")), PY_WHITESPACE_CLASS + "+"), lambda w: w != "")


def relevance_pattern(terms: list[str] | None = None) -> str:
    """Case-insensitive unanchored alternation.

    ``x\\b`` becomes ``x`` followed by a non-word character or the end, and ``.``
    becomes "any character but newline"; both are Python's meanings, written so
    that Java and RE2 evaluate them the same way.
    """
    terms = C.RELEVANCE_TERMS if terms is None else terms
    out = []
    for t in terms:
        t = t.replace(".?", "[^\\n]?")
        if t.endswith("\\b"):
            t = t[:-2] + "([^\\p{L}\\p{N}_]|$)"
        out.append(t)
    return "(?i)(" + "|".join(out) + ")"


def is_relevant(*cols: str | Column, terms: list[str] | None = None) -> Column:
    """Relevance filter (P2) over the columns joined by a blank."""
    text = F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols])
    return text.rlike(relevance_pattern(terms))


def repo_path(href: str | Column) -> Column:
    """``href.strip('/')``."""
    return F.regexp_replace(_col(href), "^/+|/+$", "")


def repo_name(path: str | Column) -> Column:
    """``path.replace('/', ' / ')``."""
    return F.replace(_col(path), F.lit("/"), F.lit(" / "))


def summary_from_parts(pipeline: str | Column, downloads: str | Column, likes: str | Column) -> Column:
    """``'  |  '``-joined optional parts with thousands separators."""
    p = _col(pipeline)
    return F.concat_ws(
        "  |  ",
        F.when(F.coalesce(p, F.lit("")) != "", F.concat(F.lit("Pipeline: "), p)),
        F.concat(F.lit("Downloads: "), F.format_number(F.coalesce(_col(downloads), F.lit(0)), 0)),
        F.concat(F.lit("Likes: "), F.format_number(F.coalesce(_col(likes), F.lit(0)), 0)),
    )
