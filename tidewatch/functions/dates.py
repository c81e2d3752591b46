"""Optional parsing of feed timestamps (trap 12).

Feed dates are kept as raw strings; when a timestamp is wanted, RFC-822 style
values (``'Fri, 27 Feb 2026 03:16:00 GMT'``) are parsed after dropping the
weekday (Spark 4 rejects weekday names in datetime patterns); ISO-8601 values
parse directly.  Anything else gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: accepted feed date patterns ----
RFC822_PATTERNS = ["dd MMM yyyy HH:mm:ss z", "dd MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z"]


def parse_published(c: str | Column) -> Column:
    """Raw feed date string to TIMESTAMP, null when unparsable."""
    x = F.col(c) if isinstance(c, str) else c
    no_weekday = F.trim(F.regexp_replace(x, r"^\s*[A-Za-z]{3,9},\s*", ""))
    parsed = [F.try_to_timestamp(no_weekday, F.lit(p)) for p in RFC822_PATTERNS]
    iso = F.try_to_timestamp(F.trim(x))
    return F.coalesce(*parsed, iso)
