"""Stable item identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_id(url: str | Column = "url", title: str | Column = "title") -> Column:
    """First 16 hex digits of SHA-256 over ``url || '|' || title`` (nulls as '')."""
    raw = F.concat(F.coalesce(_col(url), F.lit("")), F.lit("|"), F.coalesce(_col(title), F.lit("")))
    return F.substring(F.sha2(raw, 256), 1, 16)
