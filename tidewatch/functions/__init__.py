"""Column-level building blocks (all JVM-side Spark SQL expressions)."""

from tidewatch.functions.ids import item_id
from tidewatch.functions.text import (
    PY_WHITESPACE_CLASS, clip, is_blank, not_blank, py_strip, relevance_pattern, is_relevant,
    repo_path, repo_name, summary_from_parts, words,
)
from tidewatch.functions.counters import parse_counter, counter_or_zero, COUNTER_PATTERN
from tidewatch.functions.ngrams import char_wb_ngrams, explode_ngrams
from tidewatch.functions.dates import parse_published

__all__ = [
    "item_id", "PY_WHITESPACE_CLASS", "clip", "is_blank", "not_blank", "py_strip",
    "relevance_pattern", "is_relevant", "repo_path", "repo_name", "summary_from_parts", "words",
    "parse_counter", "counter_or_zero", "COUNTER_PATTERN", "char_wb_ngrams",
]
