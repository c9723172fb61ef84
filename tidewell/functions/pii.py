"""Detect and mask personal data in whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.exprs import ColumnLike, as_col

# Patterns, in the order they are applied, and what replaces a match.
PATTERNS: tuple[tuple[str, str, str], ...] = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
    ("ipv4", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "<ip>"),
    ("long_number", r"\b[0-9][0-9 -]{9,17}[0-9]\b", "<number>"),
)


# The same matches, found without trying every character of a word as a start: a match starts with a word or where the last one ended.
EMAIL_FROM_WORD_START = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+"


def _fast(name: str, pattern: str) -> str:
    return EMAIL_FROM_WORD_START if name == "email" else pattern


def mask_pii(text: ColumnLike) -> Column:
    out = as_col(text)
    for name, pattern, replacement in PATTERNS:
        out = F.regexp_replace(out, _fast(name, pattern), replacement)
    return out


def pii_counts(text: ColumnLike) -> dict[str, Column]:
    """Matches per pattern, each counted after the earlier patterns have been masked."""
    out, counts = as_col(text), {}
    for name, pattern, replacement in PATTERNS:
        counts[f"{name}_cnt"] = F.regexp_count(out, F.lit(_fast(name, pattern))).cast("long")
        out = F.regexp_replace(out, _fast(name, pattern), replacement)
    return counts
