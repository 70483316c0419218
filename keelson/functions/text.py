"""Text predicates and word splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a maximal run of Unicode letters or digits. Plain \W
# would split inside accented words under some engines, so classes are named.
WORD_SEPARATOR = r"[^\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_ci(col, term: str) -> Column:
    """Case-blind substring test, ``lower(col)`` contains ``lower(term)``."""
    return F.lower(_c(col)).contains(term.lower())


def contains_cs(col, term: str) -> Column:
    """Case-sensitive substring test (SQL ``LIKE '%term%'``).

    Catalyst rewrites it to ``Contains`` and pushes ``StringContains`` into the
    Parquet scan.
    """
    return _c(col).contains(term)


def tokens(col) -> Column:
    """the distinct lower-cased words of a text, whole text, no cap."""
    return F.array_remove(F.array_distinct(F.split(F.lower(_c(col)), WORD_SEPARATOR)), "")
