"""Row predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(*names: str) -> Column:
    return reduce(and_, (F.col(n).isNotNull() for n in names))


def not_empty(text: Column) -> Column:
    """True for non-empty text; NULL text is filtered out as well."""
    return text != ""


def contains_ignore_case(text: Column, query: str) -> Column:
    """Case-insensitive substring test; ``%``, ``_`` and quotes are plain text.

    An empty query matches nothing, as an empty search box shows nothing.
    """
    if not query:
        return F.lit(False)
    return F.contains(F.lower(text), F.lower(F.lit(query)))


def matches_pattern(text: Column, pattern: str) -> Column:
    """Regular-expression search anywhere in the text."""
    return text.rlike(pattern)


def is_missing_number(value: Column) -> Column:
    return value.isNull() | F.isnan(value.cast("double"))
