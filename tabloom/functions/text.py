"""Text helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def shorten(column: Column, max_length: int = 12) -> Column:
    """Labels longer than ``max_length`` become a prefix and ``...``."""
    cut = F.concat(F.substring(column, 1, max_length - 3), F.lit("..."))
    return F.when(F.length(column) > max_length, cut).otherwise(column)


def place_parts(column: Column) -> tuple[Column, Column]:
    """City and state of ``"City, ST"``; both null when there is no comma."""
    pieces = F.split(column, ",", 2)
    whole = F.size(pieces) == 2
    return F.when(whole, F.trim(pieces[0])), F.when(whole, F.trim(pieces[1]))


def recode(column: Column, mapping: Mapping, *, strict: bool = False) -> Column:
    """Replace values by a small fixed mapping; others stay, or become null if ``strict``."""
    if not mapping:
        return F.lit(None) if strict else column
    pairs = iter(mapping.items())
    old, new = next(pairs)
    chain = F.when(column == F.lit(old), F.lit(new))
    for old, new in pairs:
        chain = chain.when(column == F.lit(old), F.lit(new))
    return chain if strict else chain.otherwise(column)
