"""Sending a short list to every task, after its length and size were checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.joins import is_small

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20


def short_list(rows: DataFrame, limit: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows``, a written table, marked to be broadcast if it has at most ``limit`` rows and ``max_bytes``; a larger one is joined by shuffle."""
    return F.broadcast(rows) if is_small(rows, limit, max_bytes) else rows
