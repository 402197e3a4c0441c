"""Deterministic randomness: every draw is a function of a row key and a seed.

An md5 hex digest sorts and compares the same way in every engine and under
every partitioning, so samples, splits and synthetic rows can be reproduced
and checked.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(keys: str | Sequence[str], seed: int | str) -> Column:
    """md5 of ``key1:key2:...:seed`` in lower-case hex."""
    names = [keys] if isinstance(keys, str) else list(keys)
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in names]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def below_fraction(digest: Column, fraction: float) -> Column:
    """True for the share ``fraction`` of digests, decided on the first 32 bits."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction {fraction} is outside [0, 1]")
    if fraction == 1.0:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(f"{floor(fraction * 2**32):08x}")


def digest_integer(digest: Column, modulus: int) -> Column:
    """An integer in ``[0, modulus)`` from the first 60 bits."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(modulus)


def digest_uniform(digest: Column) -> Column:
    """A double in ``[0, 1)`` from the first 32 bits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
