"""Hashes that give the same result in every run, process and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(*parts: Column | str) -> Column:
    """28-bit number from the md5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.col(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def hash_bucket(*parts: Column | str, buckets: int = 100) -> Column:
    return hash_number(*parts) % F.lit(buckets)


def hash_uniform(*parts: Column | str) -> Column:
    """Number in [0, 1)."""
    return hash_number(*parts) / F.lit(float(1 << 28))
