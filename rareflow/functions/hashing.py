"""Reproducible row hashes in [0, 2**32).

A sample or split that is a function of the row itself gives the same rows whatever the number of
partitions, the file order or a retried task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def row_hash(columns: Sequence[str | Column], seed: int = 42) -> Column:
    """32 bits of xxHash64 over the columns: cheap and generated code."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 32)


def md5_hash(key: Column, seed: int = 42) -> Column:
    """The first 32 bits of md5 over ``key:seed``, for splits that other engines must reproduce."""
    digest = F.md5(F.concat(key, F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_fraction(h: Column) -> Column:
    """The hash as a number in [0, 1)."""
    return h / F.lit(float(HASH_RANGE))
