"""Text keys as hashes, for rows that only have to meet by them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASHED = ["_k1", "_k2"]


def hashed(key: str, names: list[str] = HASHED) -> list[Column]:
    """A text key as 128 bits of hash (NULL for NULL), which is less to move and to sort."""
    there = F.col(key).isNotNull()
    return [F.when(there, F.xxhash64(key)).alias(names[0]), F.when(there, F.xxhash64(F.lit(1), F.col(key))).alias(names[1])]
