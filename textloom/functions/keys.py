"""Deterministic pseudo-random keys: the same on a retry, in any partitioning, in any engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from textloom.fixed_values import SEED


def order_key(key: Column | str, seed: int = SEED) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(col.cast("string"), F.lit(f":{seed}")))


def choose(key: Column | str, options: int | Column, seed: int = SEED, salt: str = "") -> Column:
    """A number in [0, options) drawn from the key."""
    col = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(col.cast("string"), F.lit(f":{seed}:{salt}")))
    n = options if isinstance(options, Column) else F.lit(options)
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), n).cast("int")
