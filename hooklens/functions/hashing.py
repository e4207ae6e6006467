"""Draws that depend on the row id only, so that a recomputed task repeats them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

SEED = 42


def digest(key: Column, salt: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), key.cast("string")))


def draw(key: Column, salt: str, seed: int = SEED) -> Column:
    """Uniform integer in [0, 2^32)."""
    return F.conv(F.substring(digest(key, salt, seed), 1, 8), 16, 10).cast("bigint")


def fraction(key: Column, salt: str, seed: int = SEED) -> Column:
    """Uniform double in [0, 1) with 52 random bits."""
    bits = F.conv(F.substring(digest(key, salt, seed), 1, 13), 16, 10).cast("bigint")
    return bits / F.lit(float(2**52))


def permille(key: Column, salt: str, seed: int = SEED) -> Column:
    """Uniform integer in [0, 1000)."""
    return draw(key, salt, seed) % 1000


def pick(values: Sequence[str], key: Column, salt: str, seed: int = SEED) -> Column:
    """One of the values, drawn uniformly."""
    index = (draw(key, salt, seed) % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)
