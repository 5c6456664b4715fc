"""Deterministic hash-based draws.

``hash_fraction`` maps a key to [0, 1) from the first 32 bits of
``md5(salt || key)``: the same number on every engine that has md5 and hex
parsing, independent of partitioning, task retries or executor loss (unlike
``rand()``). It drives reproducible sampling and segment assignment.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = float(2 ** 32)


def _hex32(salt: str, key) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(F.concat(F.lit(salt), col.cast("string"))), 1, 8)


def hash_fraction(key, salt: str = "") -> Column:
    """Uniform value in [0, 1) from md5(salt || key)."""
    return F.conv(_hex32(salt, key), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def weighted_bucket(key, labels: list[str], weights: list[float], salt: str) -> Column:
    """Label whose cumulative-weight interval holds ``hash_fraction(key, salt)``."""
    if len(labels) != len(weights) or not labels:
        raise ValueError("labels and weights must have the same non-zero length")
    total = float(sum(weights))
    bounds = [w / total for w in accumulate(weights)]
    u = hash_fraction(key, salt)
    out = F.lit(labels[-1])
    for label, b in reversed(list(zip(labels[:-1], bounds[:-1]))):
        out = F.when(u < F.lit(b), F.lit(label)).otherwise(out)
    return out


def uniform_choice(key, labels: list[str], salt: str) -> Column:
    """Equal-weight choice among ``labels``."""
    return weighted_bucket(key, labels, [1.0] * len(labels), salt)
