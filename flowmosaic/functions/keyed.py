"""Randomness as a function of the row's key.

A draw depends only on (seed, purpose, key), so it is the same on every retry, for every
partitioning and after every repartition, and any SQL engine with md5 reproduces it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 4294967296.0  # 2^32: one md5 digest yields four 32-bit words


def keyed_digest(seed: int, purpose: str, *key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[k.cast("string") for k in key]))


def keyed_prefix(seed: int, purpose: str, *key: Column) -> Column:
    """The hashed text up to and including the separator before the last key part."""
    return F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[k.cast("string") for k in key], F.lit(""))


def digest_uniform(digest: Column, word: int | Column = 0) -> Column:
    """One of the digest's four words as a double in [0, 1)."""
    start = (word if isinstance(word, Column) else F.lit(word)) * 8 + 1
    return F.conv(F.substr(digest, start, F.lit(8)), 16, 10).cast("bigint") / F.lit(WORD)


def keyed_uniform(seed: int, purpose: str, *key: Column) -> Column:
    return digest_uniform(keyed_digest(seed, purpose, *key))


def keyed_fine_uniform(seed: int, purpose: str, *key: Column) -> Column:
    """A draw of 52 bits, for picking among more rows than one word can tell apart."""
    leading = F.substr(keyed_digest(seed, purpose, *key), F.lit(1), F.lit(13))
    return F.conv(leading, 16, 10).cast("bigint") / F.lit(4503599627370496.0)


def jitter_factor(u: Column, limit: Column) -> Column:
    """Uniform u -> factor in [1 - limit%, 1 + limit%)."""
    return 1.0 + (2.0 * u - 1.0) * limit / 100.0
