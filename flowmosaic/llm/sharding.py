"""Jump consistent hashing: keys to shards without a ring table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Multiplier of the 64-bit linear congruential generator (fixed value of the published algorithm).
LCG = np.uint64(2862933555777941757)
#: Rows of one rank bucket, on average.
BUCKET_ROWS = 2000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key. From n to n + 1 shards a key stays or moves to shard n.

    The next jump is floor((b + 1) * 2^31 / ((key >> 33) + 1)) in whole numbers.
    """
    keys = keys.astype(np.uint64, copy=True)
    shard, ahead = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        shard[live] = ahead[live]
        with np.errstate(over="ignore"):
            keys[live] = keys[live] * LCG + np.uint64(1)
        ahead[live] = ((shard[live] + 1) << 31) // ((keys[live] >> np.uint64(33)).astype(np.int64) + 1)
        live = live[ahead[live] < shards]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a stable key: jump hash of the first 64 bits of md5 of the key's text.

    A null key counts as empty text.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")

    @pandas_udf("int")
    def of(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for high, low in parts:
            keys = (high.to_numpy(np.uint64) << np.uint64(32)) | low.to_numpy(np.uint64)
            yield pd.Series(jump(keys, shards), dtype="int32")

    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    word = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
    return of(word(1), word(9))


def assign_shards(docs: DataFrame, key: str, shards: int, column: str = "shard") -> DataFrame:
    """All rows and columns with ``column`` (replaced if there). No shuffle; an empty table stays empty."""
    return docs.withColumn(column, jump_shard(F.col(key), shards))


def write_shards(docs: DataFrame, key: str, shards: int, path: str, files_per_shard: int = 1) -> None:
    """Write one folder per shard (column ``shard``); rows of a shard are dealt to its files by hash."""
    placed = assign_shards(docs, key, shards)
    part = F.pmod(F.xxhash64(F.lit("file"), F.col(key)), F.lit(files_per_shard))
    placed.repartition(shards * files_per_shard, "shard", part).write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_slots(light: DataFrame, group: str, order: list[str], n_rows: int) -> DataFrame:
    """Each row's gapless place from 0 in its ``group``, without one task per group.

    Equal rows are counted first. Hash buckets (their number grows with ``n_rows``) of a group get a
    base from the sizes of the buckets before them; places inside a bucket follow a window.
    """
    cols = light.columns
    buckets = max(1, n_rows // BUCKET_ROWS)
    rows = light.groupBy(*cols).agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    sizes = rows.groupBy(group, "_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(group, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(bases, [group, "_bucket"])
        .withColumn("_first", F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .select(*cols, F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)).alias("slot"))
    )


def shard_digest(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Null text: size 1 and the checksum of no bytes. Repeated rows share shard and size and get slots of
    their own. The key alone decides, so equal texts of different documents may part.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    light = assign_shards(light, "doc_id", shards)
    light = assign_shards(light, "doc_id", shards + 1, "grown_shard")
    placed = shard_slots(light, "shard", ["doc_id", "size", "text_crc32", "grown_shard"], docs.count())
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
