"""What several operators share: reading, words, bounded word counts, links to components."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmosaic.session import shared_dir

WHITE = re.compile(rb"[\x20\x09-\x0d]")
#: A long text is cut into words this many bytes at a time.
CHUNK_BYTES = 1 << 20
#: Words a task counts before it hands its partial counts on.
COUNTER_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(frame: DataFrame, purpose: str, rows_per_file: int = 0, options: dict[str, str] | None = None) -> DataFrame:
    """Write to the shared checkpoint folder and read again: cuts the lineage, survives lost executors."""
    spark = frame.sparkSession
    path = shared_dir(spark, purpose)
    frame.write.options(**(options or {})).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``frame`` with ``_pos``, the place from 0 of each row among those of its ``key``, in ``order`` (nulls first).

    One range shuffle and counts per partition; no key has to fit a task. ``frame`` is read twice and should
    be a written table. Rows equal in ``order`` are placed in any order.
    """
    cut = frame.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("_at", F.monotonically_increasing_id())
    kept = materialize(cut.withColumn("_part", F.shiftright("_at", 33)), "numbered")
    sizes = kept.groupBy(key, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "_part", (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_shift"))
    return kept.join(starts, [key, "_part"]).withColumn("_pos", F.col("_at") - F.col("_shift")).drop("_at", "_part", "_shift")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def keyed_hash(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))


def word_chunks(raw: bytes, size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, ``size`` bytes of it at a time; no word is cut."""
    start, end = 0, len(raw)
    while start < end:
        stop = start + size
        if stop >= end:
            stop = end
        else:
            found = WHITE.search(raw, stop)
            stop = found.start() if found else end
        words = raw[start:stop].split()
        if words:
            yield words
        start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    array = batch.column(column)
    wide = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return array.cast(wide).to_pylist()


def word_counts(docs: DataFrame, text: str, clean: Callable[[list[bytes]], list[bytes]], by: str | None = None) -> DataFrame:
    """(word, n) or (by, word, n) over all rows. Tasks send partial counts; Spark adds them up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for group, counter in parts.items():
                words = pa.array(list(counter.keys()), pa.binary()).cast(pa.string())
                counts = pa.array(list(counter.values()), pa.int64())
                columns = [words, counts]
                names = ["word", "n"]
                if by:
                    columns.insert(0, pa.array([group] * len(words), pa.string()))
                    names.insert(0, by)
                whole = pa.RecordBatch.from_arrays(columns, names=names)
                for start in range(0, len(words), 20_000):
                    yield whole.slice(start, 20_000)
            parts.clear()

        for batch in batches:
            groups = batch.column(by).to_pylist() if by else [None] * batch.num_rows
            for group, raw in zip(groups, texts_of(batch, text)):
                if not raw:
                    continue
                counter = parts.setdefault(group, Counter())
                for words in word_chunks(raw):
                    counter.update(clean(words))
            if sum(map(len, parts.values())) > COUNTER_WORDS:
                yield from flush()
        yield from flush()

    keys = [by, "word"] if by else ["word"]
    columns = [F.col(text)] + ([F.col(by).cast("string").alias(by)] if by else [])
    schema = ", ".join([f"`{by}` string"] * bool(by) + ["word string", "n bigint"])
    return docs.select(*columns).mapInArrow(count, schema).groupBy(*keys).agg(F.sum("n").alias("n"))


def local_forest(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join linked positions: ``parent`` afterwards points at the smallest position of each class."""
    while True:
        a, b = parent[left], parent[right]
        differ = a != b
        if not differ.any():
            return parent
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every end of ``links(a, b)``; a component is named by its smallest node.

    Randomised contraction: in each round every node goes over to the neighbour (or itself) with the
    smallest hash of that round, links are renamed and made distinct. A constant share of the nodes
    vanishes per round in expectation, whatever the shape, so rounds grow with the logarithm; each is
    written to the shared folder. Nulls and self-links are ignored.
    """
    kind = links.schema["a"].dataType.simpleString()
    edges = materialize(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct(), "links")
    steps: list[DataFrame] = []
    for turn in range(max_rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("node"))
        step = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min(rank("b")), F.min(rank("a")))["node"].alias("to")), "step"
        )
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("na"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("nb"))
        edges = materialize(
            edges.join(left, "a").join(right, "b").filter("na <> nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(),
            "links",
        )
    else:
        raise RuntimeError(f"components not complete after {max_rounds} rounds")
    if not steps:
        return links.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    names = steps[-1]
    for step in reversed(steps[:-1]):  # compose from the last round back to the first
        later = names.select(F.col("node").alias("to"), F.col("to").alias("end"))
        names = step.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    names = materialize(names, "names")
    least = names.groupBy("to").agg(F.min("node").alias("component"))
    return names.join(least, "to").select("node", "component")
