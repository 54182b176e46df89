"""SimHash near-duplicates: fingerprints, and a Gray-ordered hierarchical index that links them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import connected_components, local_forest, materialize, texts_of, word_chunks

SHINGLE = 3
SEED = 42
#: Fingerprints of a leaf block, and about how many stand under one upper node.
LEAF = 64
NODE = 1024
#: At most so many upper nodes are broadcast; beyond that each holds more fingerprints.
MAX_NODES = 4096
#: Cells of one comparison matrix in a task.
CELLS = 1 << 21


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits, lowest first, is set."""
    sums = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    return sums


def fingerprint(raw: bytes | None) -> int:
    """Unsigned SimHash of the lower-cased 3-word shingles; 0 for null or no words."""
    digest = xxhash.xxh64_intdigest
    sums, total, tail, seen = np.zeros(64, np.int64), 0, [], 0
    for words in word_chunks(raw.lower()) if raw else ():
        seen += len(words)
        words = tail + words
        if len(words) >= SHINGLE:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[: -SHINGLE])).tolist()
            stops = (ends[SHINGLE - 1 :] - 1).tolist()
            hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, len(stops))
            sums += bit_sums(hashes)
            total += len(stops)
        tail = words[-(SHINGLE - 1) :]
    if not total:
        return digest(b" ".join(tail), SEED) if seen else 0
    return int(sum(1 << bit for bit in np.flatnonzero(2 * sums > total).tolist()))


def with_fingerprints(docs: DataFrame, text: str = "text", column: str = "_fingerprint") -> DataFrame:
    """All columns but the text, plus ``column`` as a signed 64-bit number."""
    kept = [f for f in docs.schema if f.name not in (text, column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(map(fingerprint, texts_of(batch, text)), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(prints)], names=[f.name for f in kept] + [column])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{column} bigint"])
    return docs.mapInArrow(run, schema)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence, where neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def pattern_of(codes: np.ndarray) -> tuple[int, int]:
    """(mask, pattern): the bits that all codes of a group share, and their values."""
    shared = ~(np.bitwise_or.reduce(codes) ^ np.bitwise_and.reduce(codes))
    return int(shared), int(codes[0] & shared)


def within(codes: np.ndarray, masks: np.ndarray, patterns: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, node) positions where the shared bits of a node differ in ``most`` places or fewer."""
    return np.nonzero(np.bitwise_count((codes[:, None] ^ patterns[None, :]) & masks[None, :]) <= most)


def upper_nodes(prints: DataFrame) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """Cut distinct fingerprints, in Gray order, into upper nodes.

    Returns (node, fp) rows and the list of (node, mask, pattern), at most about ``MAX_NODES`` long.
    """
    n = prints.count()
    parts = max(1, min(MAX_NODES, n // NODE))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            codes = rows["fp"].to_numpy(np.int64).view(np.uint64)
            # signed order of the flipped rank is unsigned order of the rank
            yield pd.DataFrame({"fp": rows["fp"], "place": (gray_rank(codes) ^ np.uint64(1 << 63)).view(np.int64)})

    placed = prints.mapInPandas(rank, "fp bigint, place bigint").repartitionByRange(parts, "place")
    members = materialize(placed.select(F.spark_partition_id().alias("node"), "fp"), "nodes")

    def shared(frame: DataFrame) -> list:
        signed = F.bit_or("fp").alias("any"), F.bit_and("fp").alias("all")
        return frame.groupBy("node").agg(*signed).orderBy("node").collect()

    index = []
    for row in shared(members):
        mask = ~(row["any"] ^ row["all"]) & (2**64 - 1)
        index.append((row["node"], mask, row["all"] & mask))
    return members, index


def near_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that join all fingerprints within ``distance`` bits of each other into the same classes.

    Every fingerprint visits its own upper node and those later in Gray order whose shared bits differ
    in ``distance`` places or fewer, and there the leaf blocks that pass the same test on the bits
    they share. Fingerprints that pass are compared. A task hands on one link per fingerprint and class
    that it found, not all pairs, so a dense group costs no more rows than it has members.
    """
    members, index = upper_nodes(prints)
    upper = prints.sparkSession.sparkContext.broadcast(
        tuple(np.array([row[i] for row in index], kind) for i, kind in enumerate((np.int64, np.uint64, np.uint64)))
    )

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, masks, patterns = upper.value
        step = max(1, CELLS // max(1, len(nodes)))
        for rows in batches:
            for start in range(0, len(rows), step):
                part = rows.iloc[start : start + step]
                codes, own = part["fp"].to_numpy(np.int64), part["node"].to_numpy(np.int64)
                i, j = within(codes.view(np.uint64), masks, patterns, distance)
                later = nodes[j] >= own[i]
                i, j = i[later], j[later]
                yield pd.DataFrame({"node": nodes[j].astype(np.int32), "fp": codes[i], "member": nodes[j] == own[i]})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        codes, member = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["member"].to_numpy(bool)
        order = np.argsort(gray_rank(codes), kind="stable")
        codes, member = codes[order], member[order]
        inside = np.flatnonzero(member)
        edges = range(0, len(inside), LEAF)
        masks, patterns = (np.array(x, np.uint64) for x in zip(*[pattern_of(codes[inside[s : s + LEAF]]) for s in edges]))
        padded = np.full(len(edges) * LEAF, -1)
        padded[: len(inside)] = inside
        padded = padded.reshape(-1, LEAF)
        parent = np.arange(len(codes))
        step = max(1, CELLS // (8 * len(inside) + 1))
        for start in range(0, len(codes), step):
            i, j = within(codes[start : start + step], masks, patterns, distance)
            for at in range(0, len(i), CELLS // LEAF):
                who, block = i[at : at + CELLS // LEAF] + start, padded[j[at : at + CELLS // LEAF]]
                near = (np.bitwise_count(codes[who][:, None] ^ codes[block]) <= distance) & (block >= 0)
                a, b = np.nonzero(near)
                parent = local_forest(parent, who[a], block[a, b])
        moved = np.flatnonzero(parent != np.arange(len(parent)))
        return pd.DataFrame({"a": codes[parent[moved]].view(np.int64), "b": codes[moved].view(np.int64)})

    return (
        members.mapInPandas(visits, "node int, fp bigint, member boolean")
        .groupBy("node").applyInPandas(compare, "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 2) -> DataFrame:
    """All columns but the text, plus ``fingerprint`` (hex) and ``component_id``, replaced if they exist.

    Equal fingerprints are one node. ``component_id`` is the smallest key reachable over links of
    ``distance`` bits or fewer (nulls are passed over). Texts that are null or without words have
    fingerprint zero and link like any other; repeated rows come back as often as they came.
    """
    dropped = [c for c in ("fingerprint", "component_id") if c in docs.columns]
    rows = materialize(with_fingerprints(docs.drop(*dropped), text), "fingerprints")
    prints = materialize(rows.groupBy(F.col("_fingerprint").alias("fp")).agg(F.min(key).alias("_least")), "prints")
    classes = connected_components(near_links(prints.select("fp"), distance))
    named = prints.join(classes, prints["fp"] == classes["node"], "left").select(
        F.col("fp").alias("_fingerprint"), "_least", F.coalesce("component", "fp").alias("_class")
    )
    least = named.groupBy("_class").agg(F.min("_least").alias("component_id"))
    lookup = named.join(least, "_class").select("_fingerprint", "component_id")
    return (
        rows.join(lookup, "_fingerprint")
        .withColumn("fingerprint", F.lower(F.lpad(F.hex("_fingerprint"), 16, "0")))
        .drop("_fingerprint")
    )
