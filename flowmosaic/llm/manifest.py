"""Merkle manifest of a dataset: one tree per language over its documents, one tree over the languages.

Nodes live in blocks: a block is an aligned subtree of ``HEIGHT`` levels of edges, stored as one byte
string in van Emde Boas order (a tree is cut at half its height, the upper half is laid out first, then
each lower subtree, all by the same rule). The roots of the blocks are the leaves of the next layer of
blocks, until every tree has come down to one root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import fold, materialize, numbered

#: Children of a node.
ARITY = 8
#: Levels of edges in a block: up to 512 leaves and 585 nodes, some 19 kB of digests.
HEIGHT = 3
BLOCK_LEAVES = ARITY**HEIGHT
#: Blocks in one file, so that a vectorised read of a file stays near 20 MB.
BLOCKS_PER_FILE = 512
DIGEST_BYTES = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The way from a node to the root: for each level its place in the run, how many siblings it has, their digests as hex text.
PATH = "places binary, counts binary, siblings string"
BLOCK = "_key string, _block bigint, n int, levels int, root binary, nodes binary, ids array<bigint>, tampered array<binary>"


def nodes_of(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` at ``depth`` (root: 0) stand in the van Emde Boas order of a full tree."""
    place, index = np.zeros(len(index), np.int64), np.asarray(index, np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below, depth = levels - top, depth - top
        place += nodes_of(top) + index // ARITY**depth * nodes_of(below)
        index, levels = index % ARITY**depth, below
    return place


def level_sizes(n: int, levels: int) -> list[int]:
    """Nodes present at each depth over ``n`` leaves."""
    sizes = [n]
    for _ in range(levels - 1):
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes[::-1]


def plant(leaves: list[bytes], levels: int) -> bytes:
    """The nodes over some leaves in van Emde Boas order; places without a node are zero."""
    store = np.zeros((nodes_of(levels), DIGEST_BYTES), np.uint8)
    sizes = level_sizes(len(leaves), levels)
    store[address(levels, levels - 1, np.arange(len(leaves)))] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST_BYTES)
    width = ARITY * DIGEST_BYTES * 2
    for depth in range(levels - 2, -1, -1):
        text = store[address(levels, depth + 1, np.arange(sizes[depth + 1]))].tobytes().hex().encode()
        runs = [hashlib.sha256(text[i * width : (i + 1) * width]).digest() for i in range(sizes[depth])]
        store[address(levels, depth, np.arange(sizes[depth]))] = np.frombuffer(b"".join(runs), np.uint8).reshape(-1, DIGEST_BYTES)
    return store.tobytes()


def paths_down(nodes: bytes, n: int, levels: int, above: tuple[bytes, bytes, str]) -> list[tuple[bytes, bytes, str]]:
    """The path of every leaf of a block; ``above`` is the path of the block's root."""
    store = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST_BYTES)
    sizes, paths = level_sizes(n, levels), [above]
    for depth in range(1, levels):
        text = store[address(levels, depth, np.arange(sizes[depth]))].tobytes().hex()
        digests = [text[i : i + 64] for i in range(0, len(text), 64)]
        below = []
        for i in range(sizes[depth]):
            start, up = i - i % ARITY, paths[i // ARITY]
            others = digests[start:i] + digests[i + 1 : start + ARITY]
            below.append((bytes([i - start]) + up[0], bytes([len(others)]) + up[1], "".join(others) + up[2]))
        paths = below
    return paths


def fold_path(digest: str, places: bytes, counts: bytes, siblings: str) -> str:
    """The root that a leaf and its siblings give."""
    at = 0
    for place, count in zip(places, counts):
        run = siblings[at : at + 64 * count]
        digest = hashlib.sha256((run[: 64 * place] + digest + run[64 * place :]).encode()).hexdigest()
        at += 64 * count
    return digest


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(_key, _id, _leaf, _tampered) of every row; _tampered is null where nothing is tampered with."""
    head = F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")])
    digest = lambda text: F.unhex(F.sha2(F.concat(head, field(text)).cast("binary"), 256))
    hit = F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) == 0)
    return docs.select(
        F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string"))).alias("_key"),
        F.col("doc_id").cast("bigint").alias("_id"),
        digest(F.col("text")).alias("_leaf"),
        F.when(hit, digest(F.translate(F.col("text"), UPPER, LOWER))).alias("_tampered"),
    )


def plant_block(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("_pos")
    key, block, n = rows.column("_key")[0].as_py(), rows.column("_block")[0].as_py(), rows.num_rows
    levels = HEIGHT + 1
    if block == 0:  # a block that is not full and has none before it is a whole tree
        levels = 1
        while ARITY ** (levels - 1) < n:
            levels += 1
    nodes = plant(rows.column("_leaf").to_pylist(), levels)
    ids, tampered = rows.column("_id").to_pylist(), rows.column("_tampered").to_pylist()
    values = [key, block, n, levels, nodes[:DIGEST_BYTES], nodes, ids, tampered]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    names = ["_key", "_block", "n", "levels", "root", "nodes", "ids", "tampered"]
    return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


class Forest:
    """The layers of blocks over trees of leaves (_key, _pos, _leaf, _id, _tampered); trees are told apart by _key.

    ``layers`` are tables of blocks, ``tops`` the (_key, root) of the trees whose last block is in that layer.
    """

    def __init__(self, leaves: DataFrame):
        self.layers: list[DataFrame] = []
        self.tops: list[DataFrame] = []
        while True:
            placed = leaves.withColumn("_block", F.floor(F.col("_pos") / BLOCK_LEAVES).cast("bigint"))
            blocks = placed.groupBy("_key", "_block").applyInArrow(plant_block, BLOCK)
            blocks = materialize(blocks, "blocks", rows_per_file=BLOCKS_PER_FILE)
            higher = materialize(blocks.filter("_block > 0").select("_key").distinct(), "higher")
            roots = blocks.select("_key", F.col("_block").alias("_pos"), F.col("root").alias("_leaf"))
            self.layers.append(blocks)
            self.tops.append(roots.join(higher, "_key", "left_anti").select("_key", F.col("_leaf").alias("root")))
            if higher.isEmpty():
                break
            none = [F.lit(None).cast("bigint").alias("_id"), F.lit(None).cast("binary").alias("_tampered")]
            leaves = roots.join(higher, "_key").select("*", *none)

    def roots(self) -> DataFrame:
        out = self.tops[0]
        for more in self.tops[1:]:
            out = out.unionByName(more)
        return out

    def leaf_paths(self, above: DataFrame) -> DataFrame:
        """Blocks of the lowest layer with their root's path and the columns of ``above(_key, path.., ...)``."""
        extra = [c for c in above.columns if c not in ("_key", "places", "counts", "siblings")]
        kinds = {f.name: f.dataType.simpleString() for f in above.schema.fields}
        schema = f"_key string, _pos bigint, {PATH}" + "".join(f", {c} {kinds[c]}" for c in extra)

        def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    down = paths_down(row["nodes"], row["n"], row["levels"], (row["places"], row["counts"], row["siblings"]))
                    first = row["_block"] * BLOCK_LEAVES
                    columns = [pa.array([row["_key"]] * len(down), pa.string()), pa.array(range(first, first + len(down)), pa.int64())]
                    columns += [pa.array(c, k) for c, k in zip(zip(*down), (pa.binary(), pa.binary(), pa.string()))]
                    columns += [pa.array([row[c]] * len(down), batch.schema.field(c).type) for c in extra]
                    yield pa.RecordBatch.from_arrays(columns, names=["_key", "_pos", "places", "counts", "siblings", *extra])

        found: DataFrame | None = None  # (_key, _pos, path) of the blocks of the layer at hand
        for depth in range(len(self.layers) - 1, -1, -1):
            ended = above.join(self.tops[depth].select("_key"), "_key").withColumn("_pos", F.lit(0).cast("bigint"))
            known = ended if found is None else ended.unionByName(found)
            blocks = self.layers[depth].join(known.withColumnRenamed("_pos", "_block"), ["_key", "_block"])
            if depth == 0:
                return blocks
            found = blocks.mapInArrow(children, schema)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Rows that share a doc_id stand in the order of their leaves; equal rows are leaves of their own and
    get the same or neighbouring proofs. A null doc_id comes first in its language and is not tampered
    with; a null language is a tree of its own, before all others. An empty table gives no rows. Texts
    are hashed whole; columns other than the five hashed ones are ignored.
    """
    spark = docs.sparkSession
    forest = Forest(numbered(materialize(leaves_of(docs), "leaves"), "_key", ["_id", "_leaf"]))
    subroots = materialize(forest.roots(), "subroots")
    as_leaves = subroots.select(
        F.lit("").alias("_key"), F.col("_key").alias("_lang"), F.col("root").alias("_leaf"),
        F.lit(None).cast("bigint").alias("_id"), F.lit(None).cast("binary").alias("_tampered"),
    )
    langs = numbered(as_leaves, "_key", ["_lang"])
    top = Forest(langs)
    root = top.roots().collect()
    root_digest = bytes(root[0]["root"]) if root else None
    nothing = spark.range(1).select(F.lit("").alias("_key"), F.lit(b"").alias("places"), F.lit(b"").alias("counts"), F.lit("").alias("siblings"))
    steps = top.leaf_paths(nothing).mapInArrow(path_rows, f"_pos bigint, {PATH}")
    above = langs.select(F.col("_lang").alias("_key"), "_pos", F.col("_leaf").alias("subroot")).join(steps, "_pos").drop("_pos")
    above = materialize(above, "above")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = root_digest.hex() if root_digest else None
        for batch in batches:
            for row in batch.to_pylist():
                n, levels = row["n"], row["levels"]
                down = paths_down(row["nodes"], n, levels, (row["places"], row["counts"], row["siblings"]))
                store = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST_BYTES)
                leaves = [d.tobytes().hex() for d in store[address(levels, levels - 1, np.arange(n))]]
                folded = [fold_path(t.hex() if t else leaf, *p) for leaf, t, p in zip(leaves, row["tampered"], down)]
                columns = [
                    pa.array(row["ids"], pa.int64()), pa.array(leaves), pa.array([row["subroot"].hex()] * n), pa.array([whole] * n),
                    pa.array([hashlib.sha256(p[2].encode()).hexdigest() for p in down]), pa.array(folded), pa.array([f == whole for f in folded]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return forest.leaf_paths(above).mapInArrow(prove, schema)


def path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per leaf of each block: its position and its path."""
    for batch in batches:
        for row in batch.to_pylist():
            down = paths_down(row["nodes"], row["n"], row["levels"], (row["places"], row["counts"], row["siblings"]))
            first = row["_block"] * BLOCK_LEAVES
            columns = [pa.array(range(first, first + len(down)), pa.int64())]
            columns += [pa.array(c, k) for c, k in zip(zip(*down), (pa.binary(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_pos", "places", "counts", "siblings"])


#: The same in SQL. Levels are built one by one; a tree stands still once it has one node.
MANIFEST_SQL = """
WITH RECURSIVE docs AS (
    SELECT doc_id, lang, source, n_chars, text,
           CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
           || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
           CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(
               list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                   lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END
           ), 4294967295::BIGINT) % 3 END AS rest
    FROM documents
), leaves AS (
    SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS k,
           sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
           CASE WHEN rest = 0 THEN sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':'
               || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END) END AS tampered
    FROM docs
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY k) AS size
    FROM leaves
), nodes AS (
    SELECT k, 0 AS lvl, pos, leaf AS h, size FROM placed
    UNION ALL
    SELECT k, lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (size + 7) // 8
    FROM nodes WHERE size > 1 GROUP BY k, lvl, size, pos // 8
), subroots AS (
    SELECT k, h AS subroot, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1
), tops AS (
    SELECT 0 AS lvl, pos, subroot AS h, size FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (size + 7) // 8
    FROM tops WHERE size > 1 GROUP BY lvl, size, pos // 8
), paths AS (
    SELECT p.k, p.pos, p.leaf, p.doc_id, coalesce(p.tampered, p.leaf) AS folded, 0 AS lvl, p.pos AS place, p.size,
           '' AS proof, false AS upper
    FROM placed p
    UNION ALL
    SELECT t.k, t.pos, t.leaf, t.doc_id,
           CASE WHEN t.size = 1 THEN t.folded ELSE
               sha256(string_agg(CASE WHEN n.pos = t.place THEN t.folded ELSE n.h END, '' ORDER BY n.pos)) END,
           CASE WHEN t.size = 1 THEN 0 ELSE t.lvl + 1 END,
           CASE WHEN t.size = 1 THEN any_value(s.pos) ELSE t.place // 8 END,
           CASE WHEN t.size = 1 THEN any_value(s.size) ELSE (t.size + 7) // 8 END,
           t.proof || coalesce(string_agg(CASE WHEN t.size > 1 AND n.pos <> t.place THEN n.h END, '' ORDER BY n.pos), ''),
           t.upper OR t.size = 1
    FROM paths t
    JOIN (SELECT k, lvl, pos, h, false AS upper FROM nodes UNION ALL SELECT '', lvl, pos, h, true FROM tops) n
      ON n.upper = t.upper AND (t.upper OR n.k = t.k) AND n.lvl = t.lvl AND n.pos // 8 = t.place // 8
    JOIN subroots s ON s.k = t.k
    WHERE t.size > 1 OR NOT t.upper
    GROUP BY t.k, t.pos, t.leaf, t.doc_id, t.folded, t.lvl, t.place, t.size, t.proof, t.upper
)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root, p.folded = r.h AS verified
FROM paths p JOIN subroots s ON s.k = p.k, (SELECT h FROM tops WHERE size = 1) r
WHERE p.upper AND p.size = 1
"""
