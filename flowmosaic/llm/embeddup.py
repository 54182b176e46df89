"""Embedding near-duplicates: NN-descent over a neighbour graph, refined until its audit is good."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmosaic.llm.common import connected_components, materialize


@dataclass(frozen=True)
class DescentSettings:
    threshold: float = 0.98
    neighbours: int = 12
    #: Vectors that a group of the starting graph compares with each other.
    start_block: int = 256
    starts: int = 3
    min_rounds: int = 2
    max_rounds: int = 8
    #: Share of the links of audited vectors that the graph must hold before the rounds end.
    recall: float = 0.98
    #: Below this share of all links of audited vectors the run fails.
    least_recall: float = 0.9
    #: Vectors audited against all others: this share of them (broadcast), and so many at least.
    audited_share: float = 1 / 1000
    audited: int = 512
    #: Vectors of one tile when the lists of a saturated group are enlarged to the whole group.
    tile: int = 512
    seed: int = 3


def unit_vectors(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(node, label, vec): unit vectors in double precision, one per different vector and label.

    Rows without label or with a vector that is null, empty, zero or not finite are left out. ``node``
    is a 64-bit hash of label and vector.
    """
    values = F.transform(vector, lambda x: x.cast("double"))
    largest = F.array_max(F.transform(F.col("_v"), F.abs))
    scaled = F.transform(F.col("_v"), lambda x: x / F.col("_top"))  # no overflow or underflow of squares
    norm = F.sqrt(F.aggregate(F.col("_v"), F.lit(0.0), lambda s, x: s + x * x))
    return (
        rows.filter(sound_row(vector, label)).select(key, F.col(label).alias("label"), values.alias("_v"))
        .withColumn("_top", largest).withColumn("_v", scaled)
        .withColumn("_norm", norm).select(key, "label", F.transform("_v", lambda x: x / F.col("_norm")).alias("vec"))
        .withColumn("node", F.xxhash64("label", "vec"))
    )


def stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float)


def top_pairs(nodes: np.ndarray, vectors: np.ndarray, fences: np.ndarray, keep: int) -> pd.DataFrame:
    """The ``keep`` nearest of each node behind other fences inside one group, as (node, other, sim)."""
    sims = vectors @ vectors.T
    sims[fences[:, None] == fences[None, :]] = -2
    keep = min(keep, len(nodes) - 1)
    if keep < 1:
        return pd.DataFrame({"node": nodes[:0], "other": nodes[:0], "sim": np.zeros(0)})
    best = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
    at = np.repeat(np.arange(len(nodes)), keep)
    pairs = pd.DataFrame({"node": nodes[at], "other": nodes[best.ravel()], "sim": sims[at, best.ravel()]})
    return pairs[pairs["sim"] > -2]


def start_graph(nodes: DataFrame, settings: DescentSettings) -> DataFrame:
    """Neighbours inside groups of vectors on the same side of random planes; large groups are dealt by hash.

    nodes(node, label, vec, fence): only nodes with different fences become neighbours.
    """
    n = nodes.count()
    bits = max(0, int(np.log2(max(1, n / settings.start_block))))
    parts = []
    for turn in range(settings.starts):
        seed = settings.seed + turn

        def sides(batches: Iterator[pd.DataFrame], seed: int = seed) -> Iterator[pd.DataFrame]:
            for rows in batches:
                out = rows[["node"]].copy()
                sizes = rows["vec"].map(len).to_numpy()
                side = np.zeros(len(rows), np.int64)
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    planes = np.random.default_rng(seed).standard_normal((size, bits))
                    side[at] = (stacked(rows["vec"].iloc[at]) @ planes > 0) @ (1 << np.arange(bits)) if bits else 0
                out["side"] = side
                yield out

        placed = nodes.mapInPandas(sides, "node bigint, side bigint").join(nodes, "node")
        groups = ["label", "_width", "side"]
        placed = placed.withColumn("_width", F.size("vec"))
        sizes = placed.groupBy(*groups).agg(F.ceil(F.count("*") / settings.start_block).alias("_parts"))
        dealt = placed.join(sizes, groups).withColumn("_part", F.pmod(F.xxhash64(F.lit(seed), "node"), F.col("_parts")))
        keep = settings.neighbours
        parts.append(
            dealt.select("node", "vec", "fence", *groups, "_part").groupBy(*groups, "_part")
            .applyInPandas(lambda g: top_pairs(g["node"].to_numpy(), stacked(g["vec"]), g["fence"].to_numpy(), keep), "node bigint, other bigint, sim double")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def best_of(pairs: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest different others of each node; ties by number. (node, near: array of (sim, other))"""
    found = F.struct(F.col("sim"), F.col("other"))
    return (
        pairs.groupBy("node", "other").agg(F.max("sim").alias("sim"))
        .withColumn("_r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "other")))
        .filter(F.col("_r") <= keep).groupBy("node").agg(F.collect_list(found).alias("near"))
    )


def refine(graph: DataFrame, nodes: DataFrame, settings: DescentSettings, beside: DataFrame | None = None) -> DataFrame:
    """One round: whoever stand in each other's neighbourhood (either direction) are compared.

    A neighbourhood takes part with its forward list and, of those pointing at it, as many again, drawn
    by hash; the others meet in later rounds. ``beside`` (node, other) adds known neighbours that stand
    behind the same fence: they introduce others but enter no list.
    """
    forward = graph.select("node", F.explode("near").alias("n")).select("node", F.col("n.other").alias("other"))
    draw = F.xxhash64(F.lit(settings.seed), "node", "other")
    backward = (
        forward.withColumn("_r", F.row_number().over(Window.partitionBy("other").orderBy(draw)))
        .filter(F.col("_r") <= settings.neighbours).select(F.col("other").alias("node"), F.col("node").alias("other"))
    )
    own = nodes.select("node", F.col("node").alias("other"))
    around = forward.unionByName(backward).unionByName(own)
    around = (around.unionByName(beside) if beside else around).distinct()
    floor = graph.select(F.col("node").alias("other"), F.when(F.size("near") >= settings.neighbours, F.array_min("near")["sim"]).otherwise(-2.0).alias("floor"))
    known = nodes.select(F.col("node").alias("other"), "vec", "fence").join(floor, "other", "left").fillna(-2.0, ["floor"])
    shipped = around.join(known, "other")
    blocks = F.pmod(F.xxhash64("node"), F.lit(max(1, nodes.count() // 1000)))
    keep = settings.neighbours

    def local(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable")
        centres, others = group["node"].to_numpy(), group["other"].to_numpy()
        vectors, floors, fences = stacked(group["vec"]), group["floor"].to_numpy(), group["fence"].to_numpy()
        bounds = np.flatnonzero(np.r_[True, centres[1:] != centres[:-1], True])
        found = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            sims = vectors[a:b] @ vectors[a:b].T
            sims[fences[a:b, None] == fences[None, a:b]] = -2
            i, j = np.nonzero(sims > floors[a:b, None])
            found.append((others[a:b][i], others[a:b][j], sims[i, j]))
        pairs = pd.DataFrame({c: np.concatenate([f[k] for f in found]) for k, c in enumerate(("node", "other", "sim"))})
        pairs = pairs.drop_duplicates(["node", "other"]).sort_values(["node", "sim"], ascending=[True, False])
        return pairs[pairs.groupby("node").cumcount() < keep]

    better = shipped.withColumn("_block", blocks).groupBy("_block").applyInPandas(local, "node bigint, other bigint, sim double")
    old = graph.select("node", F.explode("near").alias("n")).select("node", F.col("n.other").alias("other"), F.col("n.sim").alias("sim"))
    return best_of(old.unionByName(better), settings.neighbours)


def true_links(nodes: DataFrame, settings: DescentSettings) -> DataFrame:
    """(node, other) links of the audited vectors, found by comparing them with every vector."""
    many = max(settings.audited, int(nodes.count() * settings.audited_share))
    chosen = nodes.select("node", "label", "vec").orderBy(F.xxhash64(F.lit(settings.seed), "node")).limit(many).toPandas()
    asked = nodes.sparkSession.sparkContext.broadcast(chosen)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        probes = asked.value
        widths, kinds = probes["vec"].map(len).to_numpy(), probes["label"].to_numpy()
        for rows in batches:
            sizes, labels = rows["vec"].map(len).to_numpy(), rows["label"].to_numpy()
            for size, label in {*zip(sizes.tolist(), labels.tolist())}:
                mine, theirs = np.flatnonzero((sizes == size) & (labels == label)), np.flatnonzero((widths == size) & (kinds == label))
                if not len(theirs):
                    continue
                here = stacked(rows["vec"].iloc[mine]).T
                for start in range(0, len(theirs), settings.tile):
                    part = theirs[start : start + settings.tile]
                    i, j = np.nonzero(stacked(probes["vec"].iloc[part]) @ here >= settings.threshold)
                    a, b = probes["node"].to_numpy()[part[i]], rows["node"].to_numpy()[mine[j]]
                    yield pd.DataFrame({"node": a[a != b], "other": b[a != b]})

    return nodes.select("node", "label", "vec").mapInPandas(search, "node bigint, other bigint")


def links_of(graph: DataFrame, settings: DescentSettings) -> DataFrame:
    """(a, b) with a < b: the links in the lists, each once."""
    near = graph.select("node", F.explode("near").alias("n")).filter(F.col("n.sim") >= settings.threshold).select("node", F.col("n.other").alias("other"))
    return near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def audit(graph: DataFrame, truth: DataFrame, settings: DescentSettings) -> float | None:
    """Share of the audited vectors' links that the graph holds in either direction, or None without links.

    A vector counts at most as many links as its list can hold; the lists of saturated vectors are
    completed later, and audited in full then.
    """
    held = graph.select("node", F.explode("near").alias("n")).filter(F.col("n.sim") >= settings.threshold)
    both = held.select("node", F.col("n.other").alias("other")).unionByName(held.select(F.col("n.other").alias("node"), F.col("node").alias("other"))).distinct()
    hit = truth.join(both.withColumn("_held", F.lit(1)), ["node", "other"], "left").groupBy("node").agg(
        F.least(F.count("*"), F.lit(settings.neighbours)).alias("all"), F.least(F.count("_held"), F.lit(settings.neighbours)).alias("held")
    )
    row = hit.agg(F.sum("all"), F.sum("held")).first()
    return row[1] / row[0] if row[0] else None


def neighbour_graph(nodes: DataFrame, truth: DataFrame, settings: DescentSettings) -> DataFrame:
    """Descend until the audited recall is reached or, if no audited vector has a link, a round finds no new one."""
    graph = materialize(best_of(start_graph(nodes, settings), settings.neighbours), "graph")
    before = -1
    for turn in range(settings.max_rounds):
        graph = materialize(refine(graph, nodes, settings), "graph")
        recall = audit(graph, truth, settings)
        if recall is None:
            found = links_of(graph, settings).count()
            good, before = found == before, found
        else:
            good = recall >= settings.recall
        if turn + 1 >= settings.min_rounds and good:
            break
    return graph


def saturated(graph: DataFrame, settings: DescentSettings) -> DataFrame:
    """(node) whose list is full of links, so it may have more."""
    return graph.filter((F.size("near") >= settings.neighbours) & (F.array_min("near")["sim"] >= settings.threshold)).select("node")


def bridged(graph: DataFrame, nodes: DataFrame, settings: DescentSettings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links, their components, and the saturated nodes; links between components of saturated nodes are searched for.

    A list full of the node's own group hides whatever lies beyond it. So saturated nodes descend again
    with lists that take in only nodes of other components, starting from new planes. One link is
    enough to join two components (``group_degrees`` finds the others); joined ones are searched again,
    until a descent finds no link.
    """
    links = materialize(links_of(graph, settings), "links")
    full = materialize(saturated(graph, settings), "full")
    any_full = not full.isEmpty()
    members = materialize(nodes.drop("fence").join(full, "node", "left_semi"), "members") if any_full else None
    edges = graph.join(full, "node", "left_semi").select("node", F.explode("near").alias("n")).select("node", F.col("n.other").alias("other"))
    beside = materialize(edges.join(full.select(F.col("node").alias("other")), "other", "left_semi").select("node", "other"), "beside") if any_full else None
    turn = 0
    while True:
        classes = materialize(connected_components(links), "classes")
        if not any_full or classes.join(full, "node", "left_semi").select("component").distinct().limit(2).count() < 2:
            return links, classes, full
        turn += 1
        again = replace(settings, seed=settings.seed + turn * settings.starts)
        fenced = materialize(members.join(classes.withColumnRenamed("component", "fence"), "node"), "fenced")
        far = materialize(best_of(start_graph(fenced, again), settings.neighbours), "far")
        for _ in range(settings.min_rounds):
            far = materialize(refine(far, fenced, again, beside), "far")
        found = materialize(links_of(far, settings), "found")
        if found.isEmpty():
            return links, classes, full
        links = materialize(links.unionByName(found).distinct(), "links")


def group_degrees(members: DataFrame, settings: DescentSettings) -> DataFrame:
    """(node, weight of its links) inside each component, compared tile by tile; no pair leaves a task.

    members(component, node, weight, vec). This enlarges the lists of saturated vectors to the whole group.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / settings.tile).cast("int").alias("_tiles"))
    dealt = members.join(sizes, "component").withColumn("_tile", F.pmod(F.xxhash64(F.lit("tile"), "node"), F.col("_tiles")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    rows = dealt.withColumn("_to", others).select("component", F.col("_tile").alias("_x"), F.col("_to").alias("_y"), "node", "weight", "vec", F.lit(True).alias("asks"))
    columns = dealt.withColumn("_to", others).select("component", F.col("_to").alias("_x"), F.col("_tile").alias("_y"), "node", "weight", "vec", F.lit(False).alias("asks"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        mine, theirs = group[asks], group[~asks]
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
        near = stacked(mine["vec"]) @ stacked(theirs["vec"]).T >= settings.threshold
        near &= mine["node"].to_numpy()[:, None] != theirs["node"].to_numpy()[None, :]
        return pd.DataFrame({"node": mine["node"].to_numpy(), "links": near @ theirs["weight"].to_numpy()})

    tiles = rows.unionByName(columns).groupBy("component", "_x", "_y").applyInPandas(compare, "node bigint, links bigint")
    return tiles.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: DescentSettings = DescentSettings()) -> DataFrame:
    """One row per input row: key, n_links, component_id, kept.

    Equal vectors of a label are one node and link with each other. Vectors without label, null, empty,
    zero or with null or non-finite parts link with nothing. ``n_links`` counts linked rows;
    ``component_id`` is the smallest key reachable. Vectors of different length never link. Repeated
    keys are rows of their own. An empty table gives no rows.
    """
    units = materialize(unit_vectors(rows, key, vector, label), "units")
    nodes = materialize(
        units.groupBy("node").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("weight"), F.min(key).alias("least"))
        .withColumn("fence", F.col("node")), "nodes"
    )
    truth = materialize(true_links(nodes, settings), "truth")
    graph = neighbour_graph(nodes, truth, settings)
    links, classes, saturated_nodes = bridged(graph, nodes, settings)
    full = classes.join(saturated_nodes, "node", "left_semi").select("component").distinct()
    members = classes.join(full, "component", "left_semi").join(nodes, "node").select("component", "node", "weight", "vec")
    dense = group_degrees(members, settings)
    weights = nodes.select(F.col("node").alias("other"), "weight")
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    sparse = both.join(weights, "other").groupBy("node").agg(F.sum("weight").alias("some"))
    named = (
        nodes.select("node", "weight", "least").join(classes, "node", "left").join(dense, "node", "left").join(sparse, "node", "left")
        .select("node", "least", F.coalesce("component", "node").alias("_class"), (F.col("weight") - 1 + F.coalesce("links", "some", F.lit(0))).alias("n_links"))
    )
    named = materialize(named, "named")
    counted = truth.join(weights, "other").groupBy("node").agg(F.sum("weight").alias("true"))
    short = counted.join(named, "node").join(nodes.select("node", "weight"), "node").agg(F.sum("true"), F.sum(F.col("n_links") - F.col("weight") + 1)).first()
    if short[0] and short[1] < settings.least_recall * short[0]:
        raise RuntimeError(f"only {short[1]} of {short[0]} links of the audited vectors were found")
    least = named.groupBy("_class").agg(F.min("least").alias("component_id"))
    found = named.join(least, "_class").select("node", "n_links", "component_id")
    linked = units.select(key, "node").join(found, "node").select(key, "n_links", "component_id")
    alone = rows.filter(~sound_row(vector, label)).select(key, F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def sound_row(vector: str, label: str) -> Column:
    """Whether ``unit_vectors`` keeps a row; never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite & nonzero, F.lit(False))
