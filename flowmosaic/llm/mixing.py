"""Mixing sources to target weights by the cube method of balanced sampling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import materialize

#: Undecided documents that one task balances at a time.
BLOCK_ROWS = 4000
#: Documents that the landing decides at once, besides the two that a flight may leave.
LANDING = 12
WEIGHTS = (5, 2, 1)
MOST = 3
EDGE = 1e-9


def n_words(text: Column) -> Column:
    """Number of runs of anything but the six ASCII white-space characters."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1).cast("bigint")


def shares_out(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Share the sum of the sizes by weight; no part above ``most`` times its size, the excess reshared."""
    targets, rest, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in sorted(open_) if rest * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = rest * weights[i] / total
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            open_.discard(i)
        rest -= sum(targets[i] for i in full)
    return targets


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(_source, source_size, target) of each source; one row per source goes through the driver.

    Sources are ordered by code point, null last, and take the weights in turn.
    """
    sums = rows.groupBy("_source").agg(F.sum(F.col("size") * F.col("_n")).alias("s")).collect()
    sums.sort(key=lambda r: (r["_source"] is None, (r["_source"] or "").encode()))
    sizes = [int(r["s"] or 0) for r in sums]
    targets = shares_out(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    found = [(r["_source"], s, float(t)) for r, s, t in zip(sums, sizes, targets)]
    return rows.sparkSession.createDataFrame(found, "_source string, source_size bigint, target double")


def flight(chances: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Flight phase over documents in the order given: at most two stay undecided.

    Three undecided documents have a direction in which neither their number nor their words change in
    expectation. The chances move along it until one is 0 or 1; the drawn side keeps the means.
    """
    chances = chances.copy()
    window: list[int] = []
    for nxt, draw in zip(range(len(chances)), draws):
        if chances[nxt] <= EDGE or chances[nxt] >= 1 - EDGE:
            continue
        window.append(nxt)
        if len(window) < 3:
            continue
        i, j, k = window
        direction = (sizes[j] - sizes[k], sizes[k] - sizes[i], sizes[i] - sizes[j])
        if not any(direction):
            direction = (1.0, -1.0, 0.0)
        p = (chances[i], chances[j], chances[k])
        up = min((1 - x) / d if d > 0 else -x / d for x, d in zip(p, direction) if d)
        down = min(x / d if d > 0 else (x - 1) / d for x, d in zip(p, direction) if d)
        step = up if draw * (up + down) < down else -down
        for at, x, d in zip(window, p, direction):
            moved = x + step * d
            chances[at] = 0.0 if moved <= EDGE else 1.0 if moved >= 1 - EDGE else moved
        window = [at for at in window if 0 < chances[at] < 1]
    return chances


def landing(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Decide the few that are left: words nearest to their expectation, with one document more or less at most."""
    at = np.flatnonzero((chances > 0) & (chances < 1))
    out = np.round(chances)
    if len(at):
        tries = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
        off = np.abs(tries @ sizes[at] - chances[at] @ sizes[at])
        off[np.abs(tries.sum(axis=1) - chances[at].sum()) > 1] = np.inf
        out[at] = tries[int(np.argmin(off))]
    return out


def fly_and_land(chances: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """The last block of a source, by size: a few documents of every size wait for the landing."""
    waits = np.unique(np.linspace(0, len(chances) - 1, min(LANDING, len(chances))).astype(int))
    flies = np.setdiff1d(np.arange(len(chances)), waits)
    chances = chances.copy()
    chances[flies] = flight(chances[flies], sizes[flies], draws[flies])
    return landing(chances, sizes)


def flying(turn: int):
    """The work of one block: flight, and landing if it is all of its source. Draws depend on row and round only."""

    def fly(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "_row"], ascending=[False, True], kind="stable")
        sizes = group["size"].to_numpy(float)
        draws = np.array([int(r[:8], 16) ^ (turn * 0x9E3779B1 & 0xFFFFFFFF) for r in group["_row"]]) / 2**32
        last = group["_blocks"].iloc[0] == 1
        group["_chance"] = (fly_and_land if last else flight)(group["_chance"].to_numpy(float), sizes, draws)
        return group[["_row", "_source", "size", "_chance"]]

    return fly


def balance(rows: DataFrame) -> DataFrame:
    """Decide ``_chance`` (0 or 1 afterwards) of every row so that words and rows of each source stay balanced.

    Rows: _row string (unique), _source, size, _chance. Each round deals a source's undecided rows by
    hash to blocks, whatever its size, and every block leaves two at most, so the number falls by a
    factor of about half a block per round until one block of the source is left, which lands in that
    round, whatever other sources still have to do.
    """
    decided, open_, turn = [], rows, 0
    while True:
        counts = open_.groupBy("_source").agg(F.count("*").alias("_rows"))
        most = counts.agg(F.max("_rows")).first()[0] or 0
        blocks = counts.select(F.col("_source").alias("_s"), F.ceil(F.col("_rows") / BLOCK_ROWS).alias("_blocks"))
        dealt = open_.join(blocks, F.col("_source").eqNullSafe(F.col("_s"))).withColumn(
            "_block", F.pmod(F.xxhash64(F.lit(turn), "_row"), F.col("_blocks"))
        )

        moved = materialize(
            dealt.select("_row", "_source", "size", "_chance", "_block", "_blocks").groupBy("_source", "_block")
            .applyInPandas(flying(turn), "_row string, _source string, size bigint, _chance double"),
            "flight",
        )
        done = F.col("_chance").isin(0.0, 1.0)
        decided.append(moved.filter(done))
        if most <= BLOCK_ROWS:
            break
        open_, turn = moved.filter(~done), turn + 1
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out.select("_row", F.col("_chance").cast("bigint").alias("_more"))


def decide(units: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """units(_row, _source, size, _n) plus source_size, target and ``_copies``: copies taken of the _n equal rows.

    A source's words are taken target / source_size times on average: whole copies at once, the
    fraction by balanced sampling.
    """
    targets = source_targets(units, weights, most).select(F.col("_source").alias("_s"), "source_size", "target")
    with_rate = units.join(targets, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    wanted = F.when(F.col("source_size") > 0, F.col("_n") * F.col("target") / F.col("source_size")).otherwise(F.col("_n") * 1.0)
    whole = F.floor(F.col("_wanted") + EDGE)
    rows = materialize(
        with_rate.withColumn("_wanted", wanted)
        .withColumn("_chance", F.greatest(F.lit(0.0), F.col("_wanted") - whole)).withColumn("_whole", whole).drop("_wanted"),
        "units",
    )
    open_ = rows.filter(F.col("_chance") > EDGE).select("_row", "_source", "size", "_chance")
    more = balance(open_)
    return rows.join(more, "_row", "left").withColumn("_copies", F.col("_whole") + F.coalesce("_more", F.lit(0))).drop("_whole", "_more", "_chance")


def row_key(docs: DataFrame) -> Column:
    """Text that is equal for equal rows only, whatever the types and nulls of the columns."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"ignoreNullFields": "false"}).cast("binary"))


def copies_of(place: Column) -> Column:
    """Of ``_copies`` shared by ``_n`` equal rows, how many the row at ``place`` (from 0) takes."""
    base = F.floor(F.col("_copies") / F.col("_n"))
    return base + (place < F.col("_copies") - base * F.col("_n")).cast("bigint")


def mix_digest(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row.

    Null texts have size 0. Equal rows share the copies drawn for them as evenly as whole numbers allow.
    A source without words takes each of its documents once, which is no words. No row is taken more
    than ``most`` times, rounded up.
    """
    light = docs.select("doc_id", F.col("source").cast("string").alias("_source"), n_words(F.col("text")).alias("size"))
    units = materialize(light.groupBy("doc_id", "_source", "size").agg(F.count("*").alias("_n")).withColumn("_row", row_key(light)), "mix")
    decided = decide(units, weights, most)
    rows = decided.withColumn("_place", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.select("doc_id", "size", "source_size", "target", (copies_of(F.col("_place")) * F.col("size")).alias("taken"))


def mix(docs: DataFrame, source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``; a document taken twice comes twice."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), row_key(docs).alias("_row"))
    light = docs.select(row_key(docs).alias("_row"), F.col(source).cast("string").alias("_source"), n_words(F.col(text)).alias("size"))
    units = materialize(light.groupBy("_row", "_source", "size").agg(F.count("*").alias("_n")), "mix")
    taken = decide(units, weights, most).filter("_copies > 0").select("_row", "_copies", "_n")
    once = keyed.join(taken.filter("_n = 1"), "_row")
    # equal rows: one of them stands for all and is repeated as often as they are taken together
    many = keyed.join(taken.filter("_n > 1"), "_row").groupBy("_row").agg(F.first("_doc").alias("_doc"), F.first("_copies").alias("_copies"))
    out = once.select("_doc", "_copies").unionByName(many.select("_doc", "_copies"))
    return out.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_doc.*")
