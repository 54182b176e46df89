"""Removal of every byte that lies in a string of 200 bytes which also starts somewhere else.

Each 200-byte window picks one of the 32-byte grams in it, the leftmost with the smallest hash. Equal
windows pick the same gram at the same distance, so only windows that share a gram need to meet. The
windows that picked one occurrence of a gram form a stretch of text; stretches are counted by their
hashes, and those that share a gram with a different stretch are dealt to buckets by the gram. In a bucket
a logarithmic family of suffix arrays finds the equal windows: stretches come in batches, each batch is
sorted, merge-scanned against the arrays already there, and arrays of like size are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import materialize, texts_of

LENGTH = 200
GRAM = 32
#: Text hashed at a time: whole short documents together, long ones in overlapping parts.
PART_BYTES = 1 << 16
LONG_BYTES = 1 << 20
#: Stretches that share a gram; beyond so many, their windows are counted one by one in Spark.
GROUP_STRETCHES = 4096
#: Windows of one bucket on average, and of one batch in it.
BUCKET_WINDOWS = 200_000
BATCH_WINDOWS = 40_000
#: A key is hot, and joined by broadcast, if it has at least this share of all rows: so at most as many keys are.
HOT_SHARE = 1024
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * ODD


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left) + (right ^ (right >> np.uint64(32)))


def window_anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the gram at each place, hash of the window at each place, gram picked by each window)."""
    grams, size = mixed(raw.astype(np.uint64) + np.uint64(1)), 1
    while size < gram:
        grams, size = joined(grams[:-size], grams[size:]), 2 * size
    windows = grams
    while 2 * size <= length:
        windows, size = joined(windows[:-size], windows[size:]), 2 * size
    if size < length:
        windows = joined(windows[: len(windows) - (length - size)], windows[length - size :])
    low = (mixed(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach, span = length - gram + 1, 1
    while 2 * span <= reach:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    if span < reach:
        low = np.minimum(low[: len(low) - (reach - span)], low[reach - span :])
    return grams, windows, (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def stretches(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Per stretch: number of the text, gram hash, hash of the stretch, place of the gram, farthest and nearest window start before it."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if len(raw) < length:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    grams, windows, picked = window_anchors(raw, length)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(picked)]
    inside = np.flatnonzero(np.arange(len(picked)) + length <= ends[owner])
    if not len(inside):
        return tuple(np.empty(0, np.int64) for _ in range(6))
    q = picked[inside]
    change = np.flatnonzero(q[1:] != q[:-1])
    first, last = inside[np.r_[0, change + 1]], inside[np.r_[change, len(inside) - 1]]
    q = picked[first]
    far, near = q - first, q - last
    same = joined(joined(windows[first], windows[last]), (far * 1024 + near).astype(np.uint64))
    text = owner[first]
    starts = (ends - sizes)[text]
    return text, grams[q].view(np.int64), mixed(same).view(np.int64), q - starts, far, near


def stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its number, sha256 and bytes, and its stretches as lists."""
    task, made = TaskContext.get().partitionId(), 0
    names = ["h", "c", "q", "far", "near"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16()]
    for batch in batches:
        raws = [raw or b"" for raw in texts_of(batch)]
        at = 0
        while at < len(raws):
            stop, held, parts = at, 0, []
            while stop < len(raws) and held < 64 * PART_BYTES:
                held, stop = held + len(raws[stop]), stop + 1
            low = at
            while low < stop:  # some short texts together, or one long one in parts
                high, some = low, 0
                while high < stop and (high == low or some + len(raws[high]) <= PART_BYTES):
                    some, high = some + len(raws[high]), high + 1
                if some <= LONG_BYTES:
                    text, *rest = stretches(raws[low:high])
                    parts.append((text + low - at, *rest))
                else:
                    for start in range(0, some - LENGTH + 1, LONG_BYTES):
                        text, h, c, q, far, near = stretches([raws[low][start : start + LONG_BYTES + LENGTH - 1]])
                        parts.append((text + low - at, h, c, q + start, far, near))
                low = high
            text, *values = [np.concatenate(column) for column in zip(*parts)]
            offsets = pa.array(np.searchsorted(text, np.arange(stop - at + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, k)) for v, k in zip(values, kinds)]
            ids = batch.column("doc_id").slice(at, stop - at)
            digests = pa.array([hashlib.sha256(r).digest() for r in raws[at:stop]], pa.binary())
            sizes = pa.array([len(r) for r in raws[at:stop]], pa.int64())
            rows = pa.array(range(task << 33 | made, (task << 33 | made) + stop - at), pa.int64())
            made += stop - at
            yield pa.RecordBatch.from_arrays([ids, rows, digests, sizes, *lists], names=["doc_id", "row", "t", "n_bytes", *names])
            at = stop


class SuffixArrays:
    """A family of suffix arrays over windows; ``twice`` marks the windows seen more than once."""

    def __init__(self, n: int):
        self.twice = np.zeros(n, bool)
        self.arrays: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, windows: np.ndarray, ids: np.ndarray) -> None:
        """Sort a batch, scan it together with every array, then merge arrays while sizes are alike."""
        order = np.argsort(windows, kind="stable")
        windows, ids = windows[order], ids[order]
        same = windows[1:] == windows[:-1]
        self.twice[ids[1:][same]] = self.twice[ids[:-1][same]] = True
        first = np.r_[True, ~same]
        windows, ids = windows[first], ids[first]
        known = np.zeros(len(ids), bool)
        for keys, owners in self.arrays:
            merged, origin = self.merged((keys, np.arange(len(keys))), (windows, len(keys) + np.arange(len(ids))))
            meet = np.flatnonzero(merged[1:] == merged[:-1])
            mine, theirs = origin[meet + 1] - len(keys), origin[meet]
            known[mine] = True
            self.twice[ids[mine]] = self.twice[owners[theirs]] = True
        new = (windows[~known], ids[~known])
        while self.arrays and len(self.arrays[-1][1]) <= 2 * len(new[1]):
            new = self.merged(self.arrays.pop(), new)
        self.arrays.append(new)

    @staticmethod
    def merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Two sorted arrays as one; the stable sort finds the two runs and merges them."""
        keys, ids = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
        order = np.argsort(keys, kind="stable")
        return keys[order], ids[order]


def windows_of(body: bytes, n: int, length: int = LENGTH) -> np.ndarray:
    """The first ``n`` windows of a stretch as fixed-width keys; a last byte keeps trailing zeros."""
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(body, np.uint8), length)[:n]
    keys = np.ones((n, length + 1), np.uint8)
    keys[:, :length] = view
    return keys.reshape(-1).view(f"S{length + 1}")


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of true values."""
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def bucket_matches(table: pa.Table) -> pa.Table:
    """(h, c, near, far): the window starts, by their distance before the gram, that occur twice in the bucket."""
    rows = table.select(["h", "c", "n", "far", "near", "body"]).to_pylist()
    counts = [r["far"] - r["near"] + 1 for r in rows]
    starts = np.r_[0, np.cumsum(counts)]
    family = SuffixArrays(int(starts[-1]))
    low = 0
    while low < len(rows):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + BATCH_WINDOWS, "right")) - 1)
        keys = np.concatenate([windows_of(r["body"], n) for r, n in zip(rows[low:high], counts[low:high])])
        family.add(keys, np.arange(starts[low], starts[high]))
        low = high
    out = []
    for row, start, n in zip(rows, starts, counts):
        flags = np.ones(n, bool) if row["n"] > 1 else family.twice[start : start + n]
        out += [(row["h"], row["c"], row["far"] - b, row["far"] - a) for a, b in runs(flags)]
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["h", "c", "near", "far"])


def meet(left: DataFrame, right: DataFrame, key: list[str], n: str, total: int) -> DataFrame:
    """Inner join where ``right`` has one row per key and ``n``, the rows of ``left`` under it.

    Keys with at least 1/HOT_SHARE of all ``total`` rows, at most HOT_SHARE of them, are broadcast; no row
    of theirs is shuffled.
    """
    hot = F.col(n) * HOT_SHARE >= max(total, HOT_SHARE)
    few, rest = right.filter(hot), right.filter(~hot)
    names = F.broadcast(few.select(*key))
    return left.join(F.broadcast(few), key).unionByName(left.join(names, key, "left_anti").join(rest, key))


def repeated_spans(docs: DataFrame, sheets: DataFrame, copies: DataFrame) -> DataFrame:
    """(row, m, text, spans) of the texts of which some window may occur twice; spans in bytes, end exclusive.

    ``sheets`` are the rows of ``stretch_rows``, ``copies`` one (row, t, m) per distinct text.
    """
    lists = ["h", "c", "q", "far", "near"]
    spread = (
        sheets.join(copies.select("row"), "row").filter(F.size("h") > 0)
        .select("row", F.explode(F.arrays_zip(*lists)).alias("e")).select("row", *[F.col(f"e.{c}").alias(c) for c in lists])
    )
    total = sheets.agg(F.coalesce(F.sum(F.size("h")), F.lit(0))).first()[0]
    grams = spread.groupBy("h").agg(F.count("*").alias("_n"), F.min("c").alias("_c"), F.max("c").alias("_d"))
    grams = materialize(grams.filter("_n > 1").select("h", "_n", (F.col("_c") == F.col("_d")).alias("alike")), "grams")
    shared = materialize(meet(spread, grams, ["h"], "_n", total).drop("_n"), "shared")
    texts = materialize(needed_texts(docs, copies.join(shared.select("row").distinct(), "row"), sheets.count()), "texts")

    # one stretch of each kind, with its text, where the gram has stretches of several kinds
    kinds = shared.filter("NOT alike").groupBy("h", "c").agg(
        F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("q", "row").alias("q"), F.max("far").alias("far"), F.max("near").alias("near")
    )
    kinds = materialize(kinds, "kinds")
    body = F.substring(F.col("text").cast("binary"), (F.col("q") - F.col("far") + 1).cast("int"), (F.col("far") - F.col("near") + LENGTH).cast("int"))
    bodies = kinds.join(texts.select("row", "text"), "row").select("h", "c", "n", "far", "near", body.alias("body"))
    bodies = materialize(bodies, "bodies")
    sizes = bodies.groupBy("h").agg(F.count("*").alias("_k"))
    many = materialize(sizes.filter(F.col("_k") > GROUP_STRETCHES), "many")
    n_windows = bodies.agg(F.coalesce(F.sum(F.col("far") - F.col("near") + 1), F.lit(0))).first()[0]
    buckets = max(1, int(n_windows) // BUCKET_WINDOWS)
    usual = bodies.join(many.select("h"), "h", "left_anti").withColumn("_bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    found = usual.groupBy("_bucket").applyInArrow(bucket_matches, "h bigint, c bigint, near bigint, far bigint")
    matches = materialize(found.unionByName(counted_windows(bodies, many)), "matches")

    hits = matches.groupBy("h", "c").agg(F.collect_list(F.struct("near", "far")).alias("hits")).join(kinds.select("h", "c", "n"), ["h", "c"])
    mixed_ = meet(shared.filter("NOT alike").select("row", "h", "c", "q"), hits, ["h", "c"], "n", total)
    span = lambda far, near: F.struct((F.col("q") - far).alias("start"), (F.col("q") - near + LENGTH).alias("end"))
    spans = mixed_.select("row", "q", F.explode("hits").alias("_hit")).select("row", span(F.col("_hit.far"), F.col("_hit.near")).alias("span"))
    spans = spans.unionByName(shared.filter("alike").select("row", span(F.col("far"), F.col("near")).alias("span")))
    return texts.join(spans.groupBy("row").agg(F.collect_list("span").alias("spans")), "row")


def counted_windows(bodies: DataFrame, many: DataFrame) -> DataFrame:
    """Windows of grams with very many kinds of stretches, counted in Spark by 128 bits of hash."""
    window = F.substring("body", F.col("far") - F.col("o") + 1, LENGTH)
    each = bodies.join(many, "h").withColumn("o", F.explode(F.sequence("near", "far"))).select(
        "h", "c", "n", "o", F.xxhash64(F.lit(1), window).alias("_a"), F.xxhash64(F.lit(2), F.reverse(F.hex(window))).alias("_b")
    )
    each = materialize(each, "windows")
    key = ["h", "o", "_a", "_b"]
    twice = each.groupBy(*key).agg(F.count("*").alias("_k"), F.sum("n").alias("_times")).filter("_times > 1").drop("_times")
    total = each.count()
    return meet(each, materialize(twice, "twice"), key, "_k", total).select(
        "h", "c", F.col("o").cast("bigint").alias("near"), F.col("o").cast("bigint").alias("far")
    )


def needed_texts(docs: DataFrame, needed: DataFrame, n_rows: int) -> DataFrame:
    """(row, m, text) of the distinct texts in ``needed(row, t, m)``; of many copies one per task is shuffled."""
    keyed = docs.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("t"), "text")
    hot = F.col("m") * HOT_SHARE >= max(n_rows, HOT_SHARE)
    one = [F.first(c).alias(c) for c in ("row", "m", "text")]
    few = keyed.join(F.broadcast(needed.filter(hot)), "t").groupBy("t").agg(*one)
    rest = keyed.join(F.broadcast(needed.filter(hot).select("t")), "t", "left_anti").join(needed.filter(~hot), "t").groupBy("t").agg(*one)
    return few.unionByName(rest).drop("t")


def cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, n_removed, n_spans, kept_sha256): overlapping and touching spans are one run."""
    for batch in batches:
        out = []
        for row, raw, spans in zip(batch.column("row").to_pylist(), texts_of(batch), batch.column("spans").to_pylist()):
            runs_: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for s in spans):
                if runs_ and start <= runs_[-1][1]:
                    runs_[-1][1] = max(runs_[-1][1], end)
                else:
                    runs_.append([start, end])
            digest, at = hashlib.sha256(), 0
            for start, end in [*runs_, [len(raw), len(raw)]]:
                digest.update(raw[at:start])
                at = end
            out.append((row, sum(e - s for s, e in runs_), len(runs_), digest.hexdigest()))
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["row", "n_removed", "n_spans", "kept_sha256"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A null text is empty; texts under 200 bytes lose nothing. Rows with equal texts of 200 bytes and more
    lose them whole, whatever their ids; repeated and null ids keep a row each. An empty table gives no
    rows. Only ``doc_id`` and ``text`` are read. A span may cut a character; what is left is hashed as bytes.
    Stretches are told apart by 128 bits of hash (gram and stretch) before their texts are compared.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row bigint, t binary, n_bytes bigint, h array<bigint>, c array<bigint>, q array<bigint>, far array<smallint>, near array<smallint>"
    sheets = materialize(texts.mapInArrow(stretch_rows, schema), "sheets")
    copies = materialize(sheets.filter(F.col("n_bytes") >= LENGTH).groupBy("t").agg(F.min("row").alias("row"), F.count("*").alias("m")), "copies")
    single = repeated_spans(texts, sheets, copies).filter("m = 1").select("row", "text", "spans")
    cut = single.mapInArrow(cut_spans, "row bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    base = sheets.select("doc_id", "row", "t", "n_bytes")
    repeated = copies.filter("m > 1").select("t", "m")
    n_rows = sheets.count()
    whole = meet(base, repeated, ["t"], "m", n_rows).select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"), F.lit(EMPTY_SHA).alias("kept_sha256")
    )
    once = copies.filter("m = 1").select("row").unionByName(sheets.filter(F.col("n_bytes") < LENGTH).select("row"))
    rest = base.join(once, "row").join(cut, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("t"))).alias("kept_sha256"),
    )
    return whole.unionByName(rest)
