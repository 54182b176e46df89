"""Collocations: phrases of two to five words that occur often and hold together, per language.

Words get ids by frequency. Neighbouring pairs of ids are counted per chunk of text: pairs of ids fall
into square tiles, well-filled tiles are counted with a dense ``bincount`` over their cells, the others
as sorted coordinates. Spark adds the chunks' counts up. Frequent pairs are ranked and become the ids of
the next round, in which two overlapping pairs make a phrase of one word more.

A chunk carries its own small vocabulary: an entry goes out under its word or pair, meets those of the other
chunks (one row per chunk, however often it occurs), and comes back with its id under its chunk. No table of
all words or pairs has to fit a task. Both ways are cut into bounded rows: the words of a chunk into slices, its ids
into packed runs. The task that pairs it up puts one chunk together at a time, whatever number of them it gets.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmosaic.llm.common import materialize, texts_of

LEAST = 100
LONGEST = 5
TOP = 2000
#: Words of a chunk; a piece without punctuation is not cut.
CHUNK_WORDS = 4_000_000
#: Bytes of a long text that become words at a time, to the next punctuation mark.
SLICE_BYTES = 1 << 20
#: Words of the chunks that one task pairs up, on average; it holds one chunk at a time.
PART_WORDS = 4_000_000
#: A tile is 2^10 by 2^10 ids; it is counted densely if its pairs are at least 1/64 of its cells.
TILE_BITS = 10
DENSE_SHARE = 64
#: Vocabulary entries, and words, in one row of a chunk table.
ENTRIES = 50_000
ROW_WORDS = 1 << 18
#: Entries with ids that are packed by chunk at a time.
PACK = 1 << 20
#: Pairs sorted or counted at a time, or those of one tile or one first id.
BAND = 1 << 20
#: Documents turned into Python objects at a time.
DOCS = 256
#: Ids of one range of frequencies; the number of the range stands above these bits.
RANK_BITS = 40
#: Groups in which the best phrases of a language are chosen first.
TOP_GROUPS = 64
#: Rows of chunks are large: a writer looks at its pages and row groups after every row, and closes them early.
WIDE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
#: Set while a table is written: its shuffle files go with it instead of staying to the end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")
#: ASCII letters to lower case; punctuation and line ends to a byte that no UTF-8 text holds.
TABLE = bytes(0xFF if BREAK.fullmatch(bytes([c])) else c + 32 if 65 <= c <= 90 else c for c in range(256))


def slices(raw: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    start = 0
    while start < len(raw):
        found = BREAK.search(raw, start + size)
        stop = found.start() if found else len(raw)
        yield raw[start:stop]
        start = stop


def word_list(raw: bytes) -> list[bytes]:
    """Words of a text, with the break byte as a word of its own between pieces and at the end."""
    return (raw.translate(TABLE).replace(b"\xff", b" \xff ") + b" \xff").split()


class Buffer:
    """Words of one language on their way into a chunk: local numbers by first sight, 0 is a break."""

    def __init__(self):
        self.vocabulary: defaultdict = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.vocabulary[b"\xff"]
        self.parts: list[np.ndarray] = []

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))


def cut_words(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_WORDS) -> Iterator[pa.RecordBatch]:
    """Rows of chunks: (chunk, lang, at, ids, words, base, keys, n), words and vocabulary in slices."""
    task, made, held = TaskContext.get().partitionId(), 0, 0
    buffers: dict[str, Buffer] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal made, held
        for lang, buffer in buffers.items():
            ids = np.concatenate(buffer.parts) - np.int32(1)
            buffer.parts.clear()
            keys = list(buffer.vocabulary)[1:]
            counts = np.bincount(ids[ids >= 0], minlength=len(keys))
            chunk, made = task << 32 | made, made + 1
            part = lambda cut: {"keys": pa.array(keys[cut], pa.binary()).cast(pa.string())}  # noqa: B023, E731
            yield from chunk_rows(chunk, lang, squeeze(ids), int(counts.sum()), part, counts)
        buffers.clear()
        held = 0

    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            some = batch.slice(at, DOCS)
            for lang, raw in zip(some.column("lang").to_pylist(), texts_of(some)):
                for piece in slices(raw or b""):
                    words = word_list(piece)
                    buffers.setdefault(lang, Buffer()).add(words)
                    held += len(words)
                    if held >= limit:
                        yield from flush()
    yield from flush()
    pa.default_memory_pool().release_unused()


def chunk_rows(chunk: int, lang: str, ids: np.ndarray, words: int, keys: Callable[[slice], dict[str, pa.Array]], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per slice of the words (``at``, ``ids``) and of the vocabulary (``base``, ``keys``, ``n``)."""
    one_list = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    for at in range(max(-(-len(ids) // ROW_WORDS), -(-len(n) // ENTRIES), 1)):
        some, cut = ids[at * ROW_WORDS : (at + 1) * ROW_WORDS], slice(at * ENTRIES, (at + 1) * ENTRIES)
        columns = {
            "chunk": pa.array([chunk], pa.int64()),
            "lang": pa.array([lang], pa.string()),
            "at": pa.array([at], pa.int32()),
            "ids": pa.array([some.tobytes() if len(some) else None], pa.binary()),
            "words": pa.array([0 if at else words], pa.int64()),
            "base": pa.array([at * ENTRIES], pa.int32()),
            **{name: one_list(values) for name, values in keys(cut).items()},
            "n": one_list(pa.array(n[cut], pa.int64())),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def squeeze(ids: np.ndarray) -> np.ndarray:
    """One break (-1) where there are several in a row."""
    kept = ids >= 0
    kept[1:] |= kept[:-1].copy()
    kept[:1] = True
    return ids[kept]


def names_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and for each value its number among them."""
    if not len(values) or values.min() < 0 or values.max() > 4 * len(values):
        names, number = np.unique(values, return_inverse=True)
        return names, number.astype(np.int32)
    seen = np.zeros(int(values.max()) + 1, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - np.int32(1))[values]


def bands(label: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the labels from 0, some labels at a time: ``BAND`` places, or those of one label. ``size``: places per label."""
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        done = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, done + BAND, "right")), start + 1)
        yield np.flatnonzero((label >= start) & (label < stop))
        start = stop


def tile_counts(a: np.ndarray, b: np.ndarray, bits: int = TILE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, n) of the distinct pairs, and for each given pair its number among them."""
    local = np.empty(len(a), np.int32)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(a[:0], b[:0], local[:0])]
    mask, cells, found = (1 << bits) - 1, 1 << 2 * bits, 0
    rows, tile = names_of(a >> bits)
    cols, col = names_of(b >> bits)
    wide = max(len(cols), 1)
    if len(rows) * wide >= 1 << 31:
        tile = tile.astype(np.int64)
    tile *= wide
    tile += col
    del col
    tiles, tile = names_of(tile)
    filled = np.bincount(tile, minlength=len(tiles))
    dense = np.flatnonzero(filled * DENSE_SHARE >= cells)
    slot = np.full(len(tiles), -1, np.int32)
    slot[dense] = np.arange(len(dense))
    tile = slot[tile]  # of dense tiles, -1 for the others
    for at in bands(tile, filled[dense]):
        at = at[np.argsort(tile[at], kind="stable")]
        edges = np.flatnonzero(np.diff(tile[at], prepend=-1, append=-1))
        for start, stop in zip(edges[:-1], edges[1:]):
            mine = at[start:stop]
            name = tiles[dense[tile[mine[0]]]]
            cell = (a[mine] & mask) << bits | (b[mine] & mask)
            counts = np.bincount(cell, minlength=cells)
            hit = np.flatnonzero(counts)
            place = np.empty(cells, np.int32)
            place[hit] = np.arange(found, found + len(hit))
            local[mine], found = place[cell], found + len(hit)
            out.append((((rows[name // wide] << bits) + (hit >> bits)).astype(a.dtype), ((cols[name % wide] << bits) + (hit & mask)).astype(b.dtype), counts[hit].astype(np.int32)))
    rest = np.flatnonzero(tile < 0)
    del tile
    firsts, of_a = names_of(a[rest])
    for band in bands(of_a, np.bincount(of_a, minlength=len(firsts))):
        at = rest[band]
        seconds, of_b = np.unique(b[at], return_inverse=True)
        codes, number, counts = np.unique(of_a[band].astype(np.int64) * len(seconds) + of_b, return_inverse=True, return_counts=True)
        local[at] = found + number
        out.append((firsts[codes // len(seconds)].astype(a.dtype), seconds[codes % len(seconds)], counts.astype(np.int32)))
        found += len(codes)
    return (*[np.concatenate(c) for c in zip(*out)], local)


def pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks whose local numbers get ranked ids become chunks of neighbouring pairs of such ids.

    The rows of a chunk follow each other: slices of its words, and runs of its entries that have ids.
    """
    now, lang, words, runs = None, None, {}, []

    def pairs_of() -> Iterator[pa.RecordBatch]:
        if not words or not runs:
            return
        ids = np.concatenate([words[at] for at in sorted(words)])
        of, names = (np.concatenate(c) for c in zip(*runs))
        words.clear()
        runs.clear()
        order = np.argsort(names)
        names = names[order]
        ranks = np.full(max(int(ids.max()), int(of.max())) + 2, -1, np.int32)  # the last place is for breaks
        ranks[of[order]] = np.arange(len(order))
        del of, order
        seq = ranks[ids]
        del ids, ranks
        both = (seq[:-1] >= 0) & (seq[1:] >= 0)
        if not both.any():
            return
        a, b, n, local = tile_counts(seq[:-1][both], seq[1:][both])
        seq.fill(-1)
        seq[:-1][both] = local
        del both, local
        part = lambda cut: {"a": pa.array(names[a[cut]], pa.int64()), "b": pa.array(names[b[cut]], pa.int64())}
        yield from chunk_rows(now, lang, squeeze(seq), 0, part, n)

    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns))
        for i, chunk in enumerate(column["chunk"].to_pylist()):
            if chunk != now:
                yield from pairs_of()
                words.clear()
                runs.clear()
                now = chunk
            if column["ids"][i].is_valid:
                lang = column["lang"][i].as_py()
                words[column["at"][i].as_py()] = np.frombuffer(column["ids"][i].as_py(), np.int32)
            else:
                of, step = (np.frombuffer(column[c][i].as_py(), np.int32) for c in ("locals", "steps"))
                runs.append((of, column["first"][i].as_py() + step.astype(np.int64)))
        del batch, column
    yield from pairs_of()
    pa.default_memory_pool().release_unused()


def packed(chunk: np.ndarray, local: np.ndarray, ids: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(chunk, first, locals, steps): one row per chunk with its local numbers and their ids, these from ``first`` on."""
    order = np.argsort(chunk, kind="stable")
    chunk = chunk[order]
    edges = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True])
    offsets = pa.py_buffer((4 * edges).astype(np.int32))
    runs = lambda values: pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(values[order].astype(np.int32))])
    first = int(ids.min())
    return pa.array(chunk[edges[:-1]], pa.int64()), pa.array(np.full(len(edges) - 1, first), pa.int64()), runs(local), runs(ids - first)


CHUNKS = "chunk bigint, lang string, at int, ids binary, words bigint, base int, "


def written(frame: DataFrame, purpose: str, options: dict[str, str] | None = None) -> DataFrame:
    """``materialize``, after which the shuffle files of ``frame`` are gone."""
    conf = frame.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return materialize(frame, purpose, options=options)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def entries_of(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(chunk, lang, local, keys.., n): every vocabulary entry of every chunk."""
    zipped = F.posexplode(F.arrays_zip(*[F.col(k) for k in [*keys, "n"]])).alias("_at", "_e")
    return chunks.select("chunk", "lang", "base", zipped).select(
        "chunk", "lang", (F.col("base") + F.col("_at")).alias("local"), *[F.col(f"_e.{k}").alias(k) for k in [*keys, "n"]]
    )


def with_ids(entries: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The entries whose key occurs ``least`` times in its language, in rows of two kinds.

    Each key has one row (lang, keys.., f, id) without a chunk; rows with a chunk (chunk, first, locals, steps)
    have the ids of its entries, packed. Ids rise as frequencies fall: keys are sorted over ranges of frequencies,
    an id is the number of its range and the place of its key there, so ids are dense within a range.
    """
    every = Window.partitionBy("lang", *keys)
    often = entries.withColumn("f", F.sum("n").over(every)).filter(F.col("f") >= least).drop("n").withColumn("_less", -F.col("f"))
    order = ["lang", "_less", *keys]
    cut = written(often, "often").repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema.fields}
    kept = {**{c: kinds[c] for c in ["lang", *keys, "f"]}, "id": "bigint", "chunk": "bigint", "first": "bigint", "locals": "binary", "steps": "binary"}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, made, held = None, (TaskContext.get().partitionId() << RANK_BITS) - 1, []

        def row_batch(size: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            types = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, types[kind]) for c, kind in kept.items()], names=list(kept))

        def flush() -> pa.RecordBatch:
            columns = dict(zip(("chunk", "first", "locals", "steps"), packed(*[np.concatenate(c) for c in zip(*held)])))
            held.clear()
            return row_batch(len(columns["chunk"]), columns)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for key in ["lang", *keys]:
                column = batch.column(key)
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            first = [batch.column(key)[0].as_py() for key in ["lang", *keys]]
            new[0] = first != last
            ids = made + np.cumsum(new)
            last, made = [batch.column(key)[batch.num_rows - 1].as_py() for key in ["lang", *keys]], int(ids[-1])
            if new.any():
                yield row_batch(int(new.sum()), {**{c: batch.column(c).filter(pa.array(new)) for c in ["lang", *keys, "f"]}, "id": pa.array(ids[new], pa.int64())})
            held.append((batch.column("chunk").to_numpy().copy(), batch.column("local").to_numpy().copy(), ids))
            if sum(len(h[0]) for h in held) >= PACK:
                yield flush()
        if held:
            yield flush()

    return written(cut.mapInArrow(number, ", ".join(f"{c} {kind}" for c, kind in kept.items())), "ranked")


def keys_of(ranks: DataFrame, keys: list[str]) -> DataFrame:
    """(lang, id, f, keys..): one row per key."""
    return ranks.filter(F.col("chunk").isNull()).select("lang", "id", "f", *keys)


def with_ranks(chunks: DataFrame, ranks: DataFrame, parts: int) -> DataFrame:
    """The words of chunks and the ids of those of their entries that are frequent, dealt to ``parts`` tasks, chunk after chunk."""
    words = chunks.filter(F.col("ids").isNotNull()).select("chunk", "lang", "at", "ids")
    runs = ranks.filter(F.col("chunk").isNotNull()).select("chunk", "first", "locals", "steps")
    return words.unionByName(runs, allowMissingColumns=True).repartition(parts, "chunk").sortWithinPartitions("chunk")


def phrase_levels(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, words) totals, and per length the frequent phrases: lang, id, f, phrase, pre, suf, a, b.

    ``pre`` and ``suf`` hold the frequencies of the first and of the last 1, 2, .. words; ``a`` and ``b``
    are the ids, one length below, of the phrase without its last and without its first word.
    """
    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    chunks = written(plain.mapInArrow(cut_words, CHUNKS + "keys array<string>, n array<bigint>"), "chunks", WIDE_ROWS)
    totals = written(chunks.groupBy("lang").agg(F.sum("words").alias("words")), "totals")
    parts = max(1, (totals.agg(F.sum("words")).first()[0] or 0) // PART_WORDS)
    ranks = with_ids(entries_of(chunks, ["keys"]), ["keys"], least)
    words = keys_of(ranks, ["keys"]).withColumnRenamed("keys", "phrase")
    none = F.lit(None).cast("bigint")
    words = words.withColumn("a", none).withColumn("b", none).withColumn("pre", F.array("f")).withColumn("suf", F.array("f"))
    levels = [written(words, "level")]
    for _ in range(longest - 1):
        below = levels[-1]
        chunks = with_ranks(chunks, ranks, parts).mapInArrow(pair_up, CHUNKS + "a array<bigint>, b array<bigint>, n array<bigint>")
        chunks = written(chunks, "chunks", WIDE_ROWS)
        ranks = with_ids(entries_of(chunks, ["a", "b"]), ["a", "b"], least)
        pairs = keys_of(ranks, ["a", "b"])
        head = below.select("lang", F.col("id").alias("a"), F.col("phrase").alias("_p"), F.col("pre").alias("_pre"))
        tail = below.select("lang", F.col("id").alias("b"), F.element_at(F.split("phrase", " "), -1).alias("_w"), F.col("suf").alias("_suf"))
        phrases = pairs.join(head, ["lang", "a"]).join(tail, ["lang", "b"]).select(
            "lang", "id", "a", "b", "f", F.concat_ws(" ", "_p", "_w").alias("phrase"),
            F.concat("_pre", F.array("f")).alias("pre"), F.concat("_suf", F.array("f")).alias("suf"),
        )
        levels.append(written(phrases, "level"))
    return totals, levels


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` of each language.

    A null text is empty, a null language is `und` (with texts marked `und` themselves); empty texts and
    texts of punctuation add nothing, repeated rows count each time, an empty table gives no rows. Only
    ``lang`` and ``text`` are read. A piece without punctuation is held whole by one task. Scores are whole
    numbers from 38-digit decimals: exact while 1000 times a times n stays below 10^38.
    """
    totals, levels = phrase_levels(docs, least, longest)
    whole = lambda c: c.cast("decimal(19,0)")
    found: DataFrame | None = None
    for size in range(2, longest + 1):
        level = levels[size - 1].select("lang", "id", F.col("f").alias("a"), "phrase", "pre", "suf")
        if size < longest:
            longer = levels[size]
            inside = longer.select("lang", F.col("a").alias("id"), "f").unionByName(longer.select("lang", F.col("b").alias("id"), "f"))
            level = level.join(inside.groupBy("lang", "id").agg(F.max("f").alias("_f")), ["lang", "id"], "left").filter(
                F.col("_f").isNull() | (F.col("_f") < F.col("a"))
            )
        level = level.join(totals, "lang").withColumn("_ll", F.slice("pre", 1, size - 1)).withColumn("_rr", F.reverse(F.slice("suf", 1, size - 1)))
        cuts = [
            F.struct(
                F.call_function("div", F.lit(1000).cast("decimal(4,0)") * whole(F.col("a")) * whole(F.col("words")), whole(left) * whole(right)).alias("score"),
                F.lit(k).alias("k"), left.alias("l"), right.alias("r"),
            )
            for k in range(1, size)
            for left, right in [(F.col("_ll")[k - 1], F.col("_rr")[k - 1])]
        ]
        best = level.withColumn("_best", F.array_min(F.array(*cuts)))
        rows = best.select("lang", "phrase", "a", "_best.l", "_best.r", F.col("words").alias("n"), "_best.score")
        found = rows if found is None else found.unionByName(rows)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(TOP_GROUPS))
    found = found.withColumn("_group", group).withColumn("_in", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order)))
    order = Window.partitionBy("lang").orderBy(*order)
    out = found.filter(F.col("_in") <= top).withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = """
WITH pieces AS (
    SELECT lang, row_number() OVER () AS id, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    )
), starts AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(ws) GROUP BY 1, 2, 3
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY 1
), candidates AS (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM grams WHERE k >= 2 AND f >= 100
), covered AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
          FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))) p
    JOIN candidates c ON c.lang = p.lang AND c.phrase = p.phrase AND 100 * p.a >= 100 * c.a
), cuts AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.j, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
    JOIN grams x ON x.lang = c.lang AND x.k = c.j AND x.phrase = array_to_string(c.ws[1:c.j], ' ')
    JOIN grams y ON y.lang = c.lang AND y.k = c.k - c.j AND y.phrase = array_to_string(c.ws[c.j + 1:], ' ')
    JOIN totals t ON t.lang = c.lang
    ANTI JOIN covered d ON d.lang = c.lang AND d.phrase = c.phrase
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""
