"""SentencePiece encoding and decoding over a lattice of substrings."""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.llm.common import materialize

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: A character without a piece of its own scores this much below the worst piece (fixed value).
UNKNOWN_PENALTY = 10.0
#: Words with at least 1 / FREQUENT of all are encoded relationally, once, and broadcast: there cannot be more of them.
FREQUENT = 1 << 20
#: Longer words are solved in the task that holds them: the relational fold copies its state at every edge.
LONGEST_FREQUENT = 256
#: A task's memory of words it has met.
MEMORY = 100_000
#: Rows of an Arrow batch that are Python objects at a time.
ROWS = 64


@dataclass(frozen=True)
class PieceTable:
    """Ordinary pieces with id and score, and the first of the 256 byte pieces.

    ``trie`` leads from character to character: (what may follow, id or -1, score) of every beginning of a piece.
    """

    pieces: dict
    trie: dict
    texts: tuple
    first_byte: int
    longest: int
    lowest: float


def trie_of(plain: dict) -> dict:
    trie: dict = {}
    following = {"": trie}
    for head in sorted({t[:n] for t in plain for n in range(1, len(t) + 1)}):  # every head after its own heads
        following[head] = {}
        following[head[:-1]][head[-1]] = (following[head], *plain.get(head, (-1, 0.0)))
    return trie


def load_pieces(path: str = MODEL_PATH) -> PieceTable:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    plain = {
        t: (i, float(model.get_score(i))) for i, t in enumerate(texts)
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
    }
    first = texts.index("<0x00>")
    if texts[first : first + 256] != [f"<0x{b:02X}>" for b in range(256)]:
        raise ValueError("the model has no byte pieces")
    return PieceTable(plain, trie_of(plain), tuple(texts), first, max(map(len, plain)), min(s for _, s in plain.values()))


def words_of(text: str) -> list[str]:
    """Lattice words whose concatenation is the text with a blank before it.

    A blank, written as the space mark, opens a word; a line end is a word of its own. A space mark that
    the text itself holds becomes a word with a line end before it, which no other word can have.
    """
    if SPACE not in text:
        marked = SPACE + text.replace(" ", " " + SPACE)
        return [word for word in marked.replace("\n", " \n ").split(" ") if word] if "\n" in text else marked.split(" ")
    out = []
    for run in text.split(" "):
        if "\n" not in run and SPACE not in run:
            out.append(SPACE + run)
            continue
        part = SPACE
        for char in run:
            if char == "\n" or char == SPACE:
                if part:
                    out.append(part)
                out.append("\n" if char == "\n" else "\n" + SPACE)
                part = ""
            else:
                part += char
        if part:
            out.append(part)
    return out


def byte_ids(char: str, table: PieceTable) -> list[int]:
    return [table.first_byte + b for b in char.encode()]


def viterbi(word: str, table: PieceTable) -> list[int]:
    """Best-scoring pieces of one word; of equal paths the one whose last pieces start first."""
    if word[0] == "\n":
        return byte_ids(word[-1], table)
    n, unknown = len(word), table.lowest - UNKNOWN_PENALTY
    best, before, pieces = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
    for start in range(n):
        here, end, following = best[start], start, table.trie
        for char in word[start : start + table.longest]:
            node = following.get(char)
            end += 1
            if node is None:
                break
            following, piece, score = node
            if piece >= 0 and here + score > best[end]:
                best[end], before[end], pieces[end] = here + score, start, piece
        if here + unknown > best[start + 1] and table.trie.get(word[start], (None, -1))[1] < 0:
            best[start + 1], before[start + 1], pieces[start + 1] = here + unknown, start, -1
    out, at = [], n
    while at:
        start = before[at]
        out.append([pieces[at]] if pieces[at] >= 0 else byte_ids(word[start:at], table))
        at = start
    return [i for part in reversed(out) for i in part]


def encode_words(words: DataFrame, table: PieceTable) -> DataFrame:
    """(word, ids) of distinct words, relationally.

    Substrings of bounded length are exploded and joined with the piece table; the edges found, and one
    edge per character that has no piece, are grouped by word; an aggregate over them in the order of
    their ends keeps the best score and edge per position, and a second one walks back.
    """
    spark = words.sparkSession
    pieces = spark.createDataFrame([(t, i, s) for t, (i, s) in table.pieces.items()], "sub string, id int, score double")
    ordinary = words.filter(~F.col("word").startswith("\n"))
    starts = ordinary.select("word", F.length("word").alias("n")).withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    ends = F.sequence(F.col("start") + 1, F.least("n", F.col("start") + table.longest))
    subs = starts.withColumn("end", F.explode(ends)).withColumn("sub", F.substring("word", F.col("start") + 1, F.col("end") - F.col("start")))
    # the piece table is as large as the vocabulary file, never more
    found = subs.join(F.broadcast(pieces), "sub", "left").filter(F.col("id").isNotNull() | (F.col("end") == F.col("start") + 1))
    edge = F.struct("end", "start", F.coalesce("score", F.lit(table.lowest - UNKNOWN_PENALTY)).alias("score"), F.coalesce("id", F.lit(-1)).alias("id"))
    lattice = found.groupBy("word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))
    n = F.length("word")
    nothing = F.lit(-1e300)
    first = F.struct(
        F.concat(F.array(F.lit(0.0)), F.array_repeat(nothing, n)).alias("best"),
        F.array_repeat(F.struct(F.lit(0).alias("start"), F.lit(-1).alias("id")), n + 1).alias("back"),
    )

    def put(values: Column, at: Column, value: Column) -> Column:
        return F.transform(values, lambda old, i: F.when(i == at, value).otherwise(old))

    def relax(state: Column, e: Column) -> Column:
        total = F.get(state["best"], e["start"]) + e["score"]
        better = total > F.get(state["best"], e["end"])
        return F.when(
            better,
            F.struct(
                put(state["best"], e["end"], total).alias("best"),
                put(state["back"], e["end"], F.struct(e["start"].alias("start"), e["id"].alias("id"))).alias("back"),
            ),
        ).otherwise(state)

    solved = lattice.select("word", F.aggregate("edges", first, relax)["back"].alias("back"))

    def walk(state: Column, at: Column) -> Column:
        edge = F.get(F.col("back"), at)
        step = F.struct(edge["start"].alias("start"), at.alias("end"), edge["id"].alias("id"))
        return F.when(
            state["at"] == at, F.struct(edge["start"].alias("at"), F.concat(F.array(step), state["path"]).alias("path"))
        ).otherwise(state)

    begin = F.struct(n.alias("at"), F.array().cast("array<struct<start:int,end:int,id:int>>").alias("path"))
    path = F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), begin, walk)["path"]
    walked = solved.select("word", path.alias("path"))

    def bytes_of(text: Column) -> Column:
        digits = F.hex(F.encode(text, "UTF-8"))
        places = F.sequence(F.lit(0), F.octet_length(text) - 1)
        return F.transform(places, lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int") + table.first_byte)

    spelled = F.transform("path", lambda e: F.when(e["id"] >= 0, F.array(e["id"])).otherwise(bytes_of(F.substring(F.col("word"), e["start"] + 1, e["end"] - e["start"]))))
    special = words.filter(F.col("word").startswith("\n")).select("word", bytes_of(F.substring("word", -1, 1)).alias("ids"))
    return walked.select("word", F.flatten(spelled).alias("ids")).unionByName(special)


def bodies_of(batch: pa.RecordBatch, text: str) -> Iterator[str | None]:
    column = batch.column(text)
    for start in range(0, len(column), ROWS):
        yield from column.slice(start, ROWS).to_pylist()


def frequent_words(docs: DataFrame, text: str) -> DataFrame:
    """Lattice words up to ``LONGEST_FREQUENT`` that make up at least 1 / FREQUENT of all, counted over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.RecordBatch.from_arrays([pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())], names=["word", "n"])
            for start in range(0, len(whole), 20_000):
                yield whole.slice(start, 20_000)
            counter.clear()

        for batch in batches:
            for body in bodies_of(batch, text):
                if body:
                    counter.update(words_of(body))
                    if len(counter) > 200_000:
                        yield from flush()
        yield from flush()

    counts = materialize(docs.select(F.col(f"`{text}`")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter((F.col("n") >= max(1, -(-total // FREQUENT))) & (F.length("word") <= LONGEST_FREQUENT)).select("word")


class Solved(dict):
    """Packed ids of the frequent words; other words are solved over the lattice, with a bounded memory of those met."""

    def __init__(self, table: PieceTable, found: Iterable):
        super().__init__(found)
        self.table, self.memory = table, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.memory.get(word)
        if ids is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            ids = self.memory[word] = array("i", viterbi(word, self.table)).tobytes()
        return ids


def encode(docs: DataFrame, text: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """All columns plus ``ids`` and ``n_pieces`` (replaced if they exist).

    Pieces maximise the sum of the model's scores word by word. Frequent words are looked up in the
    broadcast result of ``encode_words``; a rarer or very long word is solved over the same lattice in the
    task that holds it. Null texts have null ids and no pieces, empty texts have none.
    """
    table = load_pieces(path)
    known = encode_words(frequent_words(docs, text), table).toArrow()
    found = Solved(table, ((word, array("i", ids).tobytes()) for word, ids in zip(known["word"].to_pylist(), known["ids"].to_pylist())))
    shared = docs.sparkSession.sparkContext.broadcast(found)
    plain = docs.drop("ids", "n_pieces")
    kept = [f.name for f in plain.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows = [None if body is None else b"".join(map(solved.__getitem__, words_of(body))) if body else b"" for body in part.column(text).to_pylist()]
                sizes = np.array([0 if row is None else len(row) // 4 for row in rows], np.int64)
                ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                places = pa.array(ends, mask=np.array([row is None for row in rows] + [False]))
                flat = pa.array(np.frombuffer(b"".join(row for row in rows if row), np.int32))
                lists = pa.ListArray.from_arrays(places, flat)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [lists, pa.array(sizes)], names=kept + ["ids", "n_pieces"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema] + ["ids array<int>", "n_pieces bigint"])
    return plain.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "ids", column: str = "decoded", path: str = MODEL_PATH) -> DataFrame:
    """All columns plus the text of ``ids`` in ``column``: the exact inverse of ``encode``. Null ids give null."""
    table = load_pieces(path)
    texts = [t.replace(SPACE, " ").encode() for t in table.texts]
    texts[table.first_byte : table.first_byte + 256] = [bytes([b]) for b in range(256)]
    shared = docs.sparkSession.sparkContext.broadcast(pa.array(texts, pa.large_binary()))
    plain = docs.drop(column)
    kept = [f.name for f in plain.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                lists = part.column(ids)
                flat = lists.flatten()
                if flat.null_count:
                    raise ValueError("a piece id is null")
                # side by side the pieces' bytes are the texts, each with a blank before it
                taken = shared.value.take(flat)
                _, starts, data = taken.buffers()
                starts = np.frombuffer(starts, np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
                edges = starts[np.r_[0, np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))]].tolist()
                raw = memoryview(data) if data else b""
                bodies = [str(raw[low + 1 : high], "utf-8") if valid else None for low, high, valid in zip(edges, edges[1:], lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(bodies, pa.string())], names=kept + [column])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema] + [f"`{column}` string"])
    return plain.mapInArrow(run, schema)
