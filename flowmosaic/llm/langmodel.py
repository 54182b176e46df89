"""Gated recurrent language model: class-factored output, state carried through whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import keyed_hash, materialize, texts_of, word_chunks, word_counts

END = b""
#: Words with at least 1 / FREQUENT of all training tokens are broadcast: there cannot be more of them.
FREQUENT = 1 << 20
LOG10 = float(np.log(10))


@dataclass(frozen=True)
class ModelSettings:
    hidden: int = 16
    #: Classes and words of each; 0: both are ``growth`` times the sixth root of the training tokens, so
    #: that the network's vocabulary grows as their cube root.
    classes: int = 0
    class_size: int = 0
    growth: float = 1.55
    #: Ends of the rounds as shares of the documents, by hash of the key: every training document is
    #: learned from once. After each round the tasks' parameters are averaged.
    rounds: tuple[float, ...] = (1 / 64, 1 / 16, 1 / 4, 1.0)
    #: Tokens back through which gradients flow, and documents side by side.
    window: int = 16
    lanes: int = 1024
    rate: float = 0.02
    #: Tokens that a task lays in lanes at a time, and parameters in a row that tasks hand on.
    block: int = 1_000_000
    slice: int = 4096
    #: Tokens a task scores at a time.
    buffer: int = 4_000_000
    seed: int = 9


def tokens_of(raw: bytes | None) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words of a whole text, then one end."""
    for words in word_chunks(raw.lower()) if raw else ():
        yield words
    yield [END]


def sized(s: ModelSettings, tokens: int) -> ModelSettings:
    """Settings with the vocabulary that a corpus of so many tokens gets, where it is not fixed."""
    side = max(4, round(s.growth * tokens ** (1 / 6)))
    return replace(s, classes=s.classes or side, class_size=s.class_size or side)


def shapes(s: ModelSettings) -> dict[str, tuple[int, ...]]:
    vocabulary = s.classes * s.class_size
    return {
        "inputs": (vocabulary + 1, 3 * s.hidden), "back": (s.hidden, 3 * s.hidden),
        "class_w": (s.hidden, s.classes), "class_b": (s.classes,),
        "word_w": (s.classes, s.hidden, s.class_size), "word_b": (s.classes, s.class_size),
    }


def fresh(s: ModelSettings, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Small random gates; output biases that reproduce the unigram counts (by class, then in the class)."""
    draw = np.random.default_rng(s.seed)
    p = {k: draw.normal(0, 0.1, shape).astype(np.float32) for k, shape in shapes(s).items()}
    by_class = counts.reshape(s.classes, s.class_size) + 0.5
    p["class_b"] = np.log(by_class.sum(axis=1)).astype(np.float32)
    p["word_b"] = np.log(by_class).astype(np.float32)
    return p


def packed(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in p]).astype(np.float64)


def unpacked(flat: np.ndarray, s: ModelSettings) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in shapes(s).items():
        size = int(np.prod(shape))
        out[k] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = 0.5 * x
    np.tanh(out, out=out)
    out += 1
    out *= 0.5
    return out


def product(a: np.ndarray, w: np.ndarray) -> np.ndarray:
    """a @ w, laid out by columns: gates and classes are then worked on as long runs over lanes."""
    return (w.T @ a.T).T


def step(p: dict, ids: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
    """One gated step for every lane: (new state, what the gradient needs)."""
    h = state.shape[1]
    inner, outer = np.asfortranarray(p["inputs"][ids]), product(state, p["back"])
    gates = sigmoid(inner[:, : 2 * h] + outer[:, : 2 * h])
    update, reset = gates[:, :h], gates[:, h:]
    fresh_state = np.tanh(inner[:, 2 * h :] + reset * outer[:, 2 * h :])
    return fresh_state + update * (state - fresh_state), (ids, state, update, reset, fresh_state, outer[:, 2 * h :])


def softmax(x: np.ndarray) -> np.ndarray:
    powers = np.exp(x - x.max(axis=1)[:, None])
    powers /= powers.sum(axis=1)[:, None]
    return powers


def by_number(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by their number, and where each number below ``n`` begins among them and the last one ends."""
    # numbers of 16 bits are sorted by radix
    order = np.argsort(numbers.astype(np.uint16) if n < 1 << 16 else numbers, kind="stable")
    return order, np.r_[0, np.cumsum(np.bincount(numbers, minlength=n)[:n])]


def log_chance(x: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Log probability of one column of each row."""
    top = x.max(axis=1)
    return x[np.arange(len(x)), picked] - top - np.log(np.exp(x - top[:, None]).sum(axis=1))


def word_log_probs(p: dict, states: np.ndarray, ids: np.ndarray, s: ModelSettings) -> np.ndarray:
    """Natural log probability of each word id: of its class, times of the word in the class."""
    kind, inside = np.divmod(ids, s.class_size)
    out = log_chance(product(states, p["class_w"]) + p["class_b"], kind).astype(np.float64)
    order, edges = by_number(kind, s.classes)
    sorted_states, sorted_inside, logs = states[order], inside[order], []
    for c in range(s.classes):
        at = slice(edges[c], edges[c + 1])
        if edges[c] < edges[c + 1]:
            logs.append(log_chance(product(sorted_states[at], p["word_w"][c]) + p["word_b"][c], sorted_inside[at]))
    if logs:
        out[order] += np.concatenate(logs)
    return out


def gradients(p: dict, inputs: np.ndarray, targets: np.ndarray, live: np.ndarray, state: np.ndarray, s: ModelSettings, opens: np.ndarray | None = None) -> tuple[dict, np.ndarray]:
    """Gradient of the mean log loss over one window (time, lane), flowing back to its first token only.

    ``opens`` marks the first tokens of documents: there the state is cleared and no gradient passes.
    """
    h, trace, states = s.hidden, [], []
    opens = np.zeros(inputs.shape, bool) if opens is None else opens
    for t in range(len(inputs)):
        if opens[t].any():
            state = np.where(opens[t][:, None], np.float32(0), state)
        state, kept = step(p, inputs[t], state)
        trace.append(kept)
        states.append(state)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    flat, ids, on = np.concatenate(states), targets.ravel(), live.ravel()
    kind, inside = np.divmod(ids, s.class_size)
    scale = (on / max(1, on.sum())).astype(np.float32)
    slope = softmax(product(flat, p["class_w"]) + p["class_b"])
    slope[np.arange(len(ids)), kind] -= 1
    slope *= scale[:, None]
    g["class_w"], g["class_b"] = flat.T @ slope, slope.sum(axis=0)
    into = product(slope, p["class_w"].T)
    order, edges = by_number(np.where(on > 0, kind, s.classes), s.classes)
    for c in range(s.classes):
        at = order[edges[c] : edges[c + 1]]
        if not len(at):
            continue
        mine = flat[at]
        slope = softmax(product(mine, p["word_w"][c]) + p["word_b"][c])
        slope[np.arange(len(at)), inside[at]] -= 1
        slope *= scale[at, None]
        g["word_w"][c], g["word_b"][c] = mine.T @ slope, slope.sum(axis=0)
        into[at] += slope @ p["word_w"][c].T
    lanes = inputs.shape[1]
    carry, gates, backs = np.zeros_like(state), [], []
    for t in range(len(inputs) - 1, -1, -1):
        ids, before, update, reset, new, outer = trace[t]
        up = into[t * lanes : (t + 1) * lanes] + carry
        rest = 1 - update
        to_new = up * rest * (1 - new**2)
        to_update = up * (before - new) * update * rest
        to_reset = to_new * outer * reset * (1 - reset)
        gates.append(np.concatenate([to_update, to_reset, to_new], axis=1))
        backs.append(np.concatenate([to_update, to_reset, to_new * reset], axis=1))
        carry = up * update + product(backs[-1], p["back"].T)
        if opens[t].any():
            carry = np.where(opens[t][:, None], 0, carry)
    g["back"] = np.concatenate([kept[1] for kept in trace[::-1]]).T @ np.concatenate(backs)
    ids = inputs[::-1].ravel()
    order, edges = by_number(ids, len(p["inputs"]))
    seen = np.flatnonzero(edges[1:] > edges[:-1])
    g["inputs"][seen] = np.add.reduceat(np.ascontiguousarray(np.concatenate(gates))[order], edges[seen])
    return g, state


@dataclass
class Adam:
    """Moments of the gradient, carried over all windows of a task."""

    first: dict
    second: dict
    turn: int = 0

    def update(self, p: dict, g: dict, rate: float) -> None:
        self.turn += 1
        for k in p:
            self.first[k] = 0.9 * self.first[k] + 0.1 * g[k]
            self.second[k] = 0.99 * self.second[k] + 0.01 * g[k] ** 2
            p[k] -= rate * (self.first[k] / (1 - 0.9**self.turn)) / (np.sqrt(self.second[k] / (1 - 0.99**self.turn)) + 1e-6)


def train_on(p: dict, documents: list[np.ndarray], s: ModelSettings, adam: Adam, rate: float) -> int:
    """Truncated back-propagation over documents laid end to end in lanes; returns the tokens learned from.

    The state stays in its lane from window to window and is cleared where a document begins. The last
    lane is filled up with positions that carry no gradient, so every token counts.
    """
    stream = np.concatenate(documents)
    opens = np.zeros(len(stream), bool)
    opens[np.cumsum([0] + [len(d) for d in documents[:-1]])] = True
    start_id = s.classes * s.class_size
    before = np.where(opens, start_id, np.r_[start_id, stream[:-1]])
    lanes = max(1, min(s.lanes, len(stream) // (4 * s.window)))
    length = -(-len(stream) // lanes)
    fill = np.zeros(lanes * length - len(stream), np.int64)
    live = np.r_[np.ones(len(stream), bool), fill.astype(bool)]
    grid, previous, first, live = (x.reshape(lanes, length).T for x in (np.r_[stream, fill], np.r_[before, fill], np.r_[opens, fill.astype(bool)], live))
    state = np.zeros((lanes, s.hidden), np.float32)
    for at in range(0, length, s.window):
        part = slice(at, at + s.window)
        g, state = gradients(p, previous[part], grid[part], live[part], state, s, first[part])
        adam.update(p, g, rate / np.sqrt(1 + adam.turn / 100))
    return len(stream)


@dataclass
class LanguageModel:
    """What scoring needs. ``counts`` holds word bytes -> (count, id or -1) of the frequent words only."""

    settings: ModelSettings
    parameters: np.ndarray
    counts: dict
    unknown: int
    tokens: int
    distinct: int
    outside_tokens: int
    outside_distinct: int


SLICES = "slice int, task int, n double, part binary"


def average(rows: pa.Table) -> pa.Table:
    """Mean of the parameters of some tasks, weighted by their tokens; the order of arrival does not matter."""
    rows = rows.select(["slice", "task", "n", "part"]).sort_by("task")
    n = rows["n"].to_numpy()
    total = sum(w * np.frombuffer(part, np.float32).astype(np.float64) for w, part in zip(n, rows["part"].to_pylist()))
    mean = (total / n.sum()).astype(np.float32).tobytes()
    return pa.table({"slice": rows["slice"][:1], "task": rows["task"][:1], "n": pa.array([float(n.sum())]), "part": pa.array([mean], pa.binary())})


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: ModelSettings = ModelSettings()) -> tuple[LanguageModel, DataFrame]:
    """Learn from all rows of ``docs``; returns the model and the counts of the words that are not frequent.

    Word counts and gates learn from every training token. The vocabulary of the network is the most
    frequent words, more of them in a larger corpus; all others share one word, within which they are told
    apart by their counts. Gates are trained in tasks, each on the documents of its partition, and averaged
    after every round. Null texts are one end; repeated rows count as often as they come.
    """
    spark = docs.sparkSession
    counts = materialize(word_counts(docs, text, lambda words: b" ".join(words).lower().split()), "counts")
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = docs.count()
    tokens, distinct = words + ends, distinct + (ends > 0)
    s = sized(settings, tokens)
    least = -(-tokens // FREQUENT)
    top = counts.filter(F.col("n") >= least).toArrow()
    order = sorted(zip((-x for x in top["n"].to_pylist()), (w.encode() for w in top["word"].to_pylist())))
    size = s.classes * s.class_size
    vocabulary = [(END, ends)] * (ends > 0) + [(w, -n) for n, w in order[: size - 2]]
    known = {w: (-n, -1) for n, w in order}
    known |= {w: (n, i) for i, (w, n) in enumerate(vocabulary)}
    unknown = size - 1
    inside = sum(n for _, n in vocabulary)
    unigram = np.zeros(size)
    unigram[: len(vocabulary)] = [n for _, n in vocabulary]
    unigram[unknown] = tokens - inside
    # classes of like size in words; each gets frequent and rare words in turn
    place = np.arange(size).reshape(s.class_size, s.classes).T.ravel()
    at = np.empty(size, int)
    at[place] = np.arange(size)
    known = {w: (n, int(at[i]) if i >= 0 else -1) for w, (n, i) in known.items()}
    model = LanguageModel(s, packed(fresh(s, unigram[place])), known, int(at[unknown]), tokens, distinct, tokens - inside, max(0, distinct - len(vocabulary)))
    draw = keyed_hash(F.col(key), s.seed)
    edges = [int(-(2**63) + x * (2**64 - 1)) for x in (0.0, *s.rounds[:-1])] + [2**63 - 1]

    for turn, (above, up_to) in enumerate(zip(edges, edges[1:])):
        chosen = docs.filter((draw <= F.lit(up_to)) & ((draw > F.lit(above)) if turn else F.lit(True)))
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch], turn: int = turn, shared=shared) -> Iterator[pa.RecordBatch]:
            now = shared.value
            p = unpacked(now.parameters, s)
            adam = Adam(*({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2)))
            places = network_places(now)
            lists, held, n = [], 0, 0
            rate = s.rate * 0.7**turn
            for batch in batches:
                for raw in texts_of(batch):
                    lists.append(ids_of(raw, places, now.unknown))
                    held += len(lists[-1])
                    if held >= s.block:
                        n += train_on(p, lists, s, adam, rate)
                        lists, held = [], 0
            if lists:
                n += train_on(p, lists, s, adam, rate)
            if n:
                flat, task = packed(p).astype(np.float32), TaskContext.get().partitionId()
                parts = [flat[at : at + s.slice].tobytes() for at in range(0, len(flat), s.slice)]
                size = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(size), pa.int32()), pa.array([task] * size, pa.int32()), pa.array([float(n)] * size), pa.array(parts, pa.binary())],
                    names=["slice", "task", "n", "part"],
                )

        # tasks' parameters are averaged in two steps; one row per slice reaches the driver
        made = chosen.select(F.col(text).alias("text")).mapInArrow(learn, SLICES)
        some = made.groupBy("slice", F.pmod("task", F.lit(64)).alias("some")).applyInArrow(average, SLICES)
        slices = some.groupBy("slice").applyInArrow(average, SLICES).toArrow().sort_by("slice")
        if slices.num_rows:
            model.parameters = np.frombuffer(b"".join(slices["part"].to_pylist()), np.float32).astype(np.float64)
    return model, counts.filter(F.col("n") < least)


def network_places(model: LanguageModel) -> dict:
    """Network id of every word that has one."""
    return {w: i for w, (_, i) in model.counts.items() if i >= 0}


def ids_of(raw: bytes | None, places: dict, unknown: int) -> np.ndarray:
    """Network ids of a whole text, its end included."""
    parts = [np.fromiter(map(places.get, words, repeat(unknown)), np.int64, len(words)) for words in tokens_of(raw)]
    return np.concatenate(parts)


class FrequentWords:
    """The model's frequent words by place: log10 of count and one, network id, whether it is outside the network.

    The last place is for every other word.
    """

    def __init__(self, model: LanguageModel):
        n, ids = np.array([*model.counts.values(), (0, -1)], np.int64).T
        self.places = dict(zip(model.counts, range(len(model.counts))))
        self.log, self.outer = np.log10(n + 1.0), ids < 0
        self.outer_log = np.where(self.outer, self.log, 0.0)
        self.ids = np.where(self.outer, model.unknown, ids)

    def look_up(self, raw: bytes | None) -> tuple[np.ndarray, tuple]:
        """Network ids of a whole text, and (tokens, known, sum of logs, that of outer words, outer words, hashes of the others)."""
        ids, others, known, base, logs, outside = [], [], 0, 0.0, 0.0, 0
        for words in tokens_of(raw):
            at = np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))
            ids.append(self.ids[at])
            rest = np.flatnonzero(at < 0).tolist()
            others.append(np.fromiter(map(xxhash.xxh64_intdigest, map(words.__getitem__, rest), repeat(42)), np.uint64, len(rest)))
            known += len(words) - len(rest)
            base += self.log[at].sum()
            logs += self.outer_log[at].sum()
            outside += int(self.outer[at].sum())
        out = np.concatenate(ids)
        return out, (len(out), known, base, logs, outside, np.concatenate(others).view(np.int64))


def document_scores(documents: list[np.ndarray], p: dict, s: ModelSettings) -> np.ndarray:
    """Log10 probability of each id sequence. All documents advance together, the longest first; states
    are carried from window to window until a document ends."""
    sizes = np.array([len(d) for d in documents])
    order = np.argsort(-sizes, kind="stable")
    flat, sizes = np.concatenate([documents[i] for i in order]), sizes[order]
    starts = np.cumsum(sizes) - sizes
    sums = np.zeros(len(sizes))
    state = np.zeros((len(sizes), s.hidden), np.float32)
    previous = np.full(len(sizes), s.classes * s.class_size)
    t = 0
    while t < sizes[0]:
        states, ids, owners, held = [], [], [], 0
        while t < sizes[0] and held < 60_000:
            n = int(np.searchsorted(-sizes, -t, side="left"))  # documents longer than t
            state, previous = state[:n], previous[:n]
            state, _ = step(p, previous, state)
            previous = flat[starts[:n] + t]
            states.append(state)
            ids.append(previous)
            owners.append(np.arange(n))
            held += n
            t += 1
        owner = np.concatenate(owners)
        logs = word_log_probs(p, np.concatenate(states), np.concatenate(ids), s)
        sums += np.bincount(owner, logs, len(sizes))
    out = np.empty(len(sizes))
    out[order] = sums / LOG10
    return out


def score(docs: DataFrame, model: LanguageModel, rare: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of every row; whole texts, null as empty.

    Tasks score frequent words as they go. The other words of a document leave it as 64-bit hashes,
    meet their counts in a join on the hash, and come back as one sum per document. Repeated rows are
    scored each for itself.
    """
    s = model.settings
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        p, frequent = unpacked(now.parameters, s), FrequentWords(now)
        keys: list = []
        lists: list[np.ndarray] = []
        parts: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            scores = document_scores(lists, p, s)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(keys)] + [pa.array([x[i] for x in parts], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))]
                + [pa.array(scores), pa.array([x[5] for x in parts], pa.list_(pa.int64()))],
                names=["key", "n", "known", "base", "outside_logs", "outside", "network", "rare"],
            )

        for batch in batches:
            keys.append(batch.column("key"))
            for raw in texts_of(batch):
                out, sums = frequent.look_up(raw)
                lists.append(out)
                held += len(out)
                parts.append(sums)
            if held > s.buffer:
                yield flush()
                keys, lists, parts, held = [], [], [], 0
        if lists:
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n bigint, known bigint, base double, outside_logs double, outside bigint, network double, rare array<bigint>"
    first = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    rows = materialize(first.withColumn("_row", F.monotonically_increasing_id()), "scored")
    table = rare.groupBy(F.xxhash64("word").alias("_hash")).agg(F.sum("n").alias("n")).select("_hash", F.log10(F.col("n") + 1.0).alias("_log"))
    sums = (
        rows.select("_row", F.explode("rare").alias("_hash")).join(table, "_hash")
        .groupBy("_row").agg(F.count("*").alias("_found"), F.sum("_log").alias("_logs"))
    )
    found, logs = F.coalesce("_found", F.lit(0)), F.coalesce("_logs", F.lit(0.0))
    base = float(np.log10(model.tokens + model.distinct + 1))
    outside = float(np.log10(model.outside_tokens + model.outside_distinct + 1))
    return rows.drop("rare").join(sums, "_row", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_tokens"), (F.col("known") + found).alias("n_known"),
        (F.col("base") + logs - F.col("n") * base).alias("base_score"),
        (F.col("network") + F.col("outside_logs") + logs - F.col("outside") * outside).alias("score"),
    )
