"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import keyed_hash, materialize

#: Multipliers of the subword hash, one per order.
MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917), np.uint32(668265263))
UNKNOWN = "und"
#: Code points that are hashed at once.
BLOCK = 1 << 20


@dataclass(frozen=True)
class LanguageSettings:
    #: Subword lengths in code points.
    orders: tuple[int, ...] = (2, 3, 4)
    buckets: int = 1 << 16
    width: int = 16
    #: Bound of the training sample, all languages together; each gets 4 documents at least.
    sample: int = 4096
    per_language: int = 400
    epochs: int = 6
    rate: float = 4.0
    #: Share of the sample kept from the gradient to calibrate temperature and rejection.
    calibration: float = 0.2
    #: Share of correct calibration documents that rejection may cost.
    reject: float = 0.01
    seed: int = 5


def hashed_subwords(points: np.ndarray, orders: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """For each order, the bucket of the subword that starts at each code point (white space included)."""
    for order in orders:
        if len(points) < order:
            continue
        hashed = np.zeros(len(points) - order + 1, np.uint32)
        for i in range(order):
            hashed = (hashed ^ points[i : len(points) - order + 1 + i]) * MIX[i % len(MIX)]
            hashed ^= hashed >> np.uint32(15)
        yield hashed & np.uint32(buckets - 1)


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points; white space of any length is one blank, and the ends are blanks."""
    return np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)


def blocks_of(points: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Long texts in blocks that overlap so that no subword is lost; those wholly in the overlap repeat."""
    for start in range(0, max(1, len(points) - longest + 1), BLOCK):
        yield points[start : start + BLOCK + longest - 1]


def bag(text: str, settings: LanguageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and the share of each."""
    total = np.zeros(settings.buckets, np.int64)
    for part in blocks_of(code_points(text), max(settings.orders)):
        for hashed in hashed_subwords(part, settings.orders, settings.buckets):
            total += np.bincount(hashed, minlength=settings.buckets)
    at = np.flatnonzero(total)
    return at, (total[at] / max(1, total.sum())).astype(np.float32)


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def train(bags: list, labels: np.ndarray, n_languages: int, settings: LanguageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Stochastic gradient descent, one document at a time; returns embeddings and output weights."""
    draw = np.random.default_rng(settings.seed)
    inner = draw.uniform(-1, 1, (settings.buckets, settings.width)).astype(np.float32) / settings.width
    outer = np.zeros((settings.width, n_languages), np.float32)
    steps, done = settings.epochs * len(bags), 0
    for _ in range(settings.epochs):
        for i in draw.permutation(len(bags)):
            at, share = bags[i]
            mean = share @ inner[at]
            slope = softmax(mean @ outer)
            slope[labels[i]] -= 1
            rate = settings.rate * (1 - done / steps)
            back = outer @ slope
            outer -= rate * np.outer(mean, slope)
            inner[at] -= rate * share[:, None] * back[None, :]
            done += 1
    return inner, outer


def temperature_of(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the smallest log loss on the calibration documents."""
    tried = np.geomspace(0.05, 20, 60)
    losses = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def sample_documents(docs: DataFrame, key: str, text: str, lang: str, settings: LanguageSettings) -> tuple[DataFrame, list[str]]:
    """Labelled texts, an even share per language, chosen by the hash of the key; and the languages."""
    usable = docs.select(*dict.fromkeys((key, text, lang))).filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).withColumn("_draw", keyed_hash(F.col(key), settings.seed))
    # a written table, so that the planner knows its size when it joins it with the texts
    sizes = materialize(usable.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("_n")), "languages")
    languages = sorted(row["_lang"] for row in sizes.select("_lang").collect())
    if not languages:
        return usable.limit(0), []
    quota = max(4, min(settings.per_language, settings.sample // len(languages)))
    # the share of the 64-bit hash range that yields about the quota; small languages come whole
    share = F.lit(float(quota)) / F.col("_n")
    most = F.when(share >= 1, F.lit(2**63 - 1)).otherwise((share * F.lit(float(2**64)) - F.lit(float(2**63))).cast("bigint"))
    limits = sizes.select("_lang", most.alias("_most"))
    return usable.join(limits, F.col(lang) == F.col("_lang")).filter(F.col("_draw") <= F.col("_most")), languages


def fit_language_model(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: LanguageSettings = LanguageSettings()):
    """(languages, score per bucket and language, temperature, rejection threshold).

    ``docs`` are the rows to learn from; every language in them is learned. Bags of whole texts are made in
    tasks; the driver gets those of about ``sample`` documents, or of 4 a language where that is more, each no
    larger than the bucket count. The table that scoring broadcasts has ``buckets`` rows and a column a language.
    """
    sample, languages = sample_documents(docs, key, text, lang, settings)
    if not languages:
        return [], np.zeros((settings.buckets, 0), np.float32), 1.0, 0.0

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for draw, group, body in zip(*(batch.column(c).to_pylist() for c in ("_draw", lang, text))):
                at, share = bag(body, settings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([draw]), pa.array([group], pa.string()), pa.array([at.astype(np.int32)]), pa.array([share])], names=["draw", "lang", "at", "share"]
                )

    rows = sample.select("_draw", lang, text).mapInArrow(bags, "draw bigint, lang string, at array<int>, share array<float>").toArrow()
    place = {name: i for i, name in enumerate(languages)}
    found = [(x.values.to_numpy(), y.values.to_numpy()) for x, y in zip(rows["at"], rows["share"])]
    order = sorted(zip(rows["draw"].to_pylist(), rows["lang"].to_pylist(), (len(x[0]) for x in found), range(len(found))))
    labels = np.array([place[group] for _, group, _, _ in order])
    made = [found[i] for *_, i in order]
    held = np.random.default_rng(settings.seed).random(len(made)) < settings.calibration
    fitted = np.flatnonzero(~held) if (~held).any() else np.arange(len(made))
    inner, outer = train([made[i] for i in fitted], labels[fitted], len(languages), settings)
    table = inner @ outer
    check = np.flatnonzero(held) if held.any() else fitted
    scores = np.array([made[i][1] @ table[made[i][0]] for i in check])
    temperature = temperature_of(scores, labels[check])
    sure = softmax(scores / temperature)
    right = sure.argmax(axis=1) == labels[check]
    threshold = float(np.quantile(sure.max(axis=1)[right], settings.reject)) if right.any() else 0.0
    return languages, (table / temperature).astype(np.float32), 1.0, threshold


def identify(docs: DataFrame, model, text: str = "text", settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """All columns plus ``lang_pred``, ``score`` and ``rejected`` (replaced if they exist).

    ``score`` is the calibrated probability of ``lang_pred``; ``rejected`` marks those below the
    calibrated threshold. Null texts and texts without a letter are ``und`` with score 0 and rejected, as
    are all texts when there was nothing to learn from. Ties go to the first language by name.
    """
    languages, table, _, threshold = model
    added = ("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(table)
    plain = docs.drop(*added).withColumn("_letter", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    kept = [f for f in plain.schema if f.name != "_letter"]

    def scores_of(body: str) -> np.ndarray:
        sums, n = np.zeros(len(languages)), 0
        for part in blocks_of(code_points(body), max(settings.orders)):
            for hashed in hashed_subwords(part, settings.orders, settings.buckets):
                sums += shared.value.take(hashed, axis=0).sum(axis=0, dtype=np.float64)
                n += len(hashed)
        return softmax(sums / max(1, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sure = [], []
            for body, letter in zip(batch.column(text).to_pylist(), batch.column("_letter").to_pylist()):
                if not letter or not languages:
                    names.append(UNKNOWN)
                    sure.append(0.0)
                    continue
                chances = scores_of(body)
                best = int(chances.argmax())
                names.append(languages[best])
                sure.append(float(min(1.0, chances[best])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(names, pa.string()), pa.array(sure, pa.float64()), pa.array([s < threshold or n == UNKNOWN for s, n in zip(sure, names)])],
                names=[f.name for f in kept] + list(added),
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string", "score double", "rejected boolean"])
    return plain.mapInArrow(run, schema)
