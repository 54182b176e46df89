"""Toxicity from confirmed positives and unlabelled text: non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.llm.common import keyed_hash, materialize, texts_of, word_chunks

BEGINNINGS = (4, 5, 6)
EDGE = bytes(b for b in range(33, 127) if not chr(b).isalnum())


@dataclass(frozen=True)
class ToxicitySettings:
    buckets: int = 1 << 18
    #: Bounds of the training sample.
    positives: int = 6000
    unlabelled: int = 18000
    #: A word bucket counts if so many sampled documents have it.
    min_documents: int = 12
    epochs: int = 40
    batches: int = 24
    rate: float = 0.1
    #: Pull of every word weight towards zero, in units of a normalised step.
    shrink: float = 0.3
    #: Words whose weight stays above this are fitted once more, all but free of that pull.
    strong: float = 0.5
    refit_shrink: float = 0.02
    #: The prior when nothing says better: share of toxic documents.
    prior: float = 0.1
    seed: int = 11


def word_buckets(raw: bytes | None, buckets: int, memory: dict[bytes, tuple]) -> np.ndarray:
    """Distinct hashed words of a whole text and their beginnings of 4 to 6 letters.

    Words are lower case without punctuation around; beginnings catch inflected forms.
    """
    if not raw:
        return np.zeros(0, np.int64)
    found: set[bytes] = set()
    for words in word_chunks(raw.decode().lower().encode()):
        found.update(words)
    if len(memory) > 300_000:
        memory.clear()
    out: set[int] = set()
    digest = xxhash.xxh64_intdigest
    for word in found:
        at = memory.get(word)
        if at is None:
            bare = word.strip(EDGE).decode()
            forms = [bare] + [bare[:n] + "_" for n in BEGINNINGS if len(bare) >= n] if bare else []
            at = memory[word] = tuple({digest(form, 1) & (buckets - 1) for form in forms})
        out.update(at)
    return np.fromiter(out, np.int64, len(out))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Rows:
    """Documents as lists of word places, laid end to end."""

    def __init__(self, words: np.ndarray, offsets: np.ndarray, inner: np.ndarray, chosen: np.ndarray):
        """Of documents given as words and offsets, the chosen ones; ``inner`` is a word's place or -1."""
        parts, sizes = [], []
        for start in range(0, len(chosen), 1000):
            stop = min(len(chosen), start + 1000)
            places = inner[words[offsets[start] : offsets[stop]]]
            owner = np.repeat(np.arange(stop - start), np.diff(offsets[start : stop + 1]))
            keep = chosen[start:stop][owner] & (places >= 0)
            parts.append(places[keep])
            sizes.append(np.bincount(owner[keep], minlength=stop - start))
        self.at = np.concatenate(parts)
        self.sizes = np.concatenate(sizes)[chosen]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))

    def pick(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, position of their document in ``which``)."""
        sizes = self.sizes[which]
        owner = np.repeat(np.arange(len(which)), sizes)
        offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.at[np.repeat(self.starts[which], sizes) + offset], owner


def train_nnpu(positive: Rows, unlabelled: Rows, prior: float, width: int, settings: ToxicitySettings, shrink: float) -> np.ndarray:
    """Weights and, last, a bias that minimise the non-negative risk under the logistic loss.

    risk = prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)]). Where the second part
    falls below zero in a batch, only the first part gives the step. Words can
    only speak for toxicity: their weights stay at zero or above, so a long clean text cannot outweigh
    a toxic word, and a pull towards zero removes what is noise.
    """
    draw = np.random.default_rng(settings.seed)
    weights, first, second = (np.zeros(width + 1) for _ in range(3))
    weights[-1] = np.log(prior / (1 - prior))
    n_p, n_u, turn = len(positive.sizes), len(unlabelled.sizes), 0
    turns = settings.epochs * settings.batches + 1

    def side(rows: Rows, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, owner = rows.pick(which)
        return np.bincount(owner, weights[at], len(which)).astype(float) + weights[-1], at, owner

    def slope(at: np.ndarray, owner: np.ndarray, each: np.ndarray) -> np.ndarray:
        out = np.bincount(at, each[owner], width + 1).astype(float)
        out[-1] = each.sum()
        return out

    for _ in range(settings.epochs):
        shuffled_p, shuffled_u = draw.permutation(n_p), draw.permutation(n_u)
        for k in range(settings.batches):
            which_p, which_u = shuffled_p[k :: settings.batches], shuffled_u[k :: settings.batches]
            if not len(which_p) or not len(which_u):
                continue
            score_p, at_p, own_p = side(positive, which_p)
            score_u, at_u, own_u = side(unlabelled, which_u)
            negative = np.logaddexp(0, score_u).mean() - prior * np.logaddexp(0, score_p).mean()
            of_negative = slope(at_u, own_u, sigmoid(score_u) / len(which_u)) - slope(at_p, own_p, prior * sigmoid(score_p) / len(which_p))
            gradient = slope(at_p, own_p, -prior * sigmoid(-score_p) / len(which_p))
            if negative >= 0:
                gradient += of_negative
            turn += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
            step[:-1] += shrink
            weights -= settings.rate * (1 - turn / turns) * step
            weights[:-1] = np.maximum(weights[:-1], 0)
    return weights


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: ToxicitySettings = ToxicitySettings()) -> np.ndarray:
    """Weight per bucket and, last, the bias, from the rows given.

    Positives are documents with ``labels.toxic`` = 1; unlabelled text is drawn from all documents
    whatever their label, so it holds positives in their natural share, the class prior, which is
    estimated on the labelled rows. Both samples are bounded and chosen by hashes of the key. Without
    positives every score is the prior. Of contradicting labels of one key the toxic one counts.
    """
    flags = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("toxic").alias("_toxic"))
    known_ids = docs.select(key).join(flags, key, "left")  # ids only: texts are not shuffled
    sums = known_ids.agg(F.sum((F.col("_toxic") == 1).cast("int")), F.count("_toxic"), F.count("*")).first()
    positives, labelled, total = sums[0] or 0, sums[1] or 0, sums[2]
    prior = min(0.5, max(1e-4, positives / labelled)) if labelled else settings.prior

    def drawn(seed: int, wanted: int, there: int):
        share = min(1.0, wanted / max(1, there))
        return keyed_hash(F.col(key), seed) <= F.lit(2**63 - 1 if share >= 1 else int(-(2**63) + share * (2**64 - 1)))

    # about ``positives`` ids at most, whatever the size of the tables
    marked_ids = known_ids.filter("_toxic = 1").filter(drawn(settings.seed, settings.positives, positives)).select(key).distinct()
    flagged = docs.select(key, text).join(F.broadcast(marked_ids.withColumn("_marked", F.lit(True))), key, "left")
    sample = flagged.select(
        keyed_hash(F.col(key), settings.seed + 1).alias("draw"), F.coalesce("_marked", F.lit(False)).alias("toxic"),
        drawn(settings.seed + 1, settings.unlabelled, total).alias("any"), text,
    ).filter("toxic OR any")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple] = {}
        for batch in batches:
            rows = [np.sort(word_buckets(raw, settings.buckets, memory)).astype(np.int32) for raw in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("draw", "toxic", "any")] + [pa.array(rows, pa.list_(pa.int32()))], names=["draw", "toxic", "any", "at"])

    made = materialize(sample.mapInArrow(features, "draw bigint, toxic boolean, any boolean, at array<int>"), "features")
    least = min(settings.min_documents, max(1, made.count() // 50))
    often = made.select(F.explode("at").alias("b")).groupBy("b").count().filter(F.col("count") >= least).select("b").toPandas()["b"]
    kept = np.sort(often.to_numpy(np.int64))
    place = np.full(settings.buckets, -1, np.int32)
    place[kept] = np.arange(len(kept))
    known = docs.sparkSession.sparkContext.broadcast(place)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p := known.value[x.values.to_numpy(zero_copy_only=False)])[p >= 0] for x in batch.column("at")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("draw", "toxic", "any")] + [pa.array(rows, pa.list_(pa.int32()))], names=["draw", "toxic", "any", "at"])

    # only places of words that enough documents have come to the driver
    drawn_rows = made.mapInArrow(placed, made.schema).toArrow()
    got = drawn_rows.take(pa.compute.sort_indices(drawn_rows, [("draw", "ascending"), ("toxic", "ascending")]))
    del drawn_rows
    marked, plain = (np.array(got[c].to_pylist(), bool) for c in ("toxic", "any"))
    weights = np.zeros(settings.buckets + 1)
    weights[-1] = np.log(prior / (1 - prior))
    if not marked.any() or not plain.any():
        return weights
    lists = got["at"].combine_chunks()
    del got
    pa.default_memory_pool().release_unused()
    found, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    inner = np.arange(len(kept), dtype=np.int32)
    for shrink in (settings.shrink, settings.refit_shrink):
        sides = (Rows(found, offsets, inner, side) for side in (marked, plain))
        fitted = train_nnpu(*sides, prior, int(inner.max(initial=-1)) + 1, settings, shrink)
        used = np.flatnonzero(inner >= 0)
        weights[:] = 0
        weights[kept[used]], weights[-1] = fitted[:-1], fitted[-1]
        strong = used[fitted[:-1] > settings.strong]
        inner = np.full(len(kept), -1, np.int32)
        inner[strong] = np.arange(len(strong))
    return weights


def score_toxicity(docs: DataFrame, weights: np.ndarray, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """All columns plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), replaced if columns of the names given exist.

    Null and empty texts get the score of the bias alone. Every text is read whole.
    """
    buckets = len(weights) - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    plain = docs.drop(score, predicted)
    kept = [f.name for f in plain.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[bytes, tuple] = {}
        for batch in batches:
            sums = [shared.value[word_buckets(raw, buckets, memory)].sum() + shared.value[-1] for raw in texts_of(batch, text)]
            chance = sigmoid(np.array(sums, float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))], names=kept + [score, predicted]
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema] + [f"`{score}` double", f"`{predicted}` int"])
    return plain.mapInArrow(run, schema)
