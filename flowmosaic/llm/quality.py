"""Quality rules: how far a document's histograms lie from those of its language."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowmosaic.llm.common import materialize, texts_of, word_chunks, word_counts

SYMBOLS = b"#*$%&|<>"
CLASSES = ("vowel", "consonant", "upper", "digit", "beyond_ascii", "stop", "symbol", "other", "space", "line")
EDGE = b".,;:!?\"'()[]{}"


@dataclass(frozen=True)
class DivergenceRules:
    """Distances are square roots of the Jensen-Shannon divergence in bits, 0 to 1."""

    common_words: int = 64
    #: A language has a reference if its text is as long as so many of the shortest that are judged.
    reference_texts: int = 20
    #: References that a task keeps ready.
    ready: int = 256
    max_class_distance: float = 0.30
    min_chars: int = 200
    max_word_distance: float = 0.42
    min_words: int = 100


def class_table() -> np.ndarray:
    """Class of every byte; continuation bytes of UTF-8 belong to no class (255)."""
    table = np.full(256, CLASSES.index("other"), np.uint8)
    for name, members in (
        ("vowel", b"aeiou"), ("consonant", b"bcdfghjklmnpqrstvwxyz"), ("upper", bytes(range(65, 91))),
        ("digit", b"0123456789"), ("stop", b".,;:!?'\"-()"), ("symbol", SYMBOLS),
        ("space", b" \t\x0b\x0c\r"), ("line", b"\n"), ("beyond_ascii", bytes(range(0xC0, 256))),
    ):
        table[list(members)] = CLASSES.index(name)
    table[0x80:0xC0] = 255
    return table


CLASS_OF = class_table()
WIDTH = len(CLASSES)


def class_counts(raw: bytes) -> np.ndarray:
    """Code points of each class."""
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=256)[:WIDTH]


def fold_words(words: list[bytes]) -> list[bytes]:
    """Words as the histograms know them: lower case, no punctuation around."""
    return [w.lower().strip(EDGE) for w in words]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that the text has twice or more."""
    if len(ids) < 4:
        return 0
    top = int(ids.max()) + 1
    pairs = ids[:-1] * top + ids[1:]
    if top >= 1 << 20:  # three ids no longer fit 63 bits: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, inverse, counts = np.unique(pairs[:-1] * top + ids[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence of two histograms, in bits."""
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2

    def half(a: np.ndarray) -> float:
        has = a > 0
        return float((a[has] * np.log2(a[has] / middle[has])).sum())

    return float(np.sqrt(max(0.0, (half(p) + half(q)) / 2)))


def language_references(docs: DataFrame, text: str, lang: str, rules: DivergenceRules) -> tuple[DataFrame | None, tuple]:
    """One row per language (_lang, _classes, _chars, _words, _shares, _size), and the same of all documents.

    Counted over all documents: code points of each class and of all, the common words with their
    counts, and how many words there are. None and an empty tuple without documents.
    """

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for group, raw in zip(batch.column(lang).to_pylist(), texts_of(batch, text)):
                held = sums.setdefault(group, np.zeros(WIDTH + 1, np.int64))
                held[WIDTH] += 1
                if raw:
                    held[:WIDTH] += class_counts(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string())] + [pa.array([int(s[i]) for s in sums.values()], pa.int64()) for i in range(WIDTH + 1)],
            names=[lang, *(f"c{i}" for i in range(WIDTH)), "rows"],
        )

    names = [*(f"c{i}" for i in range(WIDTH)), "rows"]
    light = docs.select(F.col(lang).cast("string").alias(lang), text)
    by_lang = materialize(
        light.mapInArrow(classes, ", ".join([f"`{lang}` string", *(f"{n} bigint" for n in names)]))
        .groupBy(lang).agg(*[F.sum(n).alias(n) for n in names]),
        "classes",
    )
    total = by_lang.agg(*[F.sum(n).alias(n) for n in names]).first()
    if not total["rows"]:
        return None, ()
    counts = materialize(word_counts(docs, text, fold_words, by=lang), "words")
    top = Window.partitionBy(lang).orderBy(F.desc("n"), "word")
    common = F.array_sort(F.collect_list(F.struct("place", "word", "n")))
    per_lang = (
        counts.filter(F.col(lang).isNotNull() & (F.col("word") != ""))
        .withColumn("place", F.row_number().over(top)).filter(F.col("place") <= rules.common_words)
        .groupBy(lang).agg(common.alias("_top"))
    )
    sizes = counts.groupBy(lang).agg(F.sum("n").alias("_size"))
    counted = [F.col(n) for n in names[:WIDTH]]
    references = (
        by_lang.filter(F.col(lang).isNotNull()).join(per_lang, lang, "left").join(sizes, lang, "left")
        .select(
            F.col(lang).alias("_lang"), F.array(*counted).alias("_classes"), sum(counted[1:], counted[0]).alias("_chars"),
            F.coalesce("_top.word", F.array().cast("array<string>")).alias("_words"),
            F.coalesce("_top.n", F.array().cast("array<bigint>")).alias("_shares"), F.coalesce("_size", F.lit(0)).alias("_size"),
        )
    )
    overall = counts.filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(rules.common_words).collect()
    whole = counts.agg(F.sum("n")).first()[0] or 0
    classes_of_all = [total[n] for n in names[:WIDTH]]
    return materialize(references, "references"), (classes_of_all, sum(classes_of_all), [w["word"] for w in overall], [w["n"] for w in overall], whole)


def reference(classes: list, chars: int, words: list, shares: list, size: int, rules: DivergenceRules | None) -> tuple:
    """(class histogram or None, common words, their histogram with all others last or None); None for too little text."""
    enough = rules is None or chars >= rules.reference_texts * rules.min_chars, rules is None or size >= rules.reference_texts * rules.min_words
    places = {w.encode(): i for i, w in enumerate(words)}
    bag = np.append(np.array(shares, float), max(0.0, size - float(sum(shares))))
    return np.array(classes, float) if enough[0] else None, places, bag if enough[1] else None


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", rules: DivergenceRules = DivergenceRules()) -> DataFrame:
    """All columns plus counts, the two distances and the verdict ``kept`` (columns of these names are replaced).

    A document is compared with its own language; without one, with all documents. Histograms of fewer
    than ``min_chars`` code points or ``min_words`` words are not judged (distance null), nor those of a
    language with fewer than ``reference_texts`` times as many in all its documents. Null and empty texts have no words and fail the base rule, as do texts under 50 words and
    texts with more than half of their words in repeated 3-word windows. An empty table gives no rows.
    """
    references, of_all = language_references(docs, text, lang, rules)
    default = reference(*of_all, None) if of_all else None
    carried = ["_lang", "_classes", "_chars", "_words", "_shares", "_size"]
    added = [
        ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
        ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("class_distance", "double"),
        ("word_distance", "double"), ("kept", "boolean"),
    ]
    symbol, white = CLASSES.index("symbol"), [CLASSES.index("space"), CLASSES.index("line")]

    def judge(raw: bytes, by: tuple) -> tuple:
        known: dict[bytes, int] = {}
        ids = array("q")
        bag = np.zeros(len(by[1]) + 1)
        for words in word_chunks(raw):
            ids.extend([known.setdefault(w, len(known)) for w in words])
        n = len(ids)
        order = np.frombuffer(ids, np.int64) if n else np.zeros(0, np.int64)
        tally = np.bincount(order, minlength=len(known)) if n else np.zeros(0, np.int64)
        for word, count in zip(fold_words(list(known)), tally.tolist()):
            bag[by[1].get(word, -1)] += count
        lines = [x for x in raw.split(b"\n") if x.strip()]
        by_class = class_counts(raw)
        repeated = repeated_words(order)
        failed = n < 50 or 100 * repeated > 50 * n
        far = js_distance(by_class, by[0]) if by[0] is not None and by_class.sum() >= rules.min_chars else None
        odd = js_distance(bag, by[2]) if by[2] is not None and n >= rules.min_words else None
        good = not failed and (far is None or far <= rules.max_class_distance) and (odd is None or odd <= rules.max_word_distance)
        return (n, int(by_class.sum() - by_class[white].sum()), int(by_class[symbol]), len(lines) - len(set(lines)), repeated, failed, far, odd, good)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict = {}

        def of_row(batch: pa.RecordBatch, at: int, group: str | None) -> tuple:
            if group is None:
                return default
            if group not in ready:
                if len(ready) >= rules.ready:
                    ready.clear()
                ready[group] = reference(*[batch.column(c)[at].as_py() for c in carried[1:]], rules)
            return ready[group]

        for batch in batches:
            groups = batch.column("_lang").to_pylist()
            rows = [judge(raw or b"", of_row(batch, at, groups[at])) for at, raw in enumerate(texts_of(batch, text))]
            fields = [f for f in batch.schema if f.name not in carried and f.name not in dict(added)]
            columns = [batch.column(f.name) for f in fields]
            kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
            for i, (_, kind) in enumerate(added):
                columns.append(pa.array([r[i] for r in rows], kinds[kind]))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields] + [name for name, _ in added])

    kept_columns = [f for f in docs.schema if f.name not in dict(added)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept_columns] + [f"{n} {k}" for n, k in added])
    keyed = docs.withColumn("_lang", F.col(lang).cast("string"))
    if references is None:
        references = docs.sparkSession.createDataFrame([], "_lang string, _classes array<bigint>, _chars bigint, _words array<string>, _shares array<bigint>, _size bigint")
    return keyed.join(references, "_lang", "left").mapInArrow(run, schema)
