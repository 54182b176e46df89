"""Each operator against brute force on small rows: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from flowmosaic.llm import embeddup, langid, langmodel, linededup, mixing, pieces, quality, sharding, simhash, toxicity
from flowmosaic.llm.common import connected_components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string"
LONG = "a long text of words " * 30_000


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that try every case."""
    rng = random.Random(4)
    words = ["the", "of", "river", "stone", "idiot", "été", "über", "|", "x", "lamp"]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, body(rng.randint(1, 120)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", None]), 1, 0.5, "x") for i in range(60)]
    rows += [rows[3], rows[3], (70, None, "en", "a", None, None, None), (71, "", None, None, 0, None, None), (None, "no id here", None, "a", 1, None, None)]
    rows += [(72, " \n\t ", "en", "b", 3, None, None), (73, LONG, "en", "a", len(LONG), None, None), (74, rows[5][1], "fr", "b", 1, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_quality(odd, none):
    got = {r["doc_id"]: r for r in quality.quality_rules(odd).collect()}
    assert len(quality.quality_rules(odd).collect()) == odd.count() and quality.quality_rules(none).count() == 0
    for r in odd.collect():
        words, g = (r["text"] or "").split(), got[r["doc_id"]]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 500 else set(range(len(words)))
        assert (g["n_words"], g["word_chars"], g["n_repeat_words"]) == (len(words), sum(map(len, words)), len(inside))
        assert not (g["kept"] and g["base_failed"])
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1 and quality.js_distance(np.ones(3), np.ones(3)) == 0


def test_a_rare_language_is_judged_by_its_own_texts(spark):
    rng = random.Random(8)
    latin, greek = [[f"{a}{b}{c}" for a in s for b in s for c in s[:3]] for s in ("abcdefgh", "αβγδεζηθ")]
    text = lambda words: " ".join(rng.choice(words[:70]) for _ in range(150))
    rows = [(i, text(latin), "en") for i in range(7000)] + [(7000 + i, text(greek), "el") for i in range(24)] + [(7100, text(greek), "tiny")]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    rare = [got[7000 + i] for i in range(24)]
    assert len(got) == len(rows) and all(r["kept"] and r["class_distance"] < 0.1 for r in rare)
    assert got[7100]["class_distance"] is None and got[7100]["word_distance"] is None and got[7100]["kept"]


def test_words_in_chunks_are_the_same():
    from flowmosaic.llm.common import word_chunks

    raw = ("ab  cde\n" * 500).encode()
    assert [w for part in word_chunks(raw, 7) for w in part] == raw.split()


def test_simhash(odd, none):
    got = {(r["doc_id"], r["lang"]): r for r in simhash.near_duplicates(odd).collect()}
    prints = {}
    for r in odd.collect():
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "").split()
        parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints[(r["doc_id"], r["lang"])] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    keys = list(prints)
    group = {k: k for k in keys}
    for _ in keys:
        for a in keys:
            for b in keys:
                if bin(prints[a] ^ prints[b]).count("1") <= 2:
                    group[a] = group[b] = min(group[a], group[b], key=str)
    for k in keys:
        assert got[k]["fingerprint"] == f"{prints[k]:016x}"
        assert got[k]["component_id"] == min((j[0] for j in keys if group[j] == group[k] and j[0] is not None), default=None)
    assert simhash.near_duplicates(none).count() == 0


def test_index_finds_every_link(spark):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**64, 3000, np.uint64)
    codes = np.unique(np.r_[codes, codes[:800] ^ np.uint64(1) << rng.integers(0, 64, 800, np.uint64), codes[0] ^ np.arange(60, dtype=np.uint64)])
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp bigint")
    got = {r["node"]: r["component"] for r in connected_components(simhash.near_links(frame, 2)).collect()}
    near = [np.flatnonzero(np.bitwise_count(codes ^ c) <= 2) for c in codes]
    parent = np.arange(len(codes))
    for i, js in enumerate(near):
        from flowmosaic.llm.common import local_forest

        parent = local_forest(parent, np.full(len(js), i), js)
    for root in np.unique(parent):
        names = {got.get(int(codes[i].view(np.int64)), "alone") for i in np.flatnonzero(parent == root)}
        assert len(names) == 1


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (5, 5), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[101] == 100 and len(got) == 42


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 8))
    rows = [(i, (base[i % 40] + rng.standard_normal(8) * 0.02).tolist(), i % 2) for i in range(300)]
    rows += [(400, rows[0][1], 0), (401, rows[0][1], 0), (402, [0.0] * 8, 0), (403, None, 1), (404, [float("nan")] + [1.0] * 7, 1), (405, [1.0] * 8, None), (406, [None] * 8, 1), (407, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embeddup.near_vectors(frame).collect()}
    assert len(got) == len(rows) and embeddup.near_vectors(frame.limit(0)).count() == 0
    sound = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = np.array([np.array(r[1]) / np.linalg.norm(r[1]) for r in sound])
    near = (unit @ unit.T >= 0.98) & (np.array([r[2] for r in sound])[:, None] == np.array([r[2] for r in sound])[None, :])
    found = sum(got[r[0]]["n_links"] for r in sound)
    assert 0.97 * (near.sum() - len(sound)) <= found <= near.sum() - len(sound)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(402, 408))


def test_links_between_saturated_groups_are_found(spark):
    """Three tight groups in a row, each large enough to fill every list with its own members."""
    rng = np.random.default_rng(5)
    axes, other = np.linalg.qr(rng.standard_normal((32, 2)))[0].T, rng.standard_normal((500, 32))
    step = np.arccos(0.985)
    centres = [np.cos(k * step) * axes[0] + np.sin(k * step) * axes[1] for k in range(3)]
    near = np.concatenate([c + 0.0005 * rng.standard_normal((30, 32)) for c in centres])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([near, other]))]
    got = {r["vec_id"]: r for r in embeddup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert {got[i]["component_id"] for i in range(90)} == {0} and sum(got[i]["kept"] for i in range(90)) == 1
    assert [got[i]["n_links"] for i in range(90)] == [59] * 30 + [89] * 30 + [59] * 30
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(90, 590))


def test_toxicity(spark, odd, none):
    rng = random.Random(0)
    words = [f"w{i}" for i in range(60)]
    rows, flags = [], []
    for i in range(600):
        toxic = i % 5 == 0
        rows.append((i, " ".join(rng.choices(words, k=30) + ["vile"] * toxic)))
        flags.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(flags, "doc_id bigint, toxic int")
    weights = toxicity.fit_toxicity(docs.filter("doc_id < 400"), labels.filter("doc_id < 400"))
    held = toxicity.score_toxicity(docs.filter("doc_id >= 400"), weights).join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.95
    scored = toxicity.score_toxicity(odd, weights)
    assert scored.count() == odd.count() and scored.columns[-2:] == ["score", "predicted"] and scored.filter("score between 0 and 1").count() == odd.count()
    flat = toxicity.fit_toxicity(none, labels.limit(0))
    assert not flat[:-1].any() and toxicity.score_toxicity(none, flat).count() == 0


def test_mixing(odd, none):
    assert mixing.shares_out([10, 10, 80], [5, 2, 1], 3) == pytest.approx([30, 30, 40])
    got = mixing.mix_digest(odd).collect()
    again = mixing.mix_digest(odd.repartition(7)).collect()
    assert len(got) == odd.count() and sorted(map(str, got)) == sorted(map(str, again))
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in got)
    assert mixing.mix_digest(none).count() == 0
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == pytest.approx(sum(r["taken"] for r in got), rel=0.02)


def test_flight_keeps_totals():
    rng = np.random.default_rng(3)
    chances, sizes = rng.random(500), rng.integers(1, 900, 500).astype(float)
    out = mixing.fly_and_land(chances, sizes, rng.random(500))
    assert set(out) <= {0.0, 1.0} and abs(out.sum() - chances.sum()) <= 1.5 and abs(out @ sizes - chances @ sizes) < 50


def test_a_small_source_lands_the_same_beside_a_large_one(spark):
    rng = np.random.default_rng(6)
    rows = [(f"{xxhash.xxh64_hexdigest(f's{i}')}", "small", int(n), 0.37) for i, n in enumerate([20_020, *rng.integers(1, 900, 499)])]
    hot = [(f"{xxhash.xxh64_hexdigest(f'h{i}')}", "hot", int(n), 0.61) for i, n in enumerate(rng.integers(1, 900, 9000))]
    frame = lambda x: spark.createDataFrame(x, "_row string, _source string, size bigint, _chance double")
    alone, both = ({r["_row"]: r["_more"] for r in mixing.balance(frame(x)).collect()} for x in (rows, rows + hot))
    assert len(both) == len(rows) + len(hot) and alone == {row: both[row] for row in alone}
    want = sum(size * chance for _, _, size, chance in hot)
    assert abs(sum(size * both[row] for row, _, size, _ in hot) - want) < 0.01 * want


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance(spark):
    rng = random.Random(6)
    rows = [("".join(rng.choices("abé", k=rng.randint(1, 12))), "".join(rng.choices("abé", k=rng.randint(1, 12)))) for _ in range(900)]
    rows = [(a, b) for a, b in rows if abs(len(a) - len(b)) <= 2]
    for r in spark.createDataFrame(rows, "a string, b string").withColumn("d", linededup.edits_within(F.col("a"), F.col("b"), 2)).collect():
        true = edit_distance(r["a"], r["b"])
        assert r["d"] == true if true <= 2 else r["d"] > 2


def test_near_lines_against_brute_force(spark):
    rng = random.Random(7)
    lines = set()
    for _ in range(40):
        line = "".join(rng.choices("abcdefg ", k=rng.randint(26, 60))).strip() + "zzzzzz"
        lines.add(line)
        for _ in range(4):
            other = line
            for _ in range(rng.randint(1, 3)):
                at, kind = rng.randrange(len(other)), rng.randrange(3)
                other = other[:at] + rng.choice("abc ") * (kind != 0) + other[at + (kind != 1) :]
            lines.add(other)
    lines = sorted(line for line in lines if len(line) >= 24)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    links = linededup.near_lines(linededup.lines_of(docs, "doc_id", "text", 24)).collect()
    got = {(int(r["a"]) // linededup.LINES, int(r["b"]) // linededup.LINES) for r in links}
    true = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if abs(len(lines[i]) - len(lines[j])) < 3 and edit_distance(lines[i], lines[j]) <= 2}
    assert got == true


def test_lines_are_dropped(spark, odd, none):
    same, near = "this line is long enough to count", "this line is long enough to cound"
    docs = spark.createDataFrame([(1, f"{same}\nx"), (2, f"{near}\nmore of it, and quite different words"), (3, same), (4, None), (5, "")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.drop_repeated_lines(docs).collect()}
    assert got == {1: f"{same}\nx", 2: "more of it, and quite different words", 3: "", 4: None, 5: ""}
    out = linededup.drop_repeated_lines(odd)
    assert out.count() == odd.count() and out.columns == odd.columns and linededup.drop_repeated_lines(none).count() == 0


def test_rows_of_one_id_keep_their_own_lines(spark):
    a, b, c, d = ("the first line of all of them here", "another body with words of its own", "something that nobody else has said", "the first line of all of them hero")
    rows = [(1, a), (5, a), (5, b), (None, a), (None, c), (-3, f"x\n{c} \n{b}?"), (7, d), (7, d), (2**63 - 1, "largest id of all, with its own line"), (-(2**63), "least id of all, with its own line")]
    docs = spark.createDataFrame([(i, text, 7, "g") for i, text in rows], "doc_id bigint, text string, _key int, _gone string")
    out = linededup.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["text"]) for r in out.collect()), key=str)
    left = [(1, a), (5, ""), (5, ""), (None, ""), (None, ""), (-3, f"x\n{c} \n{b}?"), (7, ""), (7, ""), *rows[8:]]
    assert got == sorted(((i is None, i, text) for i, text in left), key=str)
    classes = linededup.line_classes(docs).collect()
    assert {(r["doc_id"], r["n_links"]) for r in classes if r["class_doc_id"] == 1} == {(1, 1), (5, 1), (None, 1), (7, 1)}
    unique = docs.filter("doc_id is null or doc_id = 5")
    assert {r["class_doc_id"] for r in linededup.line_classes(unique.filter("doc_id is null")).collect()} == {None}
    assert sorted(r["text"] for r in linededup.drop_repeated_lines(unique).collect()) == sorted([a, b, c, ""])
    near = spark.createDataFrame([(3, a), (3, b), (5, d)], "doc_id bigint, text string")
    assert {(r["doc_id"], r["class_doc_id"], r["n_links"]) for r in linededup.line_classes(near).collect()} == {(3, 3, 1), (3, 3, 0), (5, 3, 1)}


def test_very_many_lines(spark):
    many = "\n".join(f"line number {i % 60_000} of a long document" for i in range(100_000))
    got = linededup.drop_repeated_lines(spark.createDataFrame([(1, many)], "doc_id bigint, text string"), edits=0).first()["text"]
    assert got.split("\n") == many.split("\n")[:60_000]


def test_short_lines_are_compared_for_equality(spark):
    docs = spark.createDataFrame([(1, "Les.\nLet.\n \n"), (2, "Les.\nonce"), (3, "Les.\n ")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"], r["n_copies"], r["n_links"], r["kept"]) for r in linededup.line_classes(docs).collect()}
    assert got == {
        (1, 0): (1, 0, 3, 0, True), (1, 1): (1, 1, 1, 0, True), (2, 0): (1, 0, 3, 0, False), (2, 1): (2, 1, 1, 0, True), (3, 0): (1, 0, 3, 0, False),
    }
    assert {r["doc_id"]: r["text"] for r in linededup.drop_repeated_lines(docs).collect()} == {1: "Les.\nLet.\n \n", 2: "once", 3: " "}


def test_shards(odd, none):
    keys = np.random.default_rng(0).integers(0, 2**64, 5000, np.uint64)
    for n in (1, 2, 7, 8):
        old, new = sharding.jump(keys, n), sharding.jump(keys, n + 1)
        assert ((new == old) | (new == n)).all() and abs((new != old).mean() - 1 / (n + 1)) < 0.03
    got = sharding.shard_digest(odd, 8).toPandas()
    assert len(got) == odd.count() and sharding.shard_digest(none, 8).count() == 0
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))


def test_language(spark, odd, none):
    rng = random.Random(5)
    make = lambda parts: " ".join("".join(rng.choices(parts, k=3)) for _ in range(40))
    rows = [(i, make(["th", "er", "on"]) if i % 2 else make(["ei", "sch", "ung"]), ["de", "en"][i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit_language_model(docs.filter("doc_id < 120"))
    found = langid.identify(docs.filter("doc_id >= 120"), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.98
    out = langid.identify(odd, model)
    assert out.count() == odd.count() and {r["lang_pred"] for r in out.filter("text is null or trim(text) = ''").collect()} == {"und"}
    empty = langid.fit_language_model(none)
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        parts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(4)]
        rows += [(12 * i + j, " ".join("".join(rng.choices(parts, k=2)) for _ in range(30)), f"l{i:03d}") for j in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit_language_model(docs.filter("doc_id % 12 < 11"))
    assert model[0] == [f"l{i:03d}" for i in range(300)]
    found = langid.identify(docs.filter("doc_id % 12 = 11"), model).collect()
    assert len(found) == 300 and np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.9
    assert np.mean([r["lang_pred"] == r["lang"] for r in found if r["lang"] >= "l256"]) > 0.9


def test_language_model(odd, none):
    model, rare = langmodel.fit(odd)
    got = langmodel.score(odd, model, rare).collect()
    assert len(got) == odd.count() and all(r["score"] < 0 and r["n_known"] == r["n_tokens"] for r in got)
    empty, rest = langmodel.fit(none)
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in langmodel.score(odd.limit(5), empty, rest).collect())
    assert langmodel.score(none, model, rare).count() == 0


def test_language_model_against_a_plain_loop(odd):
    docs = odd.filter("doc_id is null or doc_id != 73")
    model, rare = langmodel.fit(docs, settings=langmodel.ModelSettings(classes=2, class_size=3, hidden=4))
    s, p = model.settings, langmodel.unpacked(model.parameters, model.settings)
    lower = lambda text: "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    counts = Counter(w for r in docs.collect() for w in [*lower(r["text"]), None])
    assert sum(counts.values()) == model.tokens and len(counts) == model.distinct
    inside = {w: i for w, (_, i) in model.counts.items() if i >= 0}
    for r in langmodel.score(odd, model, rare).collect():
        if r["doc_id"] == 73:
            continue
        text = next(x["text"] for x in odd.filter(F.col("doc_id").eqNullSafe(r["doc_id"])).collect())
        tokens = [*lower(text), None]
        base = sum(math.log10((counts[t] + 1) / (model.tokens + model.distinct + 1)) for t in tokens)
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(counts[t] > 0 for t in tokens))
        assert r["base_score"] == pytest.approx(base)
        state, before, total = np.zeros((1, s.hidden), np.float32), s.classes * s.class_size, 0.0
        for t in tokens:
            state, _ = langmodel.step(p, np.array([before]), state)
            before = inside.get(t.encode() if t else langmodel.END, model.unknown)
            total += langmodel.word_log_probs(p, state, np.array([before]), s)[0] / math.log(10)
            if before == model.unknown:
                total += math.log10((counts[t] + 1) / (model.outside_tokens + model.outside_distinct + 1))
        assert r["score"] == pytest.approx(total, rel=1e-4)


def test_look_up_of_whole_texts(monkeypatch):
    """Ids and sums of frequent words by place, against a plain loop; texts in chunks, words of no count hashed."""
    monkeypatch.setattr(langmodel, "word_chunks", lambda raw: (raw.split()[i : i + 3] for i in range(0, len(raw.split()), 3)))
    counts = {b"": (5, 1), b"a": (9, 0), b"b": (4, -1), b"c": (1, -1)}
    model = langmodel.LanguageModel(langmodel.ModelSettings(), np.zeros(1), counts, 2, 30, 9, 11, 7)
    frequent, places = langmodel.FrequentWords(model), langmodel.network_places(model)
    for raw in (b"A b x a y x c a", b"", None, b"a", b"zz y"):
        words = (raw or b"").lower().split() + [b""]
        ids, (n, known, base, logs, outside, rare) = frequent.look_up(raw)
        found = [counts.get(w) for w in words]
        assert ids.tolist() == langmodel.ids_of(raw, places, 2).tolist() == [f[1] if f and f[1] >= 0 else 2 for f in found]
        assert (n, known, outside) == (len(words), sum(map(bool, found)), ids.tolist().count(2))
        assert math.isclose(base, sum(math.log10(f[0] + 1) for f in found if f))
        assert math.isclose(logs, sum(math.log10(f[0] + 1) for f in found if f and f[1] < 0), abs_tol=1e-12)
        assert rare.view(np.uint64).tolist() == [xxhash.xxh64_intdigest(w, 42) for w, f in zip(words, found) if not f]


def test_every_training_row_is_learned_from(spark, monkeypatch):
    seen = spark.createDataFrame([(i, "one two three " * (i % 5)) for i in range(300)] + [(None, "one"), (None, None)], "doc_id bigint, text string")
    sizes = []
    plain = langmodel.fit(seen)[0]
    s = plain.settings
    assert s.classes == s.class_size == max(4, round(s.growth * plain.tokens ** (1 / 6)))
    assert langmodel.sized(langmodel.ModelSettings(), 10**9).classes > langmodel.sized(langmodel.ModelSettings(), 10**7).classes > s.classes
    again = langmodel.fit(seen)[0]
    assert (again.parameters == plain.parameters).all()
    # one task's stream: all tokens count, however they are laid in lanes
    p = langmodel.fresh(s, np.ones(s.classes * s.class_size))
    real = langmodel.gradients
    monkeypatch.setattr(langmodel, "gradients", lambda p, x, y, live, *rest: sizes.append(int(live.sum())) or real(p, x, y, live, *rest))
    for lengths in ([1], [3, 1, 9], [700, 1, 1, 5000]):
        sizes.clear()
        adam = langmodel.Adam(*({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2)))
        n = langmodel.train_on(p, [np.arange(n) % 7 for n in lengths], s, adam, 0.01)
        assert n == sum(lengths) == sum(sizes)


def test_a_window_over_two_documents_equals_two_windows():
    s = langmodel.ModelSettings(hidden=3, classes=2, class_size=3)
    p = {k: v.astype(np.float64) for k, v in langmodel.fresh(s, np.arange(6)).items()}
    x, y = np.array([[6], [1], [6], [3]]), np.array([[1], [2], [3], [0]])
    both, _ = langmodel.gradients(p, x, y, np.ones_like(y), np.ones((1, 3)), s, np.array([[True], [False], [True], [False]]))
    parts = [langmodel.gradients(p, x[i : i + 2], y[i : i + 2], np.ones((2, 1), int), np.zeros((1, 3)), s)[0] for i in (0, 2)]
    for k in p:
        assert both[k] == pytest.approx((parts[0][k] + parts[1][k]) / 2)


def test_network_gives_probabilities_and_right_gradients():
    s = langmodel.ModelSettings(hidden=3, classes=2, class_size=3)
    p = {k: v.astype(np.float64) for k, v in langmodel.fresh(s, np.arange(6)).items()}
    states = np.random.default_rng(0).standard_normal((1, 3))
    total = sum(np.exp(langmodel.word_log_probs(p, states, np.array([i]), s))[0] for i in range(6))
    assert total == pytest.approx(1)
    inputs, targets = np.array([[6, 6], [1, 4], [2, 0]]), np.array([[1, 4], [2, 0], [3, 5]])
    live = np.ones_like(targets)
    g, _ = langmodel.gradients(p, inputs, targets, live, np.zeros((2, 3)), s)

    def loss():
        state, total = np.zeros((2, 3)), 0.0
        for x, y in zip(inputs, targets):
            state, _ = langmodel.step(p, x, state)
            total -= langmodel.word_log_probs(p, state, y, s).sum()
        return total / targets.size

    for name in ("inputs", "back", "class_w", "word_w", "word_b"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        keep = p[name][at]
        p[name][at] = keep + 1e-5
        up = loss()
        p[name][at] = keep - 1e-5
        down = loss()
        p[name][at] = keep
        assert (up - down) / 2e-5 == pytest.approx(g[name][at], rel=1e-3)


def test_pieces(odd, none):
    tricky = odd.limit(1).select(F.explode(F.array(*[F.lit(x) for x in ("a▁b \n\n c", "▁", "  two  blanks ", "日本 😀\ttab", "\n", "")])).alias("text"))
    for docs in (odd, tricky, none):
        back = pieces.decode(pieces.encode(docs))
        assert back.filter(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0 and back.count() == docs.count()


def test_a_very_long_word_is_encoded(spark):
    bodies = ["ab" * 60_000, "x" * 257, None, "x" * 255, ""]
    back = pieces.decode(pieces.encode(spark.createDataFrame(list(enumerate(bodies)), "doc_id bigint, text string"))).orderBy("doc_id").collect()
    assert [r["decoded"] for r in back] == bodies and [r["ids"] for r in back][2] is None and list(back[4]["ids"]) == []
    assert [r["n_pieces"] for r in back] == [len(r["ids"] or ()) for r in back]


def test_relational_and_in_task_lattices_agree(spark):
    table = pieces.load_pieces()
    words = sorted({w for text in ("the river of stones", "été über 日本x", "a\n▁b", "internationalisation") for w in pieces.words_of(text)})
    got = {r["word"]: list(r["ids"]) for r in pieces.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), table).collect()}
    assert got == {w: pieces.viterbi(w, table) for w in words}


def test_the_lattice_follows_the_beginnings_of_pieces():
    """Same pieces as a loop over every substring, without cutting every substring out of the word."""

    class Word(str):
        cut = 0

        def __getitem__(self, at):
            Word.cut += isinstance(at, slice)
            return str(self)[at]

    table, rng = pieces.load_pieces(), random.Random(8)
    for _ in range(60):
        word = pieces.SPACE + "".join(rng.choice("tioneéx日qu") for _ in range(rng.randint(1, 40)))
        best = [(0.0, ())] + [(-math.inf, ())] * len(word)
        for start in range(len(word)):
            for end in range(start + 1, min(len(word), start + table.longest) + 1):
                piece = table.pieces.get(word[start:end])
                if piece or end == start + 1:
                    i, score = piece or (-1, table.lowest - pieces.UNKNOWN_PENALTY)
                    if best[start][0] + score > best[end][0]:
                        ids = (i,) if piece else tuple(table.first_byte + b for b in word[start].encode())
                        best[end] = (best[start][0] + score, best[start][1] + ids)
        Word.cut = 0
        assert pieces.viterbi(Word(word), table) == list(best[-1][1])
        assert Word.cut <= 2 * len(word)


def test_one_row_of_every_group_stays(spark):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(1, body, "a"), (1, body, "a"), (1, body, "b"), (2, body, "a"), (3, "", "a"), (4, " \n", "a"), (5, None, "b"), (6, "other words", "a"), (6, "quite different", "a"), (None, body, "c"), (None, "no id", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"]) for r in left.collect())
    assert got == [(0, "no id"), (1, body), (3, ""), (6, "other words"), (6, "quite different")]


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and {"doc_id", "ids", "n_pieces"} <= set(out.columns)
