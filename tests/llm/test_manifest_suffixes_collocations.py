"""Merkle manifest, suffix dedup and collocations against plain loops."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmosaic.llm import collocations, manifest, suffixes

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, h string, _key string"


@pytest.fixture(scope="module")
def odd(spark):
    """Shared passages, copies, nulls, empty and periodic texts, repeated and null ids, columns with the operators' own names."""
    rng = random.Random(11)
    words = [f"{a}{b}é"[: rng.randint(2, 3)] for a in "abcdefgh" for b in "aeiou"]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = body(90), body(70)
    rows = [(i, body(rng.randint(1, 200)), rng.choice(["en", "fr", None, "und"]), rng.choice(["a", None]), i, i, "x", "y") for i in range(40)]
    rows += [(40 + i, body(i) + " " + passage + " " + body(20) + passage[: 150 + 10 * i], "en", "b", None, 1, None, "") for i in range(12)]
    rows += [(60 + i, other[i:] + body(5) + ". A B, a b; A\tB\n", "fr", "b", 1, 1, None, "") for i in range(6)]
    rows += [rows[3], rows[3], (3, "another text", "en", "a", 1, 1, "", ""), (None, passage, None, None, None, None, None, None), (None, None, "en", "a", 1, 1, "", "")]
    rows += [(80, "", "en", "a", 0, 0, "", ""), (81, "ab" * 400, "de", "a", 0, 0, "", ""), (82, "z" * 199, "de", "a", 0, 0, "", ""), (83, "z" * 200, "xx", "a", 0, 0, "", ""), (84, "\x00" * 230, "xx", "a", 0, 0, "", "")]
    rows += [(90 + i, f"Doc {i} TEXT", "many", "s", i, i, "", "") for i in range(700)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_layout_holds_every_node_once():
    for levels in range(1, 6):
        places = np.concatenate([manifest.address(levels, d, np.arange(8**d)) for d in range(levels)])
        assert sorted(places) == list(range(manifest.nodes_of(levels)))
    # upper half first: root and its children, then each grandchild with its own children
    assert list(manifest.address(4, 1, np.arange(8))) == list(range(1, 9))
    assert list(manifest.address(4, 3, np.arange(9))) == [10, 11, 12, 13, 14, 15, 16, 17, 19]


def test_manifest(odd):
    lead = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(lead(r[c]) for c in ("doc_id", "source", "lang", "n_chars")) + lead(text))
    lower = lambda s: None if s is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    trees = collections.defaultdict(list)
    for r in odd.collect():
        trees[r["lang"]].append((-1 if r["doc_id"] is None else r["doc_id"], leaf(r, r["text"]), r["doc_id"], leaf(r, lower(r["text"]))))

    def climb(nodes):
        paths, up = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, j in enumerate(up):
                paths[i].append((j % 8, nodes[j - j % 8 : j - j % 8 + 8]))
            up, nodes = [j // 8 for j in up], [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        return nodes[0], paths

    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    built = [climb([x[1] for x in sorted(trees[v], key=lambda x: x[:2])]) for v in langs]
    root, above = climb([b[0] for b in built])
    expected = []
    for v, (subroot, paths), top in zip(langs, built, above):
        for (_, own, doc_id, changed), path in zip(sorted(trees[v], key=lambda x: x[:2]), paths):
            at = changed if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else own
            proof = "".join(h for k, run in path + top for i, h in enumerate(run) if i != k)
            for k, run in path + top:
                at = sha("".join([*run[:k], at, *run[k + 1 :]]))
            expected.append((str(doc_id), own, subroot, root, sha(proof), at, at == root))
    got = [tuple(map(lambda v, c: str(v) if c == "doc_id" else v, r, r.__fields__)) for r in manifest.manifest(odd).collect()]
    assert sorted(got) == sorted(expected) and any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_a_forest_has_several_layers(spark):
    rows = [(i, f"T{i}", "en" if i % 10 else None, "s", i, 0, "", "") for i in range(5000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(manifest.manifest(docs).collect())
    assert len(whole) == 5000 and len({r["root"] for r in whole}) == 1 and len({r["subroot"] for r in whole}) == 2
    assert {r["doc_id"] for r in whole if not r["verified"]} == {i for i in range(5000) if zlib.crc32(str(i).encode()) % 3 == 0}


def brute_passages(rows):
    raws = [(r["doc_id"], (r["text"] or "").encode()) for r in rows]
    seen = collections.Counter(raw[p : p + 200] for _, raw in raws for p in range(len(raw) - 199))
    out = []
    for doc_id, raw in raws:
        gone = {i for p in range(len(raw) - 199) if seen[raw[p : p + 200]] > 1 for i in range(p, p + 200)}
        kept = bytes(b for i, b in enumerate(raw) if i not in gone)
        out.append((str(doc_id), len(raw), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found_passages(docs):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.repeated_passages(docs).collect())


def test_repeated_passages(odd):
    expected = brute_passages(odd.collect())
    assert found_passages(odd) == expected and sum(0 < r[2] < r[1] for r in expected) > 10


def test_repeated_passages_with_hot_grams_small_buckets_and_long_texts(odd, monkeypatch):
    expected = brute_passages(odd.collect())
    monkeypatch.setattr(suffixes, "GROUP_STRETCHES", 2)
    assert found_passages(odd) == expected
    monkeypatch.setattr(suffixes, "GROUP_STRETCHES", 4096)
    monkeypatch.setattr(suffixes, "BUCKET_WINDOWS", 300)
    monkeypatch.setattr(suffixes, "HOT_SHARE", 4)
    assert found_passages(odd) == expected


def test_kinds_of_stretches_take_their_place_without_a_second_grouping(odd, monkeypatch):
    """The place of each kind comes with its count: no grouping of the shared stretches by row besides."""
    plans, write = {}, suffixes.materialize
    monkeypatch.setattr(suffixes, "materialize", lambda frame, name, *a: (plans.__setitem__(name, frame._jdf.queryExecution().optimizedPlan().toString()), write(frame, name, *a))[1])
    suffixes.repeated_passages(odd)
    assert plans["kinds"].count("Aggregate") == 1 and "Aggregate" not in plans["bodies"]


def test_suffix_arrays_merge_geometrically():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 400, 1000).astype("S9")
    family = suffixes.SuffixArrays(1000)
    for start in range(0, 1000, 50):
        family.add(keys[start : start + 50], np.arange(start, start + 50))
        sizes = [len(ids) for _, ids in family.arrays]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    counts = collections.Counter(keys.tolist())
    assert family.twice.tolist() == [counts[k] > 1 for k in keys.tolist()]


def test_a_long_text_in_parts_gives_the_same_windows(monkeypatch):
    rng = np.random.default_rng(4)
    raw = bytes(rng.integers(97, 101, 9000, dtype=np.uint8))
    _, h, c, q, far, near = suffixes.stretches([raw])
    starts = [s for g, f, n in zip(q, far, near) for s in range(g - f, g - n + 1)]
    assert starts == list(range(len(raw) - 199))
    _, h2, c2, *_ = suffixes.stretches([b"x" * 333, raw])
    assert set(zip(h, c)) <= set(zip(h2, c2))


def brute_collocations(rows, least, longest, top):
    f = collections.defaultdict(collections.Counter)
    for r in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, longest + 1):
                f[r["lang"] or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, grams in f.items():
        n = sum(c for g, c in grams.items() if len(g) == 1)
        cands = {g: a for g, a in grams.items() if len(g) > 1 and a >= least}
        gone = {g[i : i + m] for g, a in cands.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if a >= cands[g[i : i + m]]}
        best = []
        for g, a in cands.items():
            if g not in gone:
                score, k = min((1000 * a * n // (grams[g[:k]] * grams[g[k:]]), k) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), grams[g[:k]], grams[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("least,top", [(2, 2000), (5, 7)])
def test_collocations(odd, least, top, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 50)
    monkeypatch.setattr(collocations, "ENTRIES", 16)
    got = sorted(tuple(r) for r in collocations.collocations(odd, least, 5, top).collect())
    assert got == brute_collocations(odd.collect(), least, 5, top) and len(got) > 20


def test_pairs_in_dense_and_sparse_tiles():
    rng = np.random.default_rng(0)
    for bits, most in ((2, 40), (3, 200), (10, 5000)):
        a, b = ((rng.zipf(1.3, 20_000) % most).astype(np.int64) for _ in range(2))
        a = np.where(a > 30, a + (3 << collocations.RANK_BITS), a)
        x, y, n, local = collocations.tile_counts(a, b, bits)
        assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == collections.Counter(zip(a.tolist(), b.tolist()))
        assert (x[local] == a).all() and (y[local] == b).all()


def test_empty_tables(odd):
    none = odd.limit(0)
    assert manifest.manifest(none).count() == 0 and suffixes.repeated_passages(none).count() == 0 and collocations.collocations(none).count() == 0
    blank = odd.filter(F.col("text") == "")
    assert collocations.collocations(blank).count() == 0 and suffixes.repeated_passages(blank).first()["n_removed"] == 0
