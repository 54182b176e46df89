"""Chunks of collocations travel in bounded rows, and are counted one at a time in bounded memory."""

import collections
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from flowmosaic.llm import collocations


class Task:
    def get(self):
        return self

    def partitionId(self):
        return 3


def chunks_of(rows):
    """{chunk: (lang, words, vocabulary, counts)}, slices put together again."""
    out = {}
    for row in rows:
        lang, words, keys, n = out.setdefault(row["chunk"], (row["lang"], {}, {}, []))
        if row["ids"] is not None:
            words[row["at"]] = np.frombuffer(row["ids"], np.int32)
        for i, key in enumerate(zip(*[row[c] for c in ("keys", "a", "b") if c in row])):
            keys[row["base"] + i] = key
        n += row["n"]
    return {c: (lang, np.concatenate([words[at] for at in sorted(words)]), keys, n) for c, (lang, words, keys, n) in out.items()}


def test_chunks_travel_in_bounded_rows_and_are_paired_one_by_one(monkeypatch):
    for name, value in (("ROW_WORDS", 50), ("ENTRIES", 16), ("BAND", 40), ("SLICE_BYTES", 100), ("DOCS", 2), ("TaskContext", Task())):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(5)
    names = [f"w{i}" for i in range(60)]
    texts = ["".join(rng.choice(names) + rng.choice([" ", " ", " ", ". "]) for _ in range(rng.randint(0, 300))) for _ in range(20)]
    langs = [rng.choice(["en", "fr"]) for _ in texts]
    rows = pa.Table.from_batches(collocations.cut_words(iter([pa.RecordBatch.from_pydict({"lang": langs, "text": texts})]), 600)).to_pylist()
    assert all(len(r["ids"] or b"") <= 200 and len(r["keys"]) <= 16 for r in rows)
    chunks = chunks_of(rows)
    assert len(chunks) > 4 and sum(r["words"] for r in rows) == sum(len(t.replace(".", " ").split()) for t in texts)

    # every third word is rare; ids of the others come in several runs, rows of a chunk in any order
    ids = {name: (7 << collocations.RANK_BITS) + 5 * i for i, name in enumerate(names) if i % 3}
    sent = []
    for chunk, (lang, _, keys, _) in chunks.items():
        mine = [{"chunk": chunk, "lang": lang, "at": r["at"], "ids": r["ids"]} for r in rows if r["chunk"] == chunk and r["ids"] is not None]
        found = [(local, ids[key]) for local, (key,) in keys.items() if key in ids]
        for part in (found[::2], found[1::2]):
            of, to = (np.array(x, np.int64) for x in zip(*part))
            for c, first, local, step in zip(*[x.to_pylist() for x in collocations.packed(np.full(len(of), chunk), of, to)]):
                mine.append({"chunk": c, "first": first, "locals": local, "steps": step})
        rng.shuffle(mine)
        sent += mine
    types = {"chunk": pa.int64(), "lang": pa.string(), "at": pa.int32(), "ids": pa.binary(), "first": pa.int64(), "locals": pa.binary(), "steps": pa.binary()}
    table = pa.Table.from_pylist(sent, pa.schema(types.items()))
    for size in (1, 7, len(sent)):
        paired = pa.Table.from_batches(collocations.pair_up(iter(table.to_batches(size)))).to_pylist()
        assert all(len(r["ids"] or b"") <= 200 and len(r["a"]) <= 16 for r in paired)
        got = chunks_of(paired)
        for chunk, (lang, words, keys, _) in chunks.items():
            seq = [ids.get(keys[w][0], -1) if w >= 0 else -1 for w in words.tolist()]
            steps = [(a, b) if a >= 0 and b >= 0 else None for a, b in zip(seq, seq[1:])]
            assert got[chunk][0] == lang
            assert {got[chunk][2][i]: n for i, n in enumerate(got[chunk][3])} == collections.Counter(s for s in steps if s)
            flat = [got[chunk][2][w] if w >= 0 else None for w in got[chunk][1].tolist()] + [None]
            assert [s for s in flat if s] == [s for s in steps if s]
            split = lambda run: "".join("x" if s else " " for s in run).split()
            assert split(flat) == split(steps)


def test_counting_pairs_takes_few_bytes_a_pair():
    rng = np.random.default_rng(1)
    a, b = ((rng.zipf(1.2, 2_000_000) % 200_000).astype(np.int32) for _ in range(2))
    tracemalloc.start()
    x, y, n, local = collocations.tile_counts(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n.sum() == len(a) and (x[local] == a).all() and (y[local] == b).all()
    assert peak < 64 * len(a)
