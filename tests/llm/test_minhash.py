import random

import numpy as np
import pytest

from tidelog.llm import minhash, queries
from tidelog.llm.components import connected_components
from tests.llm.conftest import EDGES, SMALL, documents


def shingles(text, size):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows, size, percent=80):
    """Set sizes and components by comparing all pairs."""
    real = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in real if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [(i, s) for i, s in real if i is not None and s]
    for k, (i, a) in enumerate(usable):
        for j, b in usable[:k]:
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(
        ((i, len(s), None if i is None else find(i) if s else i) for i, s in real), key=repr
    )


def run(docs, size):
    rows = minhash.near_duplicates(docs, shingle_words=size).collect()
    for r in rows:
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_edges(edges):
    assert run(edges, 2) == brute(EDGES, 2)


def test_empty(nothing):
    assert run(nothing, 2) == []


@pytest.mark.parametrize("size", [2, 5])
def test_chains_and_loose_groups(spark, size, monkeypatch):
    """Groups whose members are similar to some others only, over more than one block."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rnd = random.Random(size)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(4):
        base = rnd.choices(words, k=60)
        for _ in range(40):
            text = list(base)
            for _ in range(rnd.randint(0, 7)):
                text[rnd.randrange(60)] = rnd.choice(words)
            if rnd.random() < 0.3:
                base = text
            rows.append(" ".join(text))
    rnd.shuffle(rows)
    rows = [(100 + i, t) for i, t in enumerate(rows)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), size) == brute(rows, size)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    got = queries.QUERIES["op1_minhash"](spark, SMALL).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)
    assert got == brute(rows, 2)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(1, 1 << 62, 3000, dtype=np.uint64)
    sets = [np.unique(pool[:n]) for n in (1, 2, 7, 900)] + [np.unique(pool[100:1000])]
    made = minhash.sketches(sets)
    assert (made != minhash._EMPTY).all()
    share = (made[3] == made[4]).mean()
    assert abs(share - 800 / 1000 * 1000 / 1000) < 0.2 and share > 0.75


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r.id: r.component for r in connected_components(frame).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}
    assert connected_components(frame.limit(0)).collect() == []
