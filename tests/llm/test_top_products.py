import math

import numpy as np
import pytest

from tidelog.llm import top_products

NAN, INF = float("nan"), float("inf")


def brute(rows, k, query):
    real = sorted({(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows})
    out = []
    for i, v in real:
        if query(i):
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in real if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best[:k])]
    return sorted(out)


def found(spark, rows, k=5, every=10, **options):
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, entry string, norm int")
    got = top_products.top_products(frame, lambda i: i % every == 0, k, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (10, [0.0, 2.0]),
            (11, [0.0, -2.0]), (20, [0.0, 0.0]), (30, [-1.0, 0.5]), (31, [-0.001, 0.001])]
    bad = [(3, None), (4, []), (6, [NAN, 1.0]), (7, [INF, 1.0]), (8, [None, 1.0]),
           (40, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    assert found(spark, rows + bad) == brute(rows, 5, lambda i: i % 10 == 0)
    assert found(spark, rows[:1]) == [] and found(spark, bad[:5]) == [] and found(spark, []) == []
    with pytest.raises(ValueError, match="too large"):
        found(spark, [(1, [1e12, 0.0])])


def test_many_copies(spark):
    rows = [(i, [1.0, 1.0]) for i in range(300)] + [(300 + i, [1.0, 0.1 * i]) for i in range(20)]
    assert found(spark, rows, every=50) == brute(rows, 5, lambda i: i % 50 == 0)


@pytest.mark.parametrize("spread,shape", [(0.0, "random"), (1.0, "random"), (1.0, "clusters")])
def test_grid_and_pruning_lose_nothing(spark, spread, shape):
    """Many buckets, cells and query blocks; equal, uneven and clustered lengths and directions."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 12))
    if shape == "clusters":
        x = rng.normal(size=(20, 12))[rng.integers(0, 20, 1500)] + 0.05 * x
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(spread * rng.normal(size=(1500, 1)))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    want = brute(rows, 5, lambda i: i % 10 == 0)
    small = {"bucket": 64, "cell_bytes": 64 * 12 * 8 * 2, "query_block": 40}
    assert found(spark, rows, **small) == want
    assert found(spark, rows, switch=0.3, **small) == want


def verified(x, switch, known=0.0):
    """Share of products verified for every 400th vector; the results are checked against all of them.

    Bounds start at the share ``known`` of each query's fifth best product.
    """
    norms = np.sqrt((x * x).sum(axis=1).astype(float))
    order = np.argsort(-norms, kind="stable")
    x, norms = x[order], norms[order]
    q, n = x[::400], norms[::400]
    exact = q @ x.T
    fifth = np.sort(exact, axis=1)[:, -5]
    found = top_products.Found.start((known * fifth).astype(int), 5)
    seen = 0
    for i in range(0, len(x), 256):
        one = top_products.Bucket(np.arange(i, i + 256), x[i:i + 256], norms[i:i + 256])
        seen += top_products.search_bucket(one, q, n, found, switch)
    for row, ids in enumerate(found.ids):
        assert ids.tolist() == np.lexsort((np.arange(len(x)), -exact[row]))[:5].tolist()
    return seen / exact.size


def test_uneven_lengths_are_pruned_by_length():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4096, 8))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(rng.normal(size=(4096, 1))) * 256
    assert verified(x.astype(int), 2.0) < 0.1


def test_like_lengths_are_pruned_by_coordinates():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(800, 8))
    x = centres[rng.integers(0, 800, 4096)]
    x = x / np.linalg.norm(x, axis=1, keepdims=True) + 0.005 * rng.normal(size=(4096, 8))
    x = (x * 10_000).astype(int)
    assert verified(x, 2.0, 0.95) > 0.6
    assert verified(x, top_products.SWITCH, 0.95) < 0.2
