import math

import numpy as np
import pytest

from tidelog.llm import limbs, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, error string, code string, v string"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "e", "c", "v") for i, v, lab in rows], SCHEMA)


def brute(rows, parts, entries, rounds):
    """Codes by plain Python integers."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows]
    w = len(kept[0][1]) // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for _, v, _ in kept]
    starts = {}
    for (i, v, _), c in zip(kept, cut, strict=True):
        if i is not None and (i not in starts or v < starts[i][0]):
            starts[i] = (v, c)
    first = [starts[i][1] for i in sorted(starts)[:entries]]
    books = [[c[p] for c in first] for p in range(parts)]

    def nearest(p, x):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in books[p]]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[0], []).append(c[p])
            for j, members in groups.items():
                new[p][j] = tuple(sum(x) // len(members) for x in zip(*members, strict=True))
        books = new
    out, sums = [], {}
    for (i, _, lab), c in zip(kept, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = sum(d for _, d in found)
        sums[lab] = sums.get(lab, 0) + error
        out.append((i, lab, "".join(f"{j:02x}" for j, _ in found), error))
    text = ",".join(str(x) for b in books for c in b for x in c)
    return sorted([(*r, sums[r[1]]) for r in out], key=repr), text


def coded(spark, rows, **options):
    found, books = vector_codes.compress(frame(spark, rows), **options)
    assert found.columns == ["id", "label", "code", "error", "label_error"]
    return sorted(map(tuple, found.collect()), key=repr), books.text()


def test_equals_plain_integers(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)).astype(np.float32)
    rows = [(int(i * 7 % 301), v.tolist(), [None, 1, 2][i % 3]) for i, v in enumerate(x)]
    want = brute(rows, 4, 16, 2)
    assert coded(spark, rows, parts=4, entries=16) == want


def test_edges(spark):
    real = [(5, [0.0, 0.0, 1.0, 1.0], 1), (3, [0.0, 0.0, 1.0, 1.0], 1), (3, [-0.001, 0.0, 1.0, 1.0], None),
            (3, [-0.001, 0.0, 1.0, 1.0], None), (None, [9.0, 9.0, 9.0, 9.0], None),
            (9, [-2.5, 0.5, 100.0, -100.0], 2)]
    bad = [(1, None, 1), (2, [], 1), (4, [NAN, 0.0, 0.0, 0.0], 1), (6, [INF, 0.0, 0.0, 0.0], 1),
           (7, [None, 0.0, 0.0, 0.0], 1), (8, [1.0, 2.0], 1)]
    assert coded(spark, real + bad, parts=2, entries=64) == brute(real, 2, 64, 2)
    for rows in (bad[:5], []):
        found, books = vector_codes.compress(frame(spark, rows))
        assert found.collect() == [] and books is None
        assert found.columns == ["id", "label", "code", "error", "label_error"]


def test_one_vector_on_most_rows(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(200)] + [(200 + i, [float(i), 0.0], 1) for i in range(9)]
    assert coded(spark, rows, parts=2, entries=4) == brute(rows, 2, 4, 2)


def test_refused(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(frame(spark, [(1, [1.0, 2.0, 3.0], 0)]), parts=2)
    with pytest.raises(ValueError, match="too large"):
        vector_codes.compress(frame(spark, [(1, [1e9, 2.0], 0)]), parts=2)
    with pytest.raises(ValueError, match="id"):
        vector_codes.compress(frame(spark, [(None, [1.0, 2.0], 0)]), parts=2)


@pytest.mark.parametrize("bits", [None, 5, 13])
@pytest.mark.parametrize("size", [3, 2**12, 2**27])
def test_products_are_exact(bits, size):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-size, size + 1, (20, 33)) for _ in range(2))
    want = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    assert limbs.exact_products(a, b, bits).tolist() == want


def test_limbs_add_up_and_products_of_limbs_stay_exact():
    x = np.array([0, 1, -1, 255, -256, 2**40 + 7, -(2**40) - 7])
    for bits in (3, 8, 25):
        parts = limbs.split(x, bits)
        assert sum(p.astype(np.int64) << (bits * i) for i, p in enumerate(parts)).tolist() == x.tolist()
        assert max(np.abs(p).max() for p in parts) <= 2**bits
    for length in (1, 4, 64, 4096):
        assert length * 4 ** limbs.limb_bits(length) <= 2**53
