import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, documents
from tidelog.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text=...):
    values = [row[0], row[3], row[2], row[4], row[1] if text is ... else text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves):
    """Levels of a tree, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = range(i - i % 3, min(len(level), i - i % 3 + 3))
        out.append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        i //= 3
    return out


def brute(rows, claim):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    trees = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in members])
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for g in order:
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, order.index(g))
            h = claim(r) or leaf(r)
            for a, b in steps:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], "".join(a + b for a, b in steps), h))
    return sorted(out, key=repr)


def tampered(row):
    return leaf(row, row[1] and row[1].replace("a", "")) if row[0] is not None and row[0] % 2 else None


def proven(spark, rows):
    frame = spark.createDataFrame([(*r, *"kirl", 1, *"sc") for r in rows], SCHEMA)
    changed = merkle.leaf_digest(
        [frame[c] for c in FIELDS[:-1]] + [F.replace(frame["text"], F.lit("a"), F.lit(""))])
    claim = F.when(F.col("doc_id") % 2 != 0, changed)
    found = merkle.prove(merkle.build(frame, FIELDS, claim=claim), frame)
    return found, sorted(
        (tuple(r) for r in found.select("key", "leaf", "subroot", "root", "proof", "folded_root").collect()),
        key=repr)


def test_edges(spark):
    rows = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", 1), (2, None, None, "s", None),
            (None, "x", None, "s", 5), (None, None, None, None, None), (3, "", "en", None, 0),
            (4, "long " * 50_000 + "é", "fr", "t", 7), (-7, "a\nb", "en", "é", 3), (5, "x", "en", "", 1),
            (6, "x", "en", "\U0001f600", 1), (8, "x", "en", "�", 1)]
    _, got = proven(spark, rows)
    assert got == brute(rows, tampered)


def test_one_row_and_none(spark):
    rows = [(1, "abc", "en", "s", 3)]
    _, got = proven(spark, rows)
    assert got == brute(rows, tampered) and got[0][4] == ""
    found, got = proven(spark, rows[:0] or [])
    assert got == [] and "folded_root" in found.columns


def test_groups_of_several_blocks_and_many_groups(spark):
    """Two tiers below and two above: 2,000 rows in one group and 900 groups of one or two."""
    rows = [(i, f"text {i % 11}", "en", "hot", i) for i in range(2000)]
    rows += [(i, "a" * (i % 4), None, f"g{i % 900}", i) for i in range(1100)]
    found, got = proven(spark, rows)
    assert got == brute(rows, tampered)
    places = [r.log_position for r in found.where("group = 'hot'").collect()]
    assert sorted(places) == [merkle.position(i, 0) for i in range(2000)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 243, 500, 729])
def test_positions_are_those_of_completion(n):
    """Every node of a log stands where the formula says, and no place is left out."""
    leaves = [merkle.digest(str(i)) for i in range(n)]
    levels = merkle.height(n)
    log = merkle.append_log(leaves, levels)
    want, at = climb([x.hex() for x in leaves]), set()
    for level, nodes in enumerate(want):
        span = 3 ** level
        for i, node in enumerate(nodes):
            place = merkle.position(min((i + 1) * span, n) - 1, level)
            assert log[32 * place:32 * place + 32].hex() == node
            at.add(place)
    assert at == set(range(len(log) // 32)) and len(want) == levels + 1


def test_only_tampered_rows_fail(spark):
    found = queries.QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001")
    rows = found.join(documents(spark).select("doc_id", "text"), "doc_id").collect()
    changed = [r for r in rows if not r.verified]
    import zlib
    want = {r.doc_id for r in rows if "\n" in (r.text or "") and zlib.crc32(str(r.doc_id).encode()) % 2 == 0}
    assert {r.doc_id for r in changed} == want and want and len(changed) < len(rows)
