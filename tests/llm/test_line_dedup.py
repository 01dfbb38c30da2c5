import string
from collections import Counter

import pytest

from check import differs, oracle_tables
from tidelog.llm import line_dedup, queries
from tests.llm.conftest import EDGES, SMALL

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)


def brute(rows, min_docs):
    docs = [(i, t, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, ls in {(i, t): ls for i, t, ls in docs}.items()
                   for k in {key(x) for x in ls} - {""})
    out = []
    for i, _, lines in docs:
        kept = [x for x in lines if not key(x) or seen[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(docs, min_docs):
    kept = line_dedup.apply_masks(docs, line_dedup.line_masks(docs, min_docs=min_docs))
    rows = kept.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_edges(edges, min_docs):
    assert run(edges, min_docs) == brute(EDGES, min_docs)


def test_keys_fold_ascii_only(spark):
    rows = list(enumerate(["É a", "é A", "É A", "İx", "İX", "i̇x", "Kx", "Kx",
                           "kx", "KX", " kX\x0b", " kx", "ΑΣ b", "ΑΣ B", "ας B"]))
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), 2) == brute(rows, 2)


def test_runs(spark):
    rows = [(1, "a\nb\nx\nc\ny\nb\nb"), (2, "b\nz\nc"), (3, "c\nc\nc"), (4, "q\n\nc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    masks = {r.id: r.keep_runs for r in line_dedup.line_masks(docs, min_docs=2).collect()}
    assert masks == {1: [1, 1, 1, 1, 1, 2, 0], 2: [0, 1, 1, 1, 0], 3: [0, 3, 0], 4: [2, 1, 0]}
    assert run(docs, 2) == brute(rows, 2)


def test_empty(nothing):
    assert run(nothing, 2) == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    frame = queries.QUERIES[name](spark, SMALL)
    assert differs(frame, oracle_tables(SMALL), queries.ORACLES[name]) is None


def test_native(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    frame = line_dedup.apply_masks(docs, line_dedup.line_masks(docs))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
