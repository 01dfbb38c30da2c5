import re

import pytest

from tidelog.llm import decontamination
from tests.llm.conftest import EDGES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(folded)


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        if item is not None and size:
            for i in range(len(w) - size + 1):
                windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for at in range(len(w) - size + 1):
                if names := windows.get(tuple(w[at:at + size])):
                    hit |= set(range(at, at + size))
                    found |= names
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def run(docs, items, **options):
    rows = decontamination.contamination(docs, items, **options).collect()
    for r in rows:
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    return sorted(
        ((r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), list(r["items"]))
         for r in rows), key=repr,
    )


ITEMS = [
    (1, "the cat sat on"), (2, "word " * 12), (3, None), (4, ""), (None, "one"), (5, "!!"),
    (6, "Cat, sat"), (6, "Cat, sat"), (7, "don t"), (8, "one"), (9, "é日本"),
    (10, "the cat sat on the mat and more words follow here"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_edges(spark, edges, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(edges, items, block_bytes=block_bytes) == brute(EDGES, ITEMS)


def test_empty(spark, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(nothing, items) == []
    assert run(edges, items.limit(0)) == brute(EDGES, [])


def test_overlaps_and_repeats(spark):
    text = " ".join("a b a b a b a b a b a b c a b c".split() * 5)
    rows = [(1, text), (2, "x " + text + " y"), (3, "a b a")]
    items = [(1, "a b a b a b a b a b a b a"), (2, "b c a b c a b"), (3, "a b a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    for window in (3, 4, 10):
        assert run(docs, frame, window=window) == brute(rows, items, window)


def test_decontaminate_keeps_columns_and_clean_rows(spark, edges):
    items = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "one two")],
                                  "item_id long, text string")
    left = decontamination.decontaminate(edges, items)
    assert left.columns == edges.columns
    want = sorted((repr(i) for i, _ in EDGES if i not in (5, 12, 13)))
    assert sorted(repr(r.doc_id) for r in left.collect()) == want
