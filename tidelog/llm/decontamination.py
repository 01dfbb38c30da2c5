"""Benchmark decontamination: every occurrence of every benchmark window, by Wu-Manber search.

A window is ten consecutive words of a benchmark item, or a whole shorter item. Words become numbers
and windows of one length are searched together: the hash of the two words at a window's end looks up
how far the search may skip, and where it may not, the bucket of windows that end in these words is
compared word by word. Documents are scanned in place; nothing is shuffled.

The benchmark is the query set. Its items are dealt to blocks of bounded size by their hash; one block
is the rule, and beyond that each block scans all documents and only documents with hits are merged.

Defined results: null and empty texts have no words and no hits; items without an id or without words
take no part; rows that repeat an item are one item; an empty benchmark hits nothing; only the named
columns are read.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import DOC_KEY, document_key, map_texts
from tidelog.operators.lookup import lookup_join
from tidelog.session import stage

# Bytes of benchmark text that one block may hold.
BLOCK_BYTES = 8 << 20
# A to Z become a to z, and ASCII that is neither letter nor digit separates words.
_FOLD = bytes(
    b if b >= 0x80 or chr(b) in string.digits + string.ascii_lowercase
    else b + 32 if chr(b) in string.ascii_uppercase
    else 0x20
    for b in range(256)
)
_SPANS = "array<struct<start:int,stop:int>>"


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8: letters and digits of ASCII in lower case, and everything beyond ASCII."""
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


class Search:
    """Wu-Manber tables for patterns of ``length`` word numbers."""

    SLOTS = 1 << 16

    def __init__(self, length: int, patterns: dict[tuple[int, ...], list[int]]):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        self.shift = np.full(self.SLOTS, length - self.block + 1, np.int32)
        self.buckets: dict[int, list[tuple[int, ...]]] = {}
        for pattern in patterns:
            slots = self._slots(np.array(pattern, np.int64)).tolist()
            for end in range(self.block - 1, length):
                slot = slots[end]
                self.shift[slot] = min(self.shift[slot], length - 1 - end)
            self.buckets.setdefault(slots[-1], []).append(pattern)

    def _slots(self, ids: np.ndarray) -> np.ndarray:
        """The slot of the block that ends at each word."""
        mixed = ids * 0x9E3779B1
        if self.block == 2:
            mixed[1:] += ids[:-1] * 0x85EBCA77
        return (mixed ^ (mixed >> 15)) & (self.SLOTS - 1)

    def find(self, ids: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
        """Where each occurrence starts, and its pattern."""
        n, length = len(ids), self.length
        if n < length:
            return []
        slots = self._slots(ids)
        skip = self.shift[slots].tolist()
        found = []
        at = length - 1
        while at < n:
            if step := skip[at]:
                at += step
                continue
            start = at - length + 1
            here = tuple(ids[start:at + 1].tolist())
            for pattern in self.buckets.get(int(slots[at]), ()):
                if pattern[0] == here[0] and pattern == here:
                    found.append((start, pattern))
            at += 1
        return found


class Benchmark:
    """All windows of one block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            if size:
                windows = by_length.setdefault(size, {})
                for i in range(len(ids) - size + 1):
                    windows.setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.searches = [Search(size, windows) for size, windows in by_length.items()]

    def scan(self, text: str | None) -> tuple[int, list[dict], list[int]]:
        """The number of words, the hit spans of words, and the items with occurrences."""
        found = words(text)
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in found), np.int64, len(found))
        spans, items = [], set()
        for search in self.searches:
            for start, pattern in search.find(ids):
                spans.append((start, start + search.length))
                items |= search.patterns[pattern]
        return len(found), joined(spans), sorted(items)


def joined(spans: list[tuple[int, int]]) -> list[dict]:
    """Sorted spans without overlaps."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [{"start": a, "stop": b} for a, b in out]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The id column with ``n_words``, ``spans`` of hit words and the ``items`` that hit.

    One row per row of ``docs``. ``items`` are the distinct ids of items with an occurring window.
    """
    items = benchmark.select(
        benchmark[item_col].cast("long").alias("item"), benchmark[item_text_col].alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        return _scan(docs, _collect(items), window, [id_col], text_col)
    keyed = docs.select(*document_key(docs, id_col, text_col), docs[id_col].alias("id"),
                        docs[text_col].alias("text"))
    part = F.pmod(F.xxhash64("item"), F.lit(blocks))
    hits = None
    for k in range(blocks):
        scanned = _scan(keyed, _collect(items.where(part == k)), window, DOC_KEY, "text")
        scanned = stage(scanned.where(F.size("items") > 0).drop("n_words"), "benchmark-hits")
        hits = scanned if hits is None else hits.unionByName(scanned)
    merged = hits.distinct().groupBy(*DOC_KEY).agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = _scan(keyed, [], window, [*DOC_KEY, "id"], "text").drop("spans", "items")
    empty = F.array().cast
    # Spans of different blocks may overlap: each one keeps what lies behind all earlier ones.
    disjoint = F.aggregate(
        F.coalesce("spans", empty(_SPANS)),
        F.struct(F.lit(0).alias("end"), empty(_SPANS).alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["stop"]).alias("end"),
            F.when(s["stop"] > acc["end"], F.concat(acc["out"], F.array(F.struct(
                F.greatest(acc["end"], s["start"]).alias("start"), s["stop"].alias("stop")
            )))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return counted.join(merged, DOC_KEY, "left").select(
        F.col("id").alias(id_col), "n_words", disjoint.alias("spans"),
        F.coalesce("items", empty("array<bigint>")).alias("items"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all columns as they are."""
    marked = docs.select(
        F.struct(*document_key(docs, id_col, text_col)).alias("id"), docs[text_col].alias("text")
    )
    found = contamination(marked, benchmark, window, "id", "text")
    dirty = stage(
        found.where(F.size("items") > 0).select("id.k1", "id.k2").distinct(), "contaminated"
    )
    rows = docs.select(
        *document_key(docs, id_col, text_col),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    clean = lookup_join(rows, dirty, DOC_KEY, "left_anti")
    return clean.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _collect(items: DataFrame) -> list[tuple[int, str]]:
    return [(r.item, r.text) for r in items.collect()]


def _scan(
    docs: DataFrame, items: list[tuple[int, str]], window: int, keep: list[str], text_col: str
) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def make():
        benchmark = Benchmark(shared.value, window)

        def step(texts):
            counts, spans, hit = zip(*map(benchmark.scan, texts), strict=True)
            return {"n_words": list(counts), "spans": list(spans), "items": list(hit)}

        return step

    return map_texts(
        docs, keep, text_col, f"n_words long, spans {_SPANS}, items array<bigint>", make
    )
