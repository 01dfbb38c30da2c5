"""MinHash near-dedup: similarity sketches, bands, exact checks, connected components.

The sketch of a set has a fixed number of bins. In round i every element is hashed anew to a bin and
a value, and a bin keeps the smallest value of the first round that reached it; from round ``BINS`` on,
round i goes to bin i - ``BINS`` alone, so after ``2 * BINS`` rounds every bin is full whatever the set's
size, and most sets are done after a few rounds. The share of equal bins estimates the Jaccard
similarity with the bounds of independent samples. Bands of bins make candidates, and every link is
confirmed on the full sets.

Documents with equal sets are one class, and only its smallest id is compared. In a bucket of one band
all members meet its smallest id first. Buckets that then still hold several components are searched
whole, in blocks, for pairs from different components, so no link is lost to a hub that happens to be
too far away; pairs inside one component are never made.

Defined results: a null text or one without words has an empty set and links with nothing; a text with
fewer words than a shingle is one shingle; rows without an id are kept and belong to no component; an
id stands for one text, and rows that repeat it share its component; an empty table gives an empty
table; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import map_texts, ship_package
from tidelog.llm.components import LOOKUP_BYTES, connected_components
from tidelog.operators.lookup import lookup_join
from tidelog.session import scratch, stage

BINS = 256
BANDS, BAND_ROWS = 32, 4  # at similarity 0.8, all bands differ with a chance of 5 in 10^8
BLOCK = 1024
# Sets of at most so many shingles are compared by two bytes of every shingle, larger ones by sketch.
FOLDED = 512
# Bins may fall short of the threshold by so many standard deviations before a pair is passed over.
SLACK = 5.0

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = np.random.default_rng(20240917).integers(1, 1 << 63, 2 * BINS, dtype=np.uint64)
_MULTIPLY = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_VALUE = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    for factor in _MULTIPLY:
        x *= factor
        x ^= x >> np.uint64(33)
    return x


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``size`` consecutive words."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(size, len(found))
    parts = len(found) - size + 1
    rolled = np.full(parts, size, np.uint64)
    for i in range(size):
        rolled = _mix(rolled ^ hashes[i:i + parts])
    return np.unique(rolled)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of non-empty sets: one row of ``BINS`` values each."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    out = np.full((n, BINS), _EMPTY)
    cells = out.ravel()
    for i in range(2 * BINS):
        mixed = _mix(flat ^ _SEEDS[i])
        bins = (mixed >> np.uint64(56)).astype(np.intp) if i < BINS else i - BINS
        np.minimum.at(cells, owner * BINS + bins, (mixed & _VALUE) | np.uint64(i << 48))
        unfilled = (out == _EMPTY).any(axis=1)
        still = unfilled[owner]
        if not still.all():
            flat, owner = flat[still], owner[still]
            if not len(flat):
                break
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    groups = sketch[:, :BANDS * BAND_ROWS].reshape(len(sketch), BANDS, BAND_ROWS)
    key = np.broadcast_to(
        np.arange(1, BANDS + 1, dtype=np.uint64) * _MULTIPLY[0], groups.shape[:2]
    ).copy()
    for i in range(BAND_ROWS):
        key = _mix(key ^ groups[:, :, i])
    return key.view(np.int64)


def _signatures(size: int):
    """Per text: the size and digest of its set, the bands, and what pairs are compared by.

    ``brief`` holds a byte of every bin and four of every band; ``folded`` two bytes of each member
    of a set that is not large.
    """

    def step(texts: list[str | None]) -> dict[str, list]:
        sets = [shingles(t, size) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        out = {
            "n": [len(s) for s in sets], "f1": [0] * len(sets), "f2": [0] * len(sets),
            "bands": [[] for _ in sets], "brief": [None] * len(sets), "folded": [None] * len(sets),
        }
        if full:
            made = sketches([sets[i] for i in full])
            keys = bands(made)
            brief = np.hstack([
                (_mix(made) >> np.uint64(56)).astype(np.uint8),
                keys.astype("<u4").view(np.uint8).reshape(len(full), -1),
            ])
            for row, i in enumerate(full):
                digest = xxhash.xxh3_128_digest(sets[i].tobytes())
                out["f1"][i], out["f2"][i] = np.frombuffer(digest, np.int64).tolist()
                out["bands"][i] = keys[row]
                out["brief"][i] = brief[row].tobytes()
                if len(sets[i]) <= FOLDED:
                    out["folded"][i] = (sets[i] >> np.uint64(48)).astype("<u2").tobytes()
        return out

    return step


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The id column, ``n_shingles``, ``component_id`` and ``kept``; one row per row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets; the
    component is the smallest id reachable, and the row with that id is kept.
    """
    with scratch(docs.sparkSession) as kept:
        source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
        signed = stage(
            map_texts(
                source, ["id"], "text",
                "n long, f1 long, f2 long, bands array<bigint>, brief binary, folded binary",
                lambda: _signatures(shingle_words),
            ),
            "signatures",
        )
        real = signed.where("n > 0 AND id IS NOT NULL")
        classes = stage(
            real.groupBy("f1", "f2").agg(
                F.min("id").alias("id"), F.min_by(F.struct("n", "bands"), "id").alias("of")
            ).select("f1", "f2", "id", "of.n", "of.bands"),
            "classes",
        )
        banded = stage(classes.select("id", "n", F.posexplode("bands").alias("no", "band")), "bands")
        buckets = stage(
            banded.groupBy("band").agg(F.min(F.struct("id", "n")).alias("hub"),
                                       F.count("*").alias("members"))
            .where("members > 1")
            .select("band", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), "members"),
            "buckets",
        )
        in_hub = banded.join(buckets, "band")  # buckets grow with the documents: never broadcast
        small, large = F.least("n", "hub_n"), F.greatest("n", "hub_n")
        pairs = in_hub.where((F.col("id") != F.col("hub")) & (100 * small >= percent * large))
        pairs = pairs.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
        pairs = stage(pairs, "pairs")
        links = stage(_confirmed(pairs, source, shingle_words, percent), "near-links")
        part = stage(connected_components(links), "parts")
        more = _missed(banded, buckets, part, real, percent)
        if more is not None:
            late = stage(_confirmed(more, source, shingle_words, percent), "near-links")
            if not late.isEmpty():
                part = stage(connected_components(links.unionByName(late)), "parts")
        named = classes.select("f1", "f2", "id")
        named = lookup_join(named, part, "id", "left", LOOKUP_BYTES).select(
            "f1", "f2", F.coalesce("component", "id").alias("component")
        )
        named = kept.keep(stage(named, "components"))
        rest = kept.keep(stage(signed.select("id", "n", "f1", "f2"), "documents"))
    joined = lookup_join(rest, named, ["f1", "f2"], "left", LOOKUP_BYTES)
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(
        F.col("id")
    )
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough.

    The sets are made again from the texts of the documents in question. A set travels once to its
    partners and each pair once to its first member, so that no task holds all partners of a hub.
    """
    wanted = stage(
        pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "id"),
        "wanted",
    )
    texts = lookup_join(docs, wanted, "id", "left_semi", LOOKUP_BYTES)

    def make():
        return lambda rows: {"members": [shingles(t, size).tobytes() for t in rows]}

    sets = stage(map_texts(texts, ["id"], "text", "members binary", make), "sets")
    of_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("right")), "b")
    of_a = sets.select(F.col("id").alias("a"), F.col("members").alias("left"))
    both = of_b.join(of_a, "a").select("a", "b", "left", "right")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared = int((y[at] == x).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ship_package(docs.sparkSession)
    ids = pairs.select("a", "b").schema
    return both.mapInArrow(run, ids).distinct()


def _missed(
    banded: DataFrame, buckets: DataFrame, part: DataFrame, signed: DataFrame, percent: int
) -> DataFrame | None:
    """Pairs from different components that share a bucket and may be similar, by their sketches.

    Buckets of two were decided by their one pair. In the others, all members but those of the
    bucket's largest component meet every member of another component, in blocks of about
    ``BLOCK`` members a side.
    """
    large = buckets.where("members > 2").select("band")
    inside = lookup_join(banded, large, "band", "left_semi", LOOKUP_BYTES)
    inside = lookup_join(inside, part, "id", "left", LOOKUP_BYTES).select(
        "band", "no", "id", "n", F.coalesce("component", "id").alias("component")
    )
    sizes = inside.groupBy("band", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("band").agg(
        F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("members")
    ).where("top.size < members").select(
        "band", F.col("top.component").alias("top"),
        F.ceil((F.col("members") - F.col("top.size")) / BLOCK).cast("int").alias("left_blocks"),
        F.ceil(F.col("top.size") / BLOCK).cast("int").alias("top_blocks"),
    )
    mixed = stage(mixed, "mixed")
    if mixed.isEmpty():
        return None
    rows = lookup_join(inside, mixed, "band", "inner", LOOKUP_BYTES)
    rows = rows.withColumn("rest", F.col("component") != F.col("top"))
    block = F.when(F.col("rest"), F.pmod(F.xxhash64("id"), "left_blocks")).otherwise(
        F.pmod(F.xxhash64("id"), "top_blocks")
    ).cast("int")
    rows = rows.withColumn("block", block)
    # Meeting places of a member: (left block, left block), the smaller first, and (left, top).
    others = F.sequence(F.lit(0), F.col("left_blocks") - 1)
    tops = F.sequence(F.lit(0), F.col("top_blocks") - 1)
    places = F.when(
        F.col("rest"),
        F.concat(
            F.transform(others, lambda x: F.struct(
                F.least(x, "block").alias("i"), F.greatest(x, "block").alias("j"),
                F.lit(False).alias("with_top"))),
            F.transform(tops, lambda x: F.struct(
                F.col("block").alias("i"), x.alias("j"), F.lit(True).alias("with_top"))),
        ),
    ).otherwise(F.transform(others, lambda x: F.struct(
        x.alias("i"), F.col("block").alias("j"), F.lit(True).alias("with_top"))))
    rows = rows.select("band", "no", "id", "n", "component", F.explode(places).alias("place"))
    place = ["band", "i", "j", "with_top"]
    rows = stage(rows, "meetings")
    needed = stage(rows.select("id").distinct(), "needed")
    forms = lookup_join(signed.select("id", "brief", "folded"), needed, "id", "left_semi",
                        LOOKUP_BYTES).dropDuplicates(["id"])
    rows = rows.join(forms, "id").select(
        "band", "place.i", "place.j", "place.with_top", "id", "n", "component", "no", "brief",
        "folded",
    )
    dealt = rows.repartition(*place).sortWithinPartitions(*place)
    share = percent / 100
    floor = BINS * (share - SLACK * (share * (1 - share) / BINS) ** 0.5)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            pairs = _apart(group, percent, floor)
            if pairs:
                a, b = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
                )

    found = dealt.mapInArrow(run, "a long, b long").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    return stage(found.distinct(), "late-pairs")


def _apart(group: pa.RecordBatch, percent: int, floor: float) -> list[tuple[int, int]]:
    """Pairs of one meeting place from different components that may be similar.

    A pair is taken up in the first band it shares and passed over in all others. Sets that are not
    large are compared by the folds of their members: equal members have equal folds, so a pair
    whose equal folds are too few is apart. Others are compared by their sketches alone.
    """
    ids, n, parts = (group.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6))
    no = group.column(7)[0].as_py()
    brief = np.frombuffer(b"".join(group.column(8).to_pylist()), np.uint8).reshape(len(ids), -1)
    bins, keys = brief[:, :BINS], np.ascontiguousarray(brief[:, BINS:]).view("<u4")
    folds = [None if f is None else np.frombuffer(f, "<u2") for f in group.column(9).to_pylist()]
    out = []
    for i in range(len(ids) - 1):
        rest = slice(i + 1, None)
        apart = parts[rest] != parts[i]
        sized = 100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
        at = np.flatnonzero(apart & sized) + i + 1
        if len(at):
            at = at[(bins[at] == bins[i]).sum(axis=1) >= floor]
            at = at[(keys[at] == keys[i]).argmax(axis=1) == no]
        if len(at) and folds[i] is not None:
            member = np.zeros(1 << 16, bool)
            member[folds[i]] = True
        for j in at.tolist():
            if folds[i] is not None and folds[j] is not None:
                shared = int(member[folds[j]].sum())
                if 100 * shared < percent * (n[i] + n[j] - shared):
                    continue
            out.append((ids[i], ids[j]))
    return out


def _groups(batches: Iterable[pa.RecordBatch]):
    """Runs of rows with one meeting place, from sorted batches."""
    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        keys = [held.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        turns = np.zeros(held.num_rows, bool)
        for k in keys:
            turns[1:] |= k[1:] != k[:-1]
        starts = [0, *np.flatnonzero(turns).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield held.slice(a, b - a)
        held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held
