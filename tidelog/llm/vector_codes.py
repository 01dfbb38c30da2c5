"""Vector code compression: product codebooks trained and applied in exact integer arithmetic.

Vectors are cut into equal parts, and every part position has a codebook. Distances come from exact
products (:mod:`tidelog.llm.limbs`): the squared distance to an entry is ``x.x - 2 x.c + c.c``, all in
int64, so an assignment is the first entry of the least distance on every machine. A pass over the rows
takes the codebooks as a broadcast of fixed size; each task adds up the parts of its rows per entry, and
Spark adds up the tasks. Nothing else leaves the tasks, so a pass shuffles one row per task and entry.

Defined results: null or empty vectors, those with null or non-finite components and those of another
length than the commonest one (the shorter on ties) are left out; rows that repeat are rows of their own;
an id on several rows starts the codebooks once, with the smallest of its vectors; rows without an id
never start one but are coded; with fewer ids than entries the codebooks are as small; equal distances
go to the lower entry; labels that are null count as one label; without vectors the result is empty.
Vectors that do not cut into equal parts, and components so large that a distance passes 64 bits, are an
error. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import ship_package
from tidelog.llm.limbs import exact_products
from tidelog.llm.vectors import Integers, integer_vectors, matrix
from tidelog.operators.lookup import lookup_join
from tidelog.session import stage

PARTS, ENTRIES, ROUNDS = 16, 64, 2


@dataclass(frozen=True)
class Codebooks:
    """``values[part, entry, position]``, and how to code vectors with them."""

    values: np.ndarray

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole vectors as ``[part, row, position]``."""
        p, _, w = self.values.shape
        return x.reshape(len(x), p, w).transpose(1, 0, 2)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, ``[part, row]``, and its squared distance."""
        cut = self.parts(x)
        own = (self.values * self.values).sum(axis=2)[:, None, :]
        gaps = own - 2 * exact_products(cut, self.values)
        nearest = gaps.argmin(axis=2)
        least = np.take_along_axis(gaps, nearest[:, :, None], axis=2)[:, :, 0]
        return nearest, least + (cut * cut).sum(axis=2)

    def text(self) -> str:
        """All components by part, entry and position, with commas."""
        return ",".join(map(str, self.values.ravel().tolist()))


def _first(data: Integers, parts: int, entries: int) -> Codebooks:
    """Codebooks that hold the parts of the smallest ids."""
    named = data.rows.where("id IS NOT NULL")
    ids = [r.id for r in named.groupBy("id").count().orderBy("id").limit(entries).collect()]
    chosen = named.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v"))
    x = np.array([r.v for r in sorted(chosen.collect())], np.int64).reshape(-1, data.length)
    return Codebooks(x.reshape(len(x), parts, data.length // parts).transpose(1, 0, 2))


def _moved(data: Integers, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of the parts that are nearest to it."""
    shared = data.rows.sparkSession.sparkContext.broadcast(books)
    p, k, w = books.values.shape

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        sums, counts = np.zeros((p, k, w), np.int64), np.zeros((p, k), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), p * w)
            nearest, _ = now.assign(x)
            cut = now.parts(x)
            for part in range(p):
                np.add.at(sums[part], nearest[part], cut[part])
                counts[part] += np.bincount(nearest[part], minlength=k)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
             pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    found = data.rows.select("v").mapInArrow(
        add_up, "part int, entry int, n long, sums array<long>"
    )
    totals = found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(w)]
    )
    values = books.values.copy()
    for r in totals.collect():  # as many rows as there are entries, whatever the input
        values[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(w)]
    return Codebooks(values)


def _coded(data: Integers, books: Codebooks) -> DataFrame:
    """``id, label, code, error`` of every row."""
    shared, length = data.rows.sparkSession.sparkContext.broadcast(books), data.length
    schema = data.rows.select("id", "label").schema.add("code", "string").add("error", "long")

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, least = shared.value.assign(matrix(batch.column(2), length))
            digits = np.ascontiguousarray(nearest.T.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([d.tobytes().hex() for d in digits]),
                 pa.array(least.sum(axis=0))],
                ["id", "label", "code", "error"],
            )

    return data.rows.select("id", "label", "v").mapInArrow(code, schema)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """``id, label, code, error, label_error`` of every vector, and the codebooks.

    A code is two hex digits a part; ``error`` is the squared distance that coding costs, in units of
    1/256 of a component, ``label_error`` its sum over all rows with the label.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    ship_package(vectors.sparkSession)
    keep = {"id": vectors[id_col].cast("long"), "label": vectors[label_col]}
    data = integer_vectors(vectors, vec_col, keep)
    if data is None:
        kind = vectors.select(vectors[label_col].alias("label")).schema["label"]
        empty = "code string, error long, label_error long"
        schema = vectors.sparkSession.createDataFrame([], f"id long, {empty}").schema
        schema.fields.insert(1, kind)
        return vectors.sparkSession.createDataFrame([], type(schema)(schema.fields)), None
    if data.length % parts:
        raise ValueError(f"{data.length} components do not make {parts} equal parts")
    if data.length * (2 * data.largest + 2) ** 2 >= 1 << 62:
        raise ValueError("components are too large: squared distances pass 64 bits")
    books = _first(data, parts, entries)
    if not books.values.shape[1]:
        raise ValueError("no row has an id: there is nothing to start codebooks from")
    for _ in range(rounds):
        books = _moved(data, books)
    coded = stage(_coded(data, books), "codes")
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "_label")
    joined = lookup_join(coded, sums, coded["label"].eqNullSafe(sums["_label"]), "left")
    return joined.drop("_label"), books
