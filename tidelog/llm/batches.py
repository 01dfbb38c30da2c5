"""Whole texts in Arrow batches: what the operators that work in Python share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.session import stage

# Bytes that one step of a batch may hold; a longer text is a step of its own.
STEP_BYTES = 1 << 19
# Rows that Spark puts into one Arrow batch, on its side and in Python. Texts are long, so its default of
# 10,000 rows would hold tens of megabytes in every task at once.
BATCH_ROWS = "500"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, which need not have it installed.

    Spark's own file service sends it; nothing is read from the driver's folders by path. The session's
    Arrow batches are made shorter, which bounds the memory of tasks and changes no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    _ship(spark.sparkContext.applicationId, spark.sparkContext)


@cache
def _ship(application: str, context) -> None:
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidelog-py-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def map_texts(
    docs: DataFrame,
    keep: list[str],
    text_col: str,
    schema: str,
    make: Callable[[], Callable[[list[str | None]], dict[str, list]]],
) -> DataFrame:
    """Add columns computed from whole texts; one row out for each row in, in no shuffle.

    ``make`` is called once per task and returns the function that turns a list of texts into the
    new columns; ``schema`` is the DDL of the new columns. Only ``keep`` and the text are read, so
    other columns of ``docs``, whatever their names, have no effect.
    """
    ship_package(docs.sparkSession)
    source = docs.select(*[docs[c] for c in keep], docs[text_col].alias("__text"))
    made = docs.sparkSession.createDataFrame([], schema).schema
    kept = docs.select(*[docs[c] for c in keep]).schema
    out = type(made)([*kept.fields, *made.fields])
    names = [f.name for f in made.fields]
    types = to_arrow_schema(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            held = batch.num_columns - 1
            texts = batch.column(held)
            for start, stop in steps(texts):
                new = step(texts.slice(start, stop - start).to_pylist())
                sides = [batch.column(i).slice(start, stop - start) for i in range(held)]
                sides = [a.cast(types.field(i).type) for i, a in enumerate(sides)]
                sides += [
                    pa.array(new[n], type=types.field(held + j).type)
                    for j, n in enumerate(names)
                ]
                yield pa.RecordBatch.from_arrays(sides, schema=types)

    return source.mapInArrow(run, out)


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of whole texts of at most ``limit`` bytes (or of one text)."""
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        size = size or 0
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of a value's text by a modulus; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def document_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """128 bits, ``k1`` and ``k2``, that name a document: its id with its text, nulls included."""
    id_, text = docs[id_col], docs[text_col]
    nulls = F.when(id_.isNull(), F.lit(1)).otherwise(0)
    return [
        F.xxhash64(nulls, id_, F.lit(1), text).alias("k1"),
        F.xxhash64(F.lit(2), text, nulls, id_).alias("k2"),
    ]


DOC_KEY = ["k1", "k2"]


def lowest(df: DataFrame, draw: str, ties: list[str], bound: int) -> DataFrame:
    """The ``bound`` rows with the lowest hashes in column ``draw``.

    About twice as many rows pass a literal bound on the hash first, so that what meets in one place
    to be sorted depends on ``bound`` alone, not on the number of rows or partitions.
    """
    share = 2 * bound / max(1, df.count())
    if share < 0.5:
        df = df.where(F.col(draw) < int(-(2.0 ** 63) + share * 2.0 ** 64))
    return df.orderBy(draw, *ties).limit(bound)


def labelled(
    docs: DataFrame, labels: DataFrame, label_col: str, bound: int,
    id_col: str = "doc_id", text_col: str = "text", once: bool = False,
) -> DataFrame:
    """``text, label`` of at most ``bound`` labelled documents, those with the lowest id hashes.

    The cut is found on ids alone, so that only texts that are learned from are joined. With ``once``
    an id on several rows gives one text, that with the lowest hash.
    """
    draw = F.xxhash64(F.lit("draw"), labels[id_col])
    known = labels.select(
        labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"),
        draw.alias("draw"),
    ).where("label IN (0, 1) AND id IS NOT NULL").dropDuplicates(["id"])
    chosen = stage(lowest(known, "draw", ["id"], bound), "labelled")
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    known = texts.join(F.broadcast(chosen), "id")
    if once:
        least = F.min_by(F.struct("text", "label"), F.xxhash64("text"))
        known = known.groupBy("id").agg(least.alias("row")).select("row.*")
    return known.select("text", "label")
