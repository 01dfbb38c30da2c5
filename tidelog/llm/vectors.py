"""Rows with integer vectors, as the operators on vector codes and inner products take them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import stage

SCALE = 256


def finite(vector: Column) -> Column:
    """Vectors that are there, hold something and have only finite components."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


@dataclass(frozen=True)
class Integers:
    """Stored rows whose vectors ``v`` have ``length`` integers of at most ``largest``, sign aside."""

    rows: DataFrame
    length: int
    largest: int


def integer_vectors(
    vectors: DataFrame, vec_col: str, keep: dict[str, Column], scale: int = SCALE
) -> Integers | None:
    """Store ``keep`` and ``v``, the components times ``scale`` rounded down; None without a vector.

    Vectors that are null, empty or hold null or non-finite components are left out, and so are
    those of another length than the commonest one (the shorter on ties).
    """
    real = vectors[vec_col].cast("array<double>")
    rows = vectors.select(*[c.alias(n) for n, c in keep.items()], real.alias("_v"))
    rows = rows.where(finite(F.col("_v")))
    whole = F.transform("_v", lambda c: F.floor(c * scale))
    rows = stage(rows.select(*keep, whole.alias("v")), "integers")
    lengths = rows.groupBy(F.size("v").alias("length")).agg(
        F.count("*").alias("n"), F.max(F.array_max("v")).alias("top"),
        F.min(F.array_min("v")).alias("low"),
    )
    first = lengths.orderBy(F.desc("n"), "length").first()
    if first is None:
        return None
    return Integers(
        rows.where(F.size("v") == first.length), first.length, max(first.top, -first.low)
    )


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A column of lists of one length as a matrix of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.int64)
