"""Joins against side tables, and whole-row first/last per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import stage

# What one executor may hold of a lookup table, before hashing.
BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16


def stored_bytes(lookup: DataFrame) -> int:
    """Size of a stored table of scalars in memory: fixed-width slots plus the bytes of its text."""
    text = [f.name for f in lookup.schema.fields if f.dataType.typeName() in ("string", "binary")]
    lengths = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text]
    rows, *sums = lookup.agg(F.count("*"), *lengths).first()
    return rows * _FIXED_WIDTH * len(lookup.columns) + sum(sums)


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality on every named column."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Column | list[str] | str,
    how: str = "left",
    max_bytes: int | None = None,
    size: int | None = None,
) -> DataFrame:
    """Join a large table to a narrow stored one, broadcasting only when its measured size allows.

    ``lookup`` must be a stored table (see :func:`tidelog.session.stage`), so that measuring it is
    one short pass, left out if a ``size`` it does not exceed is known. Above the bound the join shuffles; the lookup has one row per key, so a hot key
    is heavy on the facts side alone, which adaptive execution splits for the join types used here.
    """
    bound = BROADCAST_BYTES if max_bytes is None else max_bytes
    side = F.broadcast(lookup) if (stored_bytes(lookup) if size is None else size) <= bound else lookup
    return facts.join(side, on, how)


def shuffle_join(
    facts: DataFrame, lookup: DataFrame, on: Column, how: str = "left", max_bytes: int | None = None
) -> DataFrame:
    """Join a stream to a stored table without a broadcast, which the driver gathers for every batch.

    Both sides meet by key: hashed if the table is within the bound of a broadcast, else sorted.
    """
    bound = BROADCAST_BYTES if max_bytes is None else max_bytes
    way = "shuffle_hash" if stored_bytes(lookup) <= bound else "merge"
    return facts.join(lookup.hint(way), on, how)


def pick_by(
    df: DataFrame,
    keys: list[str],
    order: str,
    last: bool = True,
    max_bytes: int | None = None,
) -> DataFrame:
    """Whole rows holding the highest (or lowest) ``order`` of each key.

    The aggregate carries only keys and ``order``: fixed-width buffers keep it a hash aggregate with
    map-side partials, and payloads never shuffle. The second read is bounded by the extreme of the
    winners, a scalar that reaches the Parquet scan, so a last-value read touches the log's tail.
    """
    best = F.max(order) if last else F.min(order)
    winners = stage(
        df.where(F.col(order).isNotNull()).groupBy(*keys).agg(best.alias(order)), "winners"
    )
    edge = winners.agg((F.min if last else F.max)(order)).scalar()
    reach = df.where(F.col(order) >= edge if last else F.col(order) <= edge)
    return lookup_join(reach, winners, same(reach, winners, [*keys, order]), "left_semi", max_bytes)
