"""Which ids may have been seen before: a few bits an id, asked ahead of the ids themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.delivery import has_id
from tidelog.operators.lookup import BROADCAST_BYTES

# Bits of one of Spark's bitmaps, and how many of them an id sets; bits stored without that number have three.
SEGMENT_BITS, BITS_AN_ID, ONCE_BITS_AN_ID = 32_768, 8, 3
# 4 MB of bits, and how many ids may be in a segment before other bits begin: by chance one new id in 30
# million is doubtful for each such set of bits.
SEGMENTS, SEGMENT_IDS = 1_024, 500

SEEN = T.StructType([
    T.StructField("segment", T.LongType()),
    T.StructField("bits", T.BinaryType()),
])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# As SQL text: a column made call by call costs more than a batch's ids to look up.
def _segment(message_id: str, segments: int) -> str:
    return f"pmod(xxhash64({_quoted(message_id)}), {segments})"


def _places(message_id: str) -> list[str]:
    return [f"pmod(xxhash64({_quoted(message_id)}, {n}), {SEGMENT_BITS})" for n in range(BITS_AN_ID)]


def seen_bits(ids: DataFrame, message_id: str = "Id", segments: int = SEGMENTS) -> DataFrame:
    """The bits that the ids of a table set, a bitmap for each segment any id falls in."""
    places = ids.where(has_id(message_id)).select(
        F.expr(f"CAST({_segment(message_id, segments)} AS BIGINT) AS segment"),
        F.expr(f"explode(array({', '.join(_places(message_id))})) AS _place"),
    )
    return places.groupBy("segment").agg(F.bitmap_construct_agg("_place").alias("bits"))


def merge_bits(bits: DataFrame) -> DataFrame:
    """One bitmap a segment, with every bit that any of several tables sets."""
    return bits.groupBy("segment").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_seen(
    ids: DataFrame, bits: DataFrame, message_id: str = "Id", segments: int = SEGMENTS,
    few_ids: bool = False,
) -> DataFrame:
    """The rows whose id may be among those that set ``bits``; the others surely are not.

    ``bits`` has one row a segment, so its size is bounded by their number: it is broadcast if that many
    fit. It may hold several sets of bits, with ``bits_an_id`` if they differ in that; a row then comes out
    for each that may know it. ``few_ids`` broadcasts the ids instead.
    """
    per_id = f"coalesce(bits_an_id, {ONCE_BITS_AN_ID})" if "bits_an_id" in bits.columns else BITS_AN_ID
    known = bits.selectExpr("segment AS _segment", "bits AS _bits", f"{per_id} AS _per_id")
    same = F.expr(f"_segment = {_segment(message_id, segments)}")
    if few_ids:
        met = known.join(F.broadcast(ids), same)
    else:
        if segments * SEGMENT_BITS // 8 <= BROADCAST_BYTES:
            known = F.broadcast(known)
        met = ids.join(known, same)
    set_bits = [
        f"(_per_id <= {n} OR getbit(CAST(conv(hex(substring(_bits, CAST(floor({place} / 8) + 1 AS INT), 1)), "
        f"16, 10) AS INT), CAST(pmod({place}, 8) AS INT)) = 1)"
        for n, place in enumerate(_places(message_id))
    ]
    return met.where(" AND ".join(set_bits)).select(*ids.columns)


def id_bucket(message_id: str, order: str, buckets: int) -> Column:
    """The bucket of an id; rows without one are spread by ``order``, so no bucket is hot."""
    key = F.when(has_id(message_id), F.col(message_id)).otherwise(F.col(order).cast("string"))
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
