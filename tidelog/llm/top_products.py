"""Exact top-k search by inner product: buckets of like lengths, pruned by local cosine thresholds.

Vectors become integers. Equal vectors are one entry with its smallest ids, as many as a query may
return. Entries are numbered from the longest to the shortest and cut into buckets of neighbours in that
order, buckets into cells that one task holds. A query's products with the longest entries give a first
lower bound on its k-th best product; a cell it cannot reach with that bound never sees it. In a cell the
buckets come in order, and the bound rises with what was found. With ``t`` the cosine that the bound asks
of a vector as long as the bucket's longest, a bucket is

- passed over, if ``t`` is above 1;
- searched by coordinates, if ``t`` is at least ``SWITCH``: a vector within that angle of the query lies
  in a range on every axis, so sorted lists of the query's largest coordinates leave few candidates;
- searched by length otherwise: all entries long enough for the bound.

Either way products are verified exactly (:mod:`tidelog.llm.limbs`), and only each cell's best leave a
task. Bounds in floating point are widened by ``SLACK``, so nothing is passed over that could be found.
Cells and blocks of queries meet in a grid: work is that of queries times the entries not pruned.

Defined results: null or empty vectors, those with null or non-finite components, those of another
length than the commonest one (the shorter on ties) and rows without an id take no part; zero vectors do;
rows that repeat an id and vector are one; a query's own id is never its result; equal products go to the
smaller id; with fewer candidates than asked for all are returned; without vectors the result is empty.
Components so large that a product passes 64 bits are an error. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.batches import ship_package
from tidelog.llm.limbs import exact_products
from tidelog.llm.vectors import integer_vectors, matrix
from tidelog.operators.numbering import number_in_order
from tidelog.session import stage

# Entries in a bucket; bytes of the vectors of a cell, and of the longest entries that give first bounds;
# queries in a block; most cells and most tasks of the grid.
BUCKET, CELL_BYTES, SEED_BYTES = 2048, 32 << 20, 2 << 20
QUERY_BLOCK, MOST_CELLS, MOST_TASKS = 1 << 15, 1 << 16, 10_000
# Cosine from which coordinates are searched, the axes that are tried, and what bounds are widened by.
SWITCH, AXES, SLACK = 0.9, 3, 1e-9


@dataclass
class Bucket:
    """Entries of like lengths, the longest first."""

    ids: np.ndarray
    x: np.ndarray
    norms: np.ndarray
    _lists: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def long_enough(self, least: np.ndarray) -> np.ndarray:
        """How many entries have at least these lengths."""
        return np.searchsorted(-self.norms, -least * (1 - SLACK), side="right")

    def _sorted(self, axis: int) -> tuple[np.ndarray, np.ndarray]:
        """The entries' cosines to an axis in order, and which entry each belongs to."""
        if axis not in self._lists:
            cosine = self.x[:, axis] / np.maximum(self.norms, 1e-300)
            order = np.argsort(cosine, kind="stable")
            self._lists[axis] = cosine[order], order
        return self._lists[axis]

    def near_axes(self, query: np.ndarray, norm: float, cosine: float) -> np.ndarray:
        """Entries that may have that cosine to the query, by its largest coordinates."""
        unit = query / norm
        spread = np.arccos(min(1.0, cosine * (1 - SLACK)))
        left = None
        for axis in np.argsort(-np.abs(unit), kind="stable")[:AXES]:
            angle = np.arccos(np.clip(unit[axis], -1, 1))
            low, high = np.cos(min(np.pi, angle + spread)), np.cos(max(0.0, angle - spread))
            values, order = self._sorted(int(axis))
            a, b = np.searchsorted(values, [low - SLACK, high + SLACK])
            some = order[a:b]
            left = some if left is None else left[np.isin(left, some)]
            if not len(left):
                break
        return np.sort(left)


@dataclass
class Found:
    """The best entries of a block of queries so far, and the products they must reach."""

    k: int
    floor: np.ndarray
    scores: list[np.ndarray]
    ids: list[np.ndarray]

    @staticmethod
    def start(floor: np.ndarray, k: int) -> Found:
        none = [np.empty(0, np.int64) for _ in floor]
        return Found(k, floor.copy(), none, list(none))

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Keep a query's ``k`` best by product, then smaller id; ``k`` of them raise its floor."""
        good = scores >= self.floor[i]
        scores = np.concatenate([self.scores[i], scores[good]])
        ids = np.concatenate([self.ids[i], ids[good]])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[i], self.ids[i] = scores[best], ids[best]
        if len(best) == self.k:
            self.floor[i] = max(self.floor[i], int(self.scores[i][-1]))


def search_bucket(bucket: Bucket, q: np.ndarray, norms: np.ndarray, found: Found,
                  switch: float = SWITCH) -> int:
    """Search a bucket for a block of queries; returns how many products were verified."""
    longest = float(bucket.norms[0])
    floor = found.floor.astype(np.float64)
    # A bound of 0 or less asks for no length: vectors of any length may reach it.
    least = np.where(floor > 0, floor / np.maximum(norms, 1e-300), 0.0)
    active = np.flatnonzero(longest * (1 + SLACK) >= least)
    cosine = least / max(longest, 1e-300)
    by_axes = active[cosine[active] >= switch]
    by_length = active[cosine[active] < switch]
    verified = 0
    for i in by_axes.tolist():
        some = bucket.near_axes(q[i], norms[i], cosine[i])
        if len(some):
            found.add(i, exact_products(q[i:i + 1], bucket.x[some])[0], bucket.ids[some])
            verified += len(some)
    if len(by_length):
        reach = bucket.long_enough(least[by_length])
        most = int(reach.max())
        products = exact_products(q[by_length], bucket.x[:most])
        verified += products.size
        hit = products >= found.floor[by_length][:, None]
        for row in np.flatnonzero(hit.any(axis=1)).tolist():
            some = np.flatnonzero(hit[row])
            found.add(int(by_length[row]), products[row, some], bucket.ids[some])
    return verified


def _floors(q: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """A product that at least ``k`` of the seeds reach, for each query."""
    if len(seeds) < k:
        return np.full(len(q), np.iinfo(np.int64).min)
    return -np.partition(-exact_products(q, seeds), k - 1, axis=1)[:, k - 1]


def entries_of(rows: DataFrame, most: int) -> DataFrame:
    """``entry, ids, v``: distinct vectors with their smallest ids, at most ``most`` of each."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return (
        rows.withColumn("r", place).where(F.col("r") <= most).groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.get("ids", F.lit(0)).alias("entry"), "ids", "v")
    )


def top_products(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    bucket: int = BUCKET,
    cell_bytes: int = CELL_BYTES,
    query_block: int = QUERY_BLOCK,
    switch: float = SWITCH,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest products with other rows.

    Queries are the rows whose id satisfies ``is_query``. Exact, whatever the pruning passes over.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    data = integer_vectors(vectors, vec_col, {"id": vectors[id_col].cast("long")})
    if data is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if data.length * (data.largest + 1) ** 2 >= 1 << 62:
        raise ValueError("components are too large: products pass 64 bits")
    length, most = data.length, k + 1
    rows = stage(data.rows.where("id IS NOT NULL").distinct(), "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    named = entries_of(rows, most).withColumn("short", -F.sqrt(squares))
    entries = stage(number_in_order(named, [], ["short", "entry"], "place"), "entries")
    total = entries.count()

    width = max(bucket, -(-total // (MOST_CELLS * bucket)) * bucket)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fitting = max(1, cell_bytes // (8 * length * bucket))
    per_cell = max(1, min(fitting, total // (bucket * parts))) * bucket
    per_cell = max(width, per_cell)
    placed = entries.select(
        F.expr(f"cast(place div {per_cell} AS int)").alias("cell"), "entry",
        (-F.col("short")).alias("norm"), "place", "v",
    )
    bounds = placed.groupBy("cell").agg(F.max("norm").alias("norm")).orderBy("cell").collect()
    reach = np.array([-r.norm for r in bounds])
    seeds = entries.where(F.col("place") < max(most, SEED_BYTES // (8 * length))).select("v")
    seeds = [matrix(c, length) for c in seeds.toArrow().column("v").chunks]
    given = spark.sparkContext.broadcast((reach, np.concatenate([np.empty((0, length), np.int64), *seeds])))

    asking = rows.where(is_query(F.col("id"))).join(
        entries.select("entry", F.col("v").alias("same")), F.col("v") == F.col("same")
    ).select(F.col("id").alias("query_id"), F.col("entry").alias("query"))
    asking = stage(asking, "queries")
    blocks = max(1, -(-asking.count() // query_block))
    tasks = max(1, min(len(reach) * blocks, max(parts, MOST_TASKS)))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to the cells it may find something in, with its first bound."""
        bound, first = given.value
        for batch in batches:
            q, norms = matrix(batch.column(2), length), batch.column(1).to_numpy()
            floor = _floors(q, first, most)
            least = np.where(floor > 0, floor / np.maximum(norms, 1e-300), 0.0)
            cells = np.searchsorted(bound, -least * (1 - SLACK), side="right")
            for i, n in enumerate(cells.tolist()):
                same = pa.array(np.full(n, i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n, dtype=np.int32)), batch.column(0).take(same),
                     batch.column(1).take(same), pa.array(np.full(n, floor[i])),
                     batch.column(2).take(same)],
                    ["cell", "entry", "norm", "place", "v"],
                )

    own = asking.select(F.col("query").alias("entry")).distinct()
    queries = placed.select("entry", "norm", "v").join(own, "entry").mapInArrow(
        send, "cell int, entry long, norm double, place long, v array<long>"
    ).withColumn("block", F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int"))
    members = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    column = ["cell", "block", "side", "place", "entry", "norm", "v"]
    met = members.withColumn("side", F.lit(0)).select(*column).unionByName(
        queries.withColumn("side", F.lit(1)).select(*column)
    )
    spot = F.pmod(F.col("cell").cast("long") * blocks + F.col("block"), F.lit(tasks)).cast("int")
    met = met.repartitionById(tasks, spot).sortWithinPartitions("cell", "block", "side", "place")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buckets, asked, norms, floor, q in _meetings(batches, length, bucket):
            found = Found.start(floor, most)
            for one in buckets:
                search_bucket(one, q, norms, found, switch)
            sizes = [len(s) for s in found.scores]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(asked, sizes)), pa.array(np.concatenate(found.ids)),
                 pa.array(np.concatenate(found.scores))],
                ["query", "near", "score"],
            )

    hits = met.mapInArrow(search, "query long, near long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "near")
    best = hits.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")
    names = entries.select(F.col("entry").alias("near"), "ids")
    each = best.join(names, "near").select("query", "score", F.explode("ids").alias("vec_id"))
    per_entry = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("r", F.row_number().over(per_entry)).where(F.col("r") <= most).drop("r")
    result = asking.join(each, "query").where("vec_id <> query_id")
    rank = F.row_number().over(
        Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    )
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _meetings(batches: Iterable[pa.RecordBatch], length: int, bucket: int):
    """A cell's buckets with each batch of the queries that reach it; rows are sorted."""
    key, parts, buckets = None, [], []
    for batch in batches:
        cell, block, side = (batch.column(i).to_numpy() for i in range(3))
        turn = np.zeros(batch.num_rows, bool)
        for c in (cell, block, side):
            turn[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(turn).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            if a == b:
                continue
            if (here := (int(cell[a]), int(block[a]))) != key:
                key, parts, buckets = here, [], []
            part = batch.slice(a, b - a)
            row = (part.column(4).to_numpy(), matrix(part.column(6), length),
                   part.column(5).to_numpy())
            if side[a] == 0:
                parts.append(row)
                continue
            if parts:
                whole = [np.concatenate(c) for c in zip(*parts, strict=True)]
                parts = []
                for i in range(0, len(whole[0]), bucket):
                    ids, x, norms = (c[i:i + bucket] for c in whole)
                    buckets.append(Bucket(ids, x, norms))
            yield buckets, row[0], row[2], part.column(3).to_numpy(), row[1]
