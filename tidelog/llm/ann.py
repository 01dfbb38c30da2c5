"""Approximate nearest neighbours: a forest of random-projection trees, one queue, exact distances.

Trees are grown on a bounded sample: a node splits its vectors at the median of their projections onto
the line between two random centres. Every vector then gets its leaf in every tree. A query walks all
trees through one priority queue, nearest margins first, until it has visited ``leaves`` leaves; the
vectors of these leaves are ranked by their exact distances in double precision. How many leaves that
takes depends on the data: some vectors of the sample ask the sample, whose true neighbours are known, and
the fewest leaves that find the share ``RECALL`` of them are visited. Clustered vectors need few; random
ones need most of the table, as nothing is near anything.

Vectors that are equal are one entry with its smallest ids, as many as a query may return, so a vector
that very many rows share is compared once. Leaves and queries meet by a shuffle on (tree, leaf); a leaf
with many vectors is dealt over blocks of bounded size, and only each block's best leave a task.

Defined results: null, zero or empty vectors, those with null, NaN or infinite components, those of
another length than the commonest one (the shorter on ties), and rows without an id take no part; equal
distances go to the smaller id; rows that repeat an id and vector are one; if there are fewer candidates
than asked for, all are returned; without vectors the result is empty; only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.batches import lowest, ship_package
from tidelog.session import stage

# Bounds of the index: vectors that trees are grown on, and their bytes; trees; depth; vectors a leaf
# of the sample holds at least; vectors in a block of a leaf.
SAMPLE, SAMPLE_BYTES = 1 << 16, 64 << 20
TREES, DEPTH, LEAF, BLOCK = 16, 9, 32, 2048
# Share of the sample's true neighbours that a query's leaves must hold, and the vectors that ask.
RECALL, ASKING = 0.965, 128


@dataclass
class Forest:
    """Balanced trees as arrays: node i has the children 2i + 1 and 2i + 2."""

    depth: int
    normals: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def grow(x: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 0) -> Forest:
        depth = max(0, min(depth, int(np.log2(max(1, len(x) / LEAF)))))
        nodes = (1 << depth) - 1
        normals = np.zeros((trees, nodes, x.shape[1]), np.float32)
        cuts = np.zeros((trees, nodes), np.float32)
        for t in range(trees):
            rng = np.random.default_rng([seed, t])
            own = {0: np.arange(len(x))}
            for node in range(nodes):
                rows = own.pop(node)
                normal = _direction(x, rows, rng)
                along = x[rows] @ normal
                cut = np.median(along) if len(rows) else 0.0
                normals[t, node], cuts[t, node] = normal, cut
                own[2 * node + 1], own[2 * node + 2] = rows[along <= cut], rows[along > cut]
        return Forest(depth, normals, cuts)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Each vector's leaf in each tree."""
        out = np.zeros((len(x), len(self.cuts)), np.int32)
        for t in range(len(self.cuts)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                margin = np.einsum("ij,ij->i", x, self.normals[t, at]) - self.cuts[t, at]
                at = 2 * at + 1 + (margin > 0)
            out[:, t] = at - len(self.cuts[t])
        return out

    def visits(self, query: np.ndarray, leaves: int) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs that a query visits, by one queue over all trees."""
        inner = self.cuts.shape[1]
        if not inner:
            return [(t, 0) for t in range(len(self.cuts))]
        margins = (self.normals @ query - self.cuts).tolist()
        queue = [(-np.inf, t, 0) for t in range(len(self.cuts))]
        heapq.heapify(queue)
        out = []
        while queue and len(out) < leaves:
            far, t, node = heapq.heappop(queue)
            # Down the near side without leaving the queue's order; the far side waits its turn.
            while node < inner:
                margin = margins[t][node]
                near, other = (2, 1) if margin > 0 else (1, 2)
                heapq.heappush(queue, (max(far, abs(margin)), t, 2 * node + other))
                node = 2 * node + near
            out.append((t, node - inner))
        return out


def leaves_for(forest: Forest, x: np.ndarray, k: int, goal: float = RECALL, asking: int = ASKING) -> int:
    """The fewest leaves whose vectors hold ``goal`` of the ``k`` nearest of some rows of ``x``."""
    at, trees = forest.leaves(x), len(forest.cuts)
    whole, inside = trees << forest.depth, min(k, len(x) - 1)
    if inside < 1 or not forest.depth:
        return whole
    firsts = []
    for i in np.linspace(0, len(x) - 1, min(asking, len(x))).astype(int):
        gap = ((x - x[i]) ** 2).sum(axis=1)
        gap[i] = np.inf
        near = np.argpartition(gap, inside - 1)[:inside]
        order = np.full((trees, 1 << forest.depth), whole)
        for n, (t, leaf) in enumerate(forest.visits(x[i], whole)):
            order[t, leaf] = n
        # The visit that finds a neighbour is that of the first of its leaves.
        firsts.append(order[np.arange(trees), at[near]].min(axis=1))
    found = np.sort(np.concatenate(firsts))
    return int(found[min(len(found) - 1, int(np.ceil(goal * len(found))) - 1)]) + 1


def _direction(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The line between two centres that a few rounds of two-means find; random if there are none."""
    if len(rows) >= 2:
        a, b = x[rng.choice(rows, 2, replace=False)]
        for _ in range(4):
            some = x[rng.choice(rows, min(len(rows), 400), replace=False)]
            near = ((some - a) ** 2).sum(axis=1) < ((some - b) ** 2).sum(axis=1)
            if near.all() or not near.any():
                break
            a, b = some[near].mean(axis=0), some[~near].mean(axis=0)
        line = a - b
        if (size := np.linalg.norm(line)) > 0:
            return line / size
    line = rng.normal(size=x.shape[1])
    return (line / np.linalg.norm(line)).astype(np.float32)


def usable(vector: Column) -> Column:
    """Vectors with only finite components, not all of them zero."""
    bad = F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda c: c != 0)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    trees: int = TREES,
    leaves: int | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest other rows that were found.

    Queries are the rows whose id satisfies ``is_query``; ``score`` is the Euclidean distance.
    ``leaves`` sets how many a query visits.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(vectors[id_col].cast("long").alias("id"),
                          vectors[vec_col].cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    out = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], out)
    length = sizes.n
    rows = stage(rows.where(F.size("v") == length).distinct(), "vectors")
    # Equal vectors become one entry; it keeps its smallest ids, one more than can be returned.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = stage(
        rows.withColumn("r", place).where(F.col("r") <= k + 1).groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.get("ids", F.lit(0)).alias("entry"), "ids", "v"),
        "entries",
    )
    bound = max(1, min(sample, SAMPLE_BYTES // (8 * length)))
    drawn = entries.select("entry", "v", F.xxhash64("entry").alias("draw"))
    some = lowest(drawn, "draw", ["entry"], bound).select("v").toArrow()
    grown = np.concatenate(
        [_matrix(chunk, length) for chunk in some.column("v").chunks]
    ).astype(np.float32)
    forest = Forest.grow(grown, trees)
    leaves = leaves_for(forest, grown, k) if leaves is None else leaves
    shared = spark.sparkContext.broadcast(forest)

    def place_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), length)
            at = forest.leaves(x.astype(np.float32))
            n, t = at.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(t, dtype=np.int32), n)), pa.array(at.ravel()),
                 pa.array(np.repeat(batch.column(0).to_numpy(), t)),
                 batch.column(1).take(pa.array(np.repeat(np.arange(n), t)))],
                ["tree", "leaf", "entry", "v"],
            )

    def visit_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), length)
            for i, query in enumerate(x.astype(np.float32)):
                t, leaf = zip(*forest.visits(query, leaves), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t, pa.int32()), pa.array(leaf, pa.int32()),
                     pa.array(np.full(len(t), batch.column(0)[i].as_py())),
                     batch.column(1).take(pa.array(np.full(len(t), i)))],
                    ["tree", "leaf", "entry", "v"],
                )

    located = "tree int, leaf int, entry long, v array<double>"
    members = entries.select("entry", "v").mapInArrow(place_all, located)
    asking = rows.where(is_query(F.col("id")))
    asking = stage(
        asking.join(entries.select("entry", "v"), "v").select(F.col("id").alias("query"), "entry"),
        "queries",
    )
    queries = entries.select("entry", "v").join(asking.select("entry").distinct(), "entry")
    # A fixed number of (tree, leaf) pairs, so the table of their blocks is small.
    blocks = members.groupBy("tree", "leaf").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    )
    blocks = F.broadcast(stage(blocks, "leaf-blocks"))
    members = members.join(blocks, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("entry"), "blocks").cast("int").alias("block"),
        F.lit(0).alias("side"), "entry", "v",
    )
    visits = queries.mapInArrow(visit_all, located).join(blocks, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("side"), "entry", "v",
    )
    meeting = ["tree", "leaf", "block"]
    met = members.unionByName(visits).repartition(*meeting).sortWithinPartitions(*meeting, "side")

    def rank_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, asked, q in _meetings(batches, length):
            for a in range(0, len(asked), 256):
                yield _best(ids, x, asked[a:a + 256], q[a:a + 256], k + 1)

    found = met.mapInArrow(rank_all, "query long, near long, score double")
    found = found.groupBy("query", "near").agg(F.first("score").alias("score"))
    order = Window.partitionBy("query").orderBy("score", "near")
    best = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    names = entries.select(F.col("entry").alias("near"), "ids")
    each = best.join(names, "near").select("query", "score", F.explode("ids").alias("vec_id"))
    # What a query's entry found holds for all ids that share its vector, except for themselves.
    per_entry = Window.partitionBy("query").orderBy("score", "vec_id")
    each = each.withColumn("r", F.row_number().over(per_entry)).where(F.col("r") <= k + 1)
    own = asking.withColumnRenamed("query", "query_id").withColumnRenamed("entry", "query")
    result = own.join(each.drop("r"), "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _best(ids: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, k: int):
    """The ``k`` nearest members for each query, by distance and then id."""
    distance = np.empty((len(q), len(x)))
    for i, one in enumerate(q):
        gap = x - one
        distance[i] = np.sqrt((gap * gap).sum(axis=1))
    if len(x) > k:
        edge = np.partition(distance, k - 1, axis=1)[:, k - 1:k]
        row, col = np.nonzero(distance <= edge)
    else:
        row, col = np.nonzero(np.ones_like(distance, bool))
    return pa.RecordBatch.from_arrays(
        [pa.array(asked[row]), pa.array(ids[col]), pa.array(distance[row, col])],
        ["query", "near", "score"],
    )


def _meetings(batches: Iterable[pa.RecordBatch], length: int):
    """Members of a block, with each batch of the queries that visit it; rows are sorted."""
    key, ids, vectors = None, [], []
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(4)]
        turn = np.zeros(batch.num_rows, bool)
        for c in columns:
            turn[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(turn).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            if a == b:
                continue
            here = tuple(int(c[a]) for c in columns[:3])
            if here != key:
                key, ids, vectors = here, [], []
            part = batch.slice(a, b - a)
            own, x = part.column(4).to_numpy(), _matrix(part.column(5), length)
            if columns[3][a] == 0:
                ids.append(own)
                vectors.append(x)
            elif ids:
                yield np.concatenate(ids), np.concatenate(vectors), own, x
