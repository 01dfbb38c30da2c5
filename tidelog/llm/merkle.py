"""A Merkle manifest of a table as an append log in postorder, with proofs for every row.

Every group (a source) has a tree over its rows in order of id; runs of three neighbours become their
digest until one node is left. The groups' roots, in order of group, are the leaves of a last tree. A tree
is stored as a log: a node is written when it completes, directly after its last child. Where a node
stands then follows from its subtree's size alone (:func:`position`), so siblings are addressed, not
searched.

Builders are aligned: a block is 729 neighbours, a subtree of six levels, and one row of the log table
holds its nodes in the order in which they completed. The blocks' top nodes are the next tier's leaves;
every tier has 1/729 of the rows of the one below, so a few tiers hold any table, and a group with any
share of the rows is many blocks. Rows are numbered by ranges in two passes
(:mod:`tidelog.operators.numbering`). Whole texts are hashed where they are read: only digests move.

Defined results: nulls hash as ``-``, apart from empty text; a null group is a group and comes first;
null ids come first in their group; rows that tie in group and id go by their leaf, and rows equal in all
of that have the same leaf and each a place of its own; an empty table has no root and no rows. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.batches import ship_package
from tidelog.operators.lookup import lookup_join
from tidelog.operators.numbering import number_in_order
from tidelog.session import stage

ARITY, LEVELS = 3, 6
BLOCK = ARITY ** LEVELS
DIGEST = 32


def digest(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def position(leaf: int, level: int) -> int:
    """Where the node on ``level`` whose last leaf is ``leaf`` stands in the log, from 0.

    Before it come the complete subtrees of all earlier leaves, whose sizes are (3^(m+1) - 1) / 2 for
    each digit of ``leaf`` to base 3, and on its own branch ``level`` nodes below it.
    """
    digits, rest = 0, leaf
    while rest:
        digits, rest = digits + rest % ARITY, rest // ARITY
    return leaf + (leaf - digits) // (ARITY - 1) + level


def height(leaves: int) -> int:
    """Levels above the leaves of a tree of its own."""
    levels, reach = 0, 1
    while reach < leaves:
        levels, reach = levels + 1, reach * ARITY
    return levels


def append_log(leaves: list[bytes], levels: int) -> bytes:
    """All nodes of an aligned subtree in the order in which they complete, ``levels`` above leaves.

    The last node of each level may have fewer than three children; it completes after the last leaf.
    """
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def complete(level: int) -> None:
        node = digest("".join(c.hex() for c in waiting[level]))
        waiting[level] = []
        log.append(node)
        waiting[level + 1].append(node)

    for leaf in leaves:
        log.append(leaf)
        waiting[0].append(leaf)
        level = 0
        while level < levels and len(waiting[level]) == ARITY:
            complete(level)
            level += 1
    for level in range(levels):
        if waiting[level]:
            complete(level)
    return b"".join(log)


@lru_cache(maxsize=64)
def siblings(leaves: int, levels: int) -> list[list[tuple[list[int], list[int]]]]:
    """Per leaf and level, where the nodes stand that come before and after its own in a run."""
    out = []
    for leaf in range(leaves):
        path = []
        for level in range(levels):
            span = ARITY ** level
            own, count = leaf // span, -(-leaves // span)
            run = range(own - own % ARITY, min(count, own - own % ARITY + ARITY))
            at = {n: position(min((n + 1) * span, leaves) - 1, level) for n in run}
            path.append(([at[n] for n in run if n < own], [at[n] for n in run if n > own]))
        out.append(path)
    return out


def _levels(size: int) -> int:
    """A block of a larger tree is a whole subtree; a tree of one block stops at its root."""
    return LEVELS if size > BLOCK else height(size)


def _nodes(log: bytes) -> list[str]:
    text = log.hex()
    return [text[i:i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)]


# A path is text: a level is what comes before a node and what comes after it, ``<before>,<after>``, and
# levels end in ``;``.
def _paths(log: bytes, leaves: int, size: int, above: str) -> Iterator[str]:
    """The path of every leaf of a block to the root, with that of the block itself."""
    nodes = _nodes(log)
    for levels in siblings(leaves, _levels(size)):
        steps = ["".join(nodes[i] for i in a) + "," + "".join(nodes[i] for i in b) + ";"
                 for a, b in levels]
        yield "".join(steps) + above


def fold(leaf: str, path: str) -> str:
    """The root that a leaf leads to along a path."""
    for step in path.split(";")[:-1]:
        before, after = step.split(",")
        leaf = digest(before + leaf + after).hex()
    return leaf


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as its length in bytes, ``:`` and its text, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


@dataclass(frozen=True)
class Forest:
    """The logs of many trees. ``tiers[t]`` has a row per block: ``tree, block, size, log`` and the
    ``keys`` and ``claims`` of its leaves; ``size`` is how many nodes the tree has on that tier."""

    tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """``tree, tier, size, root``; a tree's last block holds its root last."""
        tops = [
            t.where(F.col("size") <= BLOCK).select(
                "tree", F.lit(i).alias("tier"), "size", _last("log").alias("root"))
            for i, t in enumerate(self.tiers)
        ]
        return reduce(DataFrame.unionByName, tops)


def _last(log: str) -> Column:
    return F.substring(F.col(log), F.octet_length(log) - (DIGEST - 1), F.lit(DIGEST))


def _grow(nodes: DataFrame) -> DataFrame:
    """A tier's blocks from its nodes ``tree, idx, size, digest, key, claim``."""
    met = nodes.groupBy("tree", F.expr(f"idx div {BLOCK}").alias("block"), "size").agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest", "key", "claim"))).alias("m")
    )
    blocks = met.select(
        "tree", "block", "size", F.col("m.key").alias("keys"), F.col("m.claim").alias("claims"),
        F.col("m.digest").alias("leaves"),
    )
    schema = blocks.drop("leaves").schema.add("log", "binary")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, leaves = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            logs = [append_log(x, _levels(n)) for x, n in zip(leaves, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)] + [pa.array(logs, pa.binary())],
                schema.fieldNames(),
            )

    return stage(blocks.mapInArrow(write, schema), "merkle-tier")


def grow_forest(nodes: DataFrame) -> Forest:
    """Trees over nodes ``tree, idx, size, digest, key, claim``: ``idx`` numbers a tree's leaves."""
    tiers = [_grow(nodes)]
    while (tiers[-1].agg(F.max("size")).first()[0] or 0) > BLOCK:
        below = tiers[-1].where(F.col("size") > BLOCK)
        tiers.append(_grow(below.select(
            "tree", F.col("block").alias("idx"),
            F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"), _last("log").alias("digest"),
            F.lit(None).cast("string").alias("key"), F.lit(None).cast("binary").alias("claim"),
        )))
    return Forest(tiers)


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path from their top node to the root."""
    paths = stage(paths.select(F.col("tree").alias("_t"), F.col("block").alias("_b"), "path"), "paths")
    on = blocks["tree"].eqNullSafe(paths["_t"]) & (blocks["block"] == paths["_b"])
    return lookup_join(blocks, paths, on, "inner").drop("_t", "_b")


def descend(forest: Forest, tops: DataFrame) -> DataFrame:
    """The lowest tier's blocks with the path of each; ``tops`` has ``tree, tier, path`` of the roots."""
    down = None
    for i in reversed(range(len(forest.tiers))):
        paths = tops.where(F.col("tier") == i).select(
            "tree", F.lit(0).cast("long").alias("block"), "path"
        )
        if down is not None:
            paths = paths.unionByName(down)
        blocks = _with_paths(forest.tiers[i], paths)
        if i:
            down = _children(blocks)
    return blocks


def _children(blocks: DataFrame) -> DataFrame:
    """``tree, block, path`` of the blocks one tier below."""
    rows = blocks.select("tree", "block", "size", F.size("keys").alias("n"), "log", "path")
    schema = rows.select("tree", "block", "path").schema

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, block, size, n, log, path = (c.to_pylist() for c in batch.columns)
            for i in range(batch.num_rows):
                found = list(_paths(log[i], n[i], size[i], path[i]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([i] * n[i])),
                     pa.array([block[i] * BLOCK + j for j in range(n[i])], pa.int64()),
                     pa.array(found)],
                    ["tree", "block", "path"],
                )

    return rows.mapInArrow(each, schema)


@dataclass(frozen=True)
class Manifest:
    """The logs of all groups (``groups``) and of the tree over their roots (``top``)."""

    groups: Forest
    top: Forest
    subroots: DataFrame
    root: str | None


def build(
    rows: DataFrame,
    fields: list[str],
    group_col: str = "source",
    id_col: str = "doc_id",
    claim: Column | None = None,
) -> Manifest:
    """The manifest of a table whose rows are made of ``fields``.

    ``claim`` is the leaf that a row presents later on, null for its own; :func:`prove` folds it along
    the row's proof. It travels with the row, so rows need no unique key.
    """
    ship_package(rows.sparkSession)
    leaves = rows.select(
        rows[group_col].cast("string").alias("tree"), rows[id_col].alias("key"),
        leaf_digest([rows[f] for f in fields]).alias("digest"),
        (F.lit(None).cast("binary") if claim is None else claim).alias("claim"),
    ).withColumn("claim", F.when(F.col("claim") != F.col("digest"), F.col("claim")))
    groups = grow_forest(
        number_in_order(leaves, ["tree"], ["key", "digest"], "idx", "size", "leaves")
    )
    subroots = stage(groups.roots(), "subroots")
    named = subroots.select(
        F.lit(None).cast("string").alias("tree"), F.col("tree").alias("key"),
        F.col("root").alias("digest"), F.lit(None).cast("binary").alias("claim"),
    )
    top = grow_forest(number_in_order(named, ["tree"], ["key"], "idx", "size", "roots"))
    last = top.roots().first()
    return Manifest(groups, top, subroots, None if last is None else last.root.hex())


_PROOF = "leaf string, log_position long, proof string, folded_root string"


def prove(manifest: Manifest, rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every row's proof, and the root its claim (else its own leaf) leads to.

    ``key, group, leaf, log_position`` (in its group's log), ``proof`` (the siblings from the leaf up to
    the root, left to right), ``subroot, root, folded_root``.
    """
    spark = rows.sparkSession
    if manifest.root is None:
        kind = rows.select(rows[id_col].alias("key")).schema["key"]
        schema = spark.createDataFrame(
            [], f"k int, group string, {_PROOF}, subroot string, root string").schema
        return spark.createDataFrame([], type(schema)([kind, *schema.fields[1:]]))
    whole = manifest.top.roots().select("tree", "tier", F.lit("").alias("path"))
    over = descend(manifest.top, whole)
    to_root = stage(_keyed(over), "group-paths")
    found = manifest.subroots.withColumnRenamed("tree", "_s")
    same = to_root["tree"].eqNullSafe(found["_s"])
    tops = stage(lookup_join(to_root, found, same, "inner").drop("_s"), "root-paths")
    blocks = descend(manifest.groups, tops.select("tree", "tier", "path"))
    names = stage(tops.select(F.col("tree").alias("_s"), F.hex("root").alias("subroot")), "names")
    each = _proofs(blocks)
    joined = lookup_join(each, names, each["group"].eqNullSafe(names["_s"]), "inner")
    return joined.drop("_s").withColumn("subroot", F.lower("subroot")).withColumn(
        "root", F.lit(manifest.root)
    )


def _keyed(blocks: DataFrame) -> DataFrame:
    """``tree, path`` of every leaf that has a key: the groups in the top tree."""
    rows = blocks.select("size", "keys", "log", "path")

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, keys, log, path = (c.to_pylist() for c in batch.columns)
            for i in range(batch.num_rows):
                found = list(_paths(log[i], len(keys[i]), size[i], path[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i], pa.string()), pa.array(found)], ["tree", "path"]
                )

    return rows.mapInArrow(each, "tree string, path string")


def _proofs(blocks: DataFrame) -> DataFrame:
    rows = blocks.select("tree", "block", "size", "keys", "claims", "log", "path")
    made = blocks.sparkSession.createDataFrame([], _PROOF).schema
    key = rows.select(F.get("keys", F.lit(0)).alias("key"), F.col("tree").alias("group")).schema
    schema = type(made)([*key.fields, *made.fields])

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3)
            starts = keys.offsets.to_pylist()
            block, size, claims, log, path = (batch.column(i).to_pylist() for i in (1, 2, 4, 5, 6))
            for i in range(batch.num_rows):
                n, nodes = len(claims[i]), _nodes(log[i])
                leaf = [nodes[position(j, 0)] for j in range(n)]
                steps = list(_paths(log[i], n, size[i], path[i]))
                claim = [own if c is None else c.hex() for own, c in zip(leaf, claims[i], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys.values.slice(starts[i], n), batch.column(0).take(pa.array([i] * n)),
                     pa.array(leaf),
                     pa.array([position(block[i] * BLOCK + j, 0) for j in range(n)], pa.int64()),
                     pa.array([s.replace(",", "").replace(";", "") for s in steps]),
                     pa.array([fold(c, s) for c, s in zip(claim, steps, strict=True)])],
                    schema.fieldNames(),
                )

    return rows.mapInArrow(each, schema)
