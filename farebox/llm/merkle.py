"""Merkle manifest of a dataset: a tree of three-way nodes per group, the groups' roots under one root, and proofs.

A tree is cut into aligned blocks of ``3 ** LEVELS`` nodes. A block is built by one task from its sorted rows; the roots of
blocks are the nodes of the next layer, so a group of any size takes a few layers of bounded blocks and a hot group is
worked on by as many tasks as it has blocks. A changed leaf makes a version: a persistent tree that copies the ancestors of
the leaf inside its block and shares every other node. Above, a block's way to the root is the same for all its leaves; it
reaches the task with the leaves, as one row before them, and each version is continued along it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.tasks import small_batches, stored

ARITY = 3
LEVELS = 7
BLOCK = ARITY ** LEVELS
_ROWS_OUT = 4096


def node_digest(*parts: str) -> str:
    """Lowercase hex SHA-256 of the parts, one after another."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """The same of a row: each value ``-`` if NULL, else its UTF-8 length, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def depth(size: int) -> int:
    """Levels above ``size`` leaves: nodes are put together until one remains."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


class Tree:
    """A block of a tree: ``levels[0]`` are its lowest nodes; every three consecutive ones make one of the next level.

    Trees are persistent: ``changed`` gives a version that has own nodes on the way up from one leaf and shares the
    others with the tree it comes from.
    """

    def __init__(self, leaves: list[str], height: int):
        self.levels = [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([node_digest(*below[i:i + ARITY]) for i in range(0, len(below), ARITY)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def node(self, level: int, i: int) -> str:
        return self.levels[level][i]

    def siblings(self, i: int) -> list[tuple[str, str]]:
        """Per level, what stands left and right of the node above leaf ``i`` among those put together with it."""
        out = []
        for below in self.levels[:-1]:
            first = i - i % ARITY
            out.append(("".join(below[first:i]), "".join(below[i + 1:first + ARITY])))
            i //= ARITY
        return out

    def changed(self, i: int, leaf: str) -> Version:
        return Version(self, i, leaf)


class Version:
    """A tree with one changed leaf: the copied nodes, lowest first, and all others by reference to the original."""

    def __init__(self, tree: Tree, leaf_at: int, leaf: str):
        self.tree, self.copied = tree, [(leaf_at, leaf)]
        for below in tree.levels[:-1]:
            i, digest = self.copied[-1]
            first = i - i % ARITY
            self.copied.append((i // ARITY, node_digest(*below[first:i], digest, *below[i + 1:first + ARITY])))

    @property
    def root(self) -> str:
        return self.copied[-1][1]

    def node(self, level: int, i: int) -> str:
        at, digest = self.copied[level]
        return digest if at == i else self.tree.node(level, i)


def fold(digest: str, way: Sequence[tuple[str, str]]) -> str:
    """The root that a node and the siblings on its way up amount to."""
    for left, right in way:
        digest = node_digest(left, digest, right)
    return digest


def proof_digest(way: Sequence[tuple[str, str]]) -> str:
    return node_digest(*[part for both in way for part in both])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []

    def batch():
        columns = list(zip(*held)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= _ROWS_OUT:
            yield batch()
            held.clear()
    yield batch()


# ---- places of the leaves ----

def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group (first column) with a last column that counts from 0 inside a group of this task."""
    last, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column(0)
        starts = np.r_[0, 1 + np.flatnonzero(pa.compute.not_equal(groups[1:], groups[:-1]).to_numpy(zero_copy_only=False))]
        ends = np.r_[starts[1:], batch.num_rows]
        local = np.arange(batch.num_rows) - np.repeat(starts, ends - starts)
        if groups[0].as_py() == last:
            local[:ends[0]] += count
        last, count = groups[-1].as_py(), int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "local"])


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``position`` (from 0 within the text column ``grp``, in the order of the columns) and ``size`` of the group.

    Rows are dealt to tasks in ranges of group and order, so neither a group nor equal order values fill one task;
    ``rows`` must be stored and hold a column that tells equal ones apart as the last of ``order``.
    """
    small_batches(rows.sparkSession)
    by = [F.asc_nulls_first(c) for c in ["grp", *order]]
    sorted_rows = rows.select("grp", *[c for c in rows.columns if c != "grp"]).repartitionByRange(*by).sortWithinPartitions(*by)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_rows.schema.fields)
    numbered = stored(
        sorted_rows.withColumn("part", F.spark_partition_id()).mapInArrow(_numbered, f"{types}, part int, local long"), "numbered")
    # a row per task and group in it; a group has at most as many as there are tasks
    counts = numbered.groupBy("grp", "part").agg(F.count("*").alias("rows"))
    of_group = Window.partitionBy("grp")
    before = F.sum("rows").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("grp", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(of_group).alias("size"))
    return numbered.join(starts, ["grp", "part"]).withColumn("position", F.col("before") + F.col("local")).drop(
        "part", "local", "before")


# ---- layers of blocks ----

class Layer(NamedTuple):
    """The nodes of one layer: ``grp``, ``position``, ``digest``, ``size`` (nodes of the group in this layer)."""

    nodes: DataFrame


def _in_blocks(nodes: DataFrame) -> DataFrame:
    block = F.floor(F.col("position") / BLOCK).alias("block")
    return nodes.select("grp", block, "position", "digest", "size").repartition("grp", "block").sortWithinPartitions(
        "grp", "block", "position")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[tuple], Tree]]:
    for (group, block), rows in groupby(_rows(batches), key=itemgetter(0, 1)):
        rows = list(rows)
        yield group, block, rows, Tree([r[3] for r in rows], min(LEVELS, depth(rows[0][4])))


def _block_roots(batches):
    schema = pa.schema([("grp", pa.string()), ("position", pa.int64()), ("digest", pa.string()), ("size", pa.int64())])
    return _sent(((g, b, tree.root, -(-rows[0][4] // BLOCK)) for g, b, rows, tree in _blocks(batches)), schema)


_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_WAY = "array<struct<left:string, right:string>>"


def _block_ways(batches):
    schema = pa.schema([("grp", pa.string()), ("position", pa.int64()), ("way", pa.list_(_STEP))])
    return _sent((
        (g, row[2], [{"left": a, "right": b} for a, b in tree.siblings(i)])
        for g, _, rows, tree in _blocks(batches) for i, row in enumerate(rows)), schema)


def layers_of(leaves: DataFrame) -> list[Layer]:
    """The leaves and the layers above them, up to one node per group. The number of layers grows with the logarithm of the
    greatest group to the base 2187; that greatest size is all the driver sees."""
    layers = [Layer(leaves.select("grp", "position", "digest", "size"))]
    size = leaves.agg(F.max("size")).first()[0] or 0
    # a group that is done before the others goes up unchanged
    while size > 1:
        above = _in_blocks(layers[-1].nodes).mapInArrow(_block_roots, "grp string, position long, digest string, size long")
        layers.append(Layer(stored(above, "layer")))
        size = -(-size // BLOCK)
    return layers


def _ways(layers: Sequence[Layer], end: DataFrame) -> DataFrame:
    """``grp``, ``position``, ``way``: the siblings from each node of the first layer up to its group's root, then ``way``
    of ``end`` (``grp``, ``way``), plus the columns that ``end`` has beside them."""
    more = [c for c in end.columns if c not in ("grp", "way")]
    ways = end.select("grp", F.lit(0).cast("long").alias("position"), "way", *more)
    for layer in reversed(layers[:-1]):
        own = _in_blocks(layer.nodes).mapInArrow(_block_ways, f"grp string, position long, way {_WAY}")
        above = ways.select("grp", F.col("position").alias("block"), F.col("way").alias("further"), *more)
        ways = own.withColumn("block", F.floor(F.col("position") / BLOCK)).join(above, ["grp", "block"]).select(
            "grp", "position", F.concat("way", "further").alias("way"), *more)
    return ways


class Manifest(NamedTuple):
    """A dataset's tree: ``leaves`` (``grp``, ``position``, ``size``, ``key``, ``digest``, ``changed``), the ``layers`` above
    them, ``groups`` (``grp``, ``subroot``, ``way`` to the root), and the ``root`` (None without leaves)."""

    leaves: DataFrame
    layers: list[Layer]
    groups: DataFrame
    root: str | None


def build(rows: DataFrame, values: Sequence[Column], key: Column, group: Column, changed: Sequence[Column] | None = None) -> Manifest:
    """The tree over ``rows``. A row's leaf is the digest of ``values``; leaves of a ``group`` ascend by ``key``, groups by
    their UTF-8 bytes, NULL first in both. ``changed`` are values to try the tree against, in place of ``values``.

    Rows that share a key are ordered by their digests, so that the tree does not depend on how rows are stored; equal
    rows are leaves of their own. NULLs and empty or long texts are values like any other. An empty table has no root.
    Only the given columns are looked at, so others may have any name.
    """
    # the table is read once: digests are stored, and everything else is done on them
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    digests = rows.select(
        name.alias("grp"), key.alias("key"), leaf_digest(values).alias("digest"),
        (leaf_digest(changed) if changed else F.lit(None).cast("string")).alias("changed"),
        F.monotonically_increasing_id().alias("apart"))
    # the digest's order in 60 bits: what decides on ranges is sampled to the driver, so it is kept narrow
    ranked = digests.withColumn("nth", F.conv(F.left("digest", F.lit(15)), 16, 10).cast("long"))
    leaves = stored(placed(stored(ranked, "digests"), ["key", "nth", "apart"]).drop("nth", "apart"), "leaves")
    layers = layers_of(leaves)
    tops = layers[-1].nodes.select("grp", F.col("digest").alias("subroot"))
    under_root = stored(placed(stored(tops.select(
        F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("subroot").alias("digest")), "subroots"), ["of"]), "groups")
    above = layers_of(under_root)
    top = above[-1].nodes.first()
    if top is None:
        return Manifest(leaves, layers, tops.withColumn("way", F.array().cast(_WAY)), None)
    nothing = above[-1].nodes.select("grp", F.array().cast(_WAY).alias("way"))
    ways = _ways(above, nothing) if len(above) > 1 else nothing.withColumn("position", F.lit(0).cast("long"))
    groups = under_root.select("position", F.col("of").alias("grp"), F.col("digest").alias("subroot")).join(
        ways.select("position", "way"), "position").select("grp", "subroot", "way")
    return Manifest(leaves, layers, stored(groups, "group_ways"), top["digest"])


def _proofs(batches: Iterator[pa.RecordBatch], key_type: pa.DataType, root: str, whole: bool) -> Iterator[pa.RecordBatch]:
    def prove():
        for _, rows in groupby(_rows(batches), key=itemgetter(0, 1)):
            header, *leaves = rows
            _, _, _, size, _, _, _, subroot, way = header
            above = [(step["left"], step["right"]) for step in way]
            tree = Tree([r[5] for r in leaves], min(LEVELS, depth(leaves[0][3])))
            for i, row in enumerate(leaves):
                key, leaf, changed = row[4], row[5], row[6]
                whole_way = tree.siblings(i) + above
                if changed is None or changed == leaf:
                    folded = fold(tree.root, above)
                else:
                    folded = fold(tree.changed(i, changed).root, above)
                proof = [{"left": a, "right": b} for a, b in whole_way] if whole else proof_digest(whole_way)
                yield key, leaf, subroot, root, proof, folded, folded == root

    schema = pa.schema([
        ("key", key_type), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
        ("proof", pa.list_(_STEP) if whole else pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])
    return _sent(prove(), schema)


def prove(manifest: Manifest, whole: bool = True) -> DataFrame:
    """Per leaf: ``key``, ``leaf``, ``subroot``, ``root``, ``proof`` (left and right siblings per level, lowest first; their
    digest with ``whole=False``), ``folded_root`` (the root of the version with the changed leaf, or with the leaf itself
    where nothing changed) and ``verified``: whether that is the root. No rows without leaves."""
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = manifest.leaves.schema["key"].dataType
    schema = (f"key {key_type.simpleString()}, leaf string, subroot string, root string, "
              f"proof {_WAY if whole else 'string'}, folded_root string, verified boolean")
    if manifest.root is None:
        return manifest.leaves.sparkSession.createDataFrame([], schema)
    # the way of a block of leaves from its root on; a block's row stands before its leaves
    if len(manifest.layers) > 1:
        above = _ways(manifest.layers[1:], manifest.groups)
    else:
        above = manifest.groups.withColumn("position", F.lit(0).cast("long"))
    none = F.lit(None)
    headers = above.select(
        "grp", F.col("position").alias("block"), F.lit(-1).cast("long").alias("position"), F.lit(0).cast("long").alias("size"),
        none.cast(key_type).alias("key"), none.cast("string").alias("digest"), none.cast("string").alias("changed"),
        "subroot", "way")
    leaves = manifest.leaves.select(
        "grp", F.floor(F.col("position") / BLOCK).alias("block"), "position", "size", "key", "digest", "changed",
        none.cast("string").alias("subroot"), none.cast(_WAY).alias("way"))
    small_batches(leaves.sparkSession)
    arrow, root = to_arrow_type(key_type), manifest.root
    return headers.unionByName(leaves).repartition("grp", "block").sortWithinPartitions("grp", "block", "position").mapInArrow(
        lambda batches: _proofs(batches, arrow, root, whole), schema)
