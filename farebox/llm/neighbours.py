"""Approximate nearest neighbours by cosine with a forest of random-projection trees.

Trees are fitted on a bounded sample: every inner node projects onto a random direction and splits at the sample's
median. Every vector is then indexed: it goes to one leaf of each tree. A query walks all trees with one priority
queue, ordered by how far on the wrong side of a split a branch lies, until it has visited its share of the leaves.
Leaf candidates are scored exactly, and the best of all leaves are kept.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.tasks import stored

# Vectors the trees are fitted on, those with the smallest hash, and the numbers they may have together; they pass through
# the driver. The trees themselves hold as many numbers at most, and are broadcast.
MOST_FITTED = 50_000
MOST_NUMBERS = 1 << 24
TREES = 8
# Vectors a leaf is meant to hold; leaves of a tree at most, and the sample vectors that each must have.
LEAF = 1000
MOST_LEAVES = 1024
LEAST_FITTED_PER_LEAF = 16
# Share of all leaves that a query visits. It suits vectors without any structure, where the nearest are hardly nearer
# than the rest; clustered vectors reach the same recall with far less.
PROBE = 0.18
# Vectors or queries of a leaf in one comparison.
UNIT_ROWS = 8192
_SPARE = 4


class Tree:
    """One tree: node i splits by ``direction[i]`` at ``limit[i]`` into ``left[i]`` and ``right[i]``; negative numbers are leaves."""

    def __init__(self, sample: np.ndarray, rng: np.random.Generator, leaves: float):
        self.directions, self.limits, self.children = [], [], []
        self.leaves = 0
        depth = math.ceil(math.log2(leaves)) if leaves > 1 else 0
        self.root = self._grow(sample, rng, depth)
        self.directions = np.array(self.directions).reshape(len(self.limits), sample.shape[1])

    def _grow(self, rows: np.ndarray, rng: np.random.Generator, depth: int) -> int:
        if depth == 0:
            self.leaves += 1
            return -self.leaves
        direction = rng.standard_normal(rows.shape[1])
        direction /= np.linalg.norm(direction)
        side = rows @ direction
        limit = float(np.median(side)) if len(side) else 0.0
        here = len(self.limits)
        self.directions.append(direction)
        self.limits.append(limit)
        self.children.append((0, 0))
        self.children[here] = (self._grow(rows[side < limit], rng, depth - 1), self._grow(rows[side >= limit], rng, depth - 1))
        return here

    @classmethod
    def of(cls, fields: dict) -> Tree:
        """A tree from its fields: broadcasts carry plain values, because executors may lack this class."""
        tree = cls.__new__(cls)
        vars(tree).update(fields)
        return tree

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """Leaf number (from 0) of each row."""
        out = np.zeros(len(rows), np.int64)
        waiting = [(self.root, np.arange(len(rows)))]
        while waiting:
            node, own = waiting.pop()
            if node < 0:
                out[own] = -node - 1
            elif len(own):
                low = rows[own] @ self.directions[node] < self.limits[node]
                waiting += [(self.children[node][0], own[low]), (self.children[node][1], own[~low])]
        return out


def fit_forest(sample: np.ndarray, count: int, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> list[Tree]:
    """Trees for ``count`` vectors, fitted on unit vectors of a sample of them."""
    rng = np.random.default_rng(seed)
    # a split is as wide as a vector, and depths are whole numbers, so a tree may have twice the leaves asked for
    broadcast = max(1, MOST_NUMBERS // (2 * trees * max(1, sample.shape[1])))
    leaves = min(count / leaf, MOST_LEAVES, len(sample) / LEAST_FITTED_PER_LEAF, broadcast)
    return [Tree(sample, rng, leaves) for _ in range(trees)]


def visit(forest: list[Tree], margins: list[np.ndarray], visits: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order one shared queue gives them; ``margins`` are the query's signed distances to all splits."""
    queue = [(0.0, t, tree.root) for t, tree in enumerate(forest)]
    heapq.heapify(queue)
    found = []
    while queue and len(found) < visits:
        worst, t, node = heapq.heappop(queue)
        tree, margin = forest[t], margins[t]
        while node >= 0:
            m = margin[node]
            near, far = tree.children[node] if m < 0 else tree.children[node][::-1]
            heapq.heappush(queue, (max(worst, abs(m)), t, far))
            node = near
        found.append((t, -node - 1))
    return found


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows that take part: vectors that are not NULL or all zero and hold only finite numbers, as doubles."""
    as_double = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), as_double.alias("vec")).where("vec is not null and size(vec) > 0")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where(~bad).where(F.exists("vec", lambda x: x != 0))


def _stack(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of one matrix, each scaled by a power of two to a largest number between 1/2 and 1; shorter ones are
    filled up with zeros.

    Such scaling is exact and changes no cosine, but squares can neither overflow nor vanish: what gets too small to be kept
    is too small to count beside the largest number.
    """
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        out = flat.reshape(-1, width)
    else:
        out = np.zeros((len(sizes), width))
        out[np.arange(width) < sizes[:, None]] = flat
    if not out.size:
        return out
    _, power = np.frexp(np.abs(out).max(axis=1))
    return np.ldexp(out, -power[:, None])


def nearest(
    vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", trees: int = TREES,
    leaf: int = LEAF, probe: float = PROBE, most_fitted: int = MOST_FITTED,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` largest cosines found per query, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``; candidates are all rows but the query's own. NULL vectors, zero
    vectors, vectors with NULL or non-finite numbers, and rows of id NULL take no part. Vectors of unequal length are
    compared as if the shorter ended in zeros. Of an id that repeats with different vectors the best pair counts: a
    candidate is listed once per query, with its largest score over the vectors of both. Equal vectors are indexed once, with the k + 1
    smallest ids, which are all that a result can hold. Fewer rows than ``k`` give fewer ranks; an empty table gives none.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, vec_id, vector).where("vec_id is not null").distinct()
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    distinct = stored(few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("key", F.xxhash64("vec")), "vectors")
    stats = distinct.agg(F.max(F.size("vec")), F.count("*")).first()
    width, count = stats
    result = "query_id long, rank int, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], result)
    fitted = max(1, min(most_fitted, MOST_NUMBERS // width))
    sample = distinct.orderBy("key").limit(fitted).select("vec").toArrow()["vec"].combine_chunks()
    matrix = _stack(sample, width)
    forest = fit_forest(matrix / np.linalg.norm(matrix, axis=1)[:, None], count, trees, leaf)
    shared = spark.sparkContext.broadcast([vars(t) for t in forest])  # trees * leaves * width numbers, bounded by the sample
    visits = max(1, math.ceil(probe * sum(t.leaves for t in forest)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = list(map(Tree.of, shared.value))
        for batch in batches:
            rows = _stack(batch.column(0), width)
            rows = rows / np.linalg.norm(rows, axis=1)[:, None]
            leaves = [t.leaf_of(rows) for t in trees]
            for t, leaf_of in enumerate(leaves):
                place = pa.array(leaf_of + (t << 32))
                yield pa.RecordBatch.from_arrays([place, batch.column(0), batch.column(1), batch.column(2)], names=["place", "vec", "ids", "key"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = list(map(Tree.of, shared.value))
        for batch in batches:
            rows = _stack(batch.column(1), width)
            rows = rows / np.linalg.norm(rows, axis=1)[:, None]
            margins = [rows @ t.directions.T - np.array(t.limits) if len(t.limits) else np.zeros((len(rows), 0)) for t in trees]
            for i in range(len(rows)):
                places = np.array([(t << 32) + n for t, n in visit(trees, [m[i] for m in margins], visits)], np.int64)
                own = pa.array(np.full(len(places), i))
                yield pa.RecordBatch.from_arrays([pa.array(places), batch.column(0).take(own), batch.column(1).take(own)], names=["place", "query_id", "vec"])

    indexed = distinct.select("vec", "ids", "key").mapInArrow(index, "place long, vec array<double>, ids array<long>, key long")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    routed = asked.repartition("query_id").mapInArrow(route, "place long, query_id long, vec array<double>")

    # comparison units: leaves with more vectors or queries than a unit holds are cut, and every part meets every part
    sizes = indexed.groupBy("place").agg(F.count("*").alias("n")).select("place", F.ceil(F.col("n") / UNIT_ROWS).cast("int").alias("row_parts"))
    calls = routed.groupBy("place").agg(F.count("*").alias("n")).select("place", F.ceil(F.col("n") / UNIT_ROWS).cast("int").alias("query_parts"))
    units = F.broadcast(sizes.join(calls, "place"))  # a row per leaf: trees * MOST_LEAVES at most
    row_units = indexed.join(units, "place").select(
        "place", F.pmod("key", "row_parts").cast("long").alias("row_part"), F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"), "vec", "ids")
    query_units = routed.join(units, "place").select(
        "place", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("row_parts") - 1).cast("long"))).alias("row_part"),
        F.pmod(F.xxhash64("query_id"), "query_parts").cast("int").alias("query_part"), "query_id", "vec")
    unit = ["place", "row_part", "query_part"]

    def score(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

        def matrix_of(column):
            return _stack(pa.array(column, pa.list_(pa.float64())), width)

        a, b = matrix_of(queries["vec"]), matrix_of(rows["vec"])
        long_a, long_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
        ids = rows["ids"].to_numpy()
        least = np.array([x[0] for x in ids], np.int64)
        out_query, out_vec, out_score = [], [], []
        take = min(len(b), k + 1 + _SPARE)
        for i, query_id in enumerate(queries["query_id"]):
            rough = b @ a[i] / long_b
            # all that may be among the best k + 1 after exact scoring
            edge = np.partition(rough, len(b) - take)[len(b) - take]
            best = np.flatnonzero(rough >= edge - 1e-12 * long_a[i])
            exact = (b[best] * a[i]).sum(axis=1) / (long_a[i] * long_b[best])
            for j in np.lexsort((least[best], -exact))[:take]:
                for vec_id in ids[best[j]]:
                    if vec_id != query_id:
                        out_query.append(query_id)
                        out_vec.append(vec_id)
                        out_score.append(exact[j])
        return pd.DataFrame({"query_id": out_query, "vec_id": out_vec, "score": out_score})

    scored = query_units.groupBy(*unit).cogroup(row_units.groupBy(*unit)).applyInPandas(score, "query_id long, vec_id long, score double")
    single = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = single.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
