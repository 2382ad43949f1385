"""Exact top-k retrieval by cosine similarity."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.session import scratch_path

# tasks receive this module's functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Numbers of the queries that one pass over the vectors answers: what is sent to every executor is 64 MB at most.
PASS_NUMBERS = 8_000_000
# Queries scored together inside a task, and cells of their score matrix held at once (8 bytes each).
BLOCK_QUERIES = 4096
CELLS = 1_000_000
SLICES = 256
RESULT = "query_id long, vec_id long, score double"


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Arrow lists as a matrix of unit rows; every list must hold ``width`` numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if flat.null_count or (np.diff(column.offsets.to_numpy()) != width).any():
        raise ValueError(f"embeddings must hold {width} numbers each, like the queries")
    return _unit_rows(flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width))


class _Best:
    """The k best vectors per query of one block so far; ties go to the smaller id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.ids, self.scores = np.zeros((len(query_ids), 0), np.int64), np.zeros((len(query_ids), 0))

    def add(self, vec_ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, CELLS // len(self.query_ids))
        for i in range(0, len(vec_ids), step):
            scores = np.round(self.queries @ vectors[i:i + step].T, 9)
            ids = np.broadcast_to(vec_ids[i:i + step], scores.shape)
            scores, ids = np.concatenate([self.scores, scores], axis=1), np.concatenate([self.ids, ids], axis=1)
            order = np.lexsort((ids, -scores), axis=1)[:, :self.k]
            self.scores, self.ids = np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.query_ids, self.ids.shape[1])), pa.array(self.ids.ravel()), pa.array(self.scores.ravel()),
        ], names=["query_id", "vec_id", "score"])


def _keep_best(candidates: DataFrame, k: int) -> DataFrame:
    """Two rounds: within slices of the tasks, then over the slices' winners.

    Tasks hand over k rows per query each, so one round alone would bring rows of all tasks to one place per query.
    """
    order = [F.col("score").desc(), F.col("vec_id")]
    sliced = candidates.withColumn("slice", F.spark_partition_id() % SLICES)
    for keys in (["query_id", "slice"], ["query_id"]):
        window = Window.partitionBy(*keys).orderBy(*order)
        sliced = sliced.withColumn("position", F.row_number().over(window)).where(F.col("position") <= k)
    return sliced.drop("slice")


def _one_pass(vectors: DataFrame, query_ids: np.ndarray, matrix: np.ndarray, k: int) -> tuple[DataFrame, Broadcast]:
    """The k best vectors of the given queries, and the broadcast they are read from. Vectors stay where they are."""
    sent = vectors.sparkSession.sparkContext.broadcast((query_ids, matrix))
    width, block = matrix.shape[1], BLOCK_QUERIES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        blocks = [_Best(ids[i:i + block], queries[i:i + block], k) for i in range(0, len(ids), block)]
        for batch in batches:
            if batch.num_rows:
                vec_ids, rows = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"), width)
                for best in blocks:
                    best.add(vec_ids, rows)
        for best in blocks:
            yield best.batch()

    return _keep_best(vectors.mapInArrow(score, RESULT), k), sent


def top_k_similar(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score, position) of the k most similar vectors per query; exact.

    ``vectors`` has (vec_id, embedding), ``queries`` (query_id, embedding); all embeddings hold as many numbers, none
    of them NULL, else the query fails; rows without an embedding take no part. Queries are dealt to passes of at most
    ``PASS_NUMBERS`` numbers. A pass broadcasts its queries and reads the vectors once, where they lie: no vector is copied
    or shuffled, and a task hands over k rows per query. One pass, the usual case, is lazy; of several, each is run and
    stored before the next one's queries are sent, so executors hold one pass's queries whatever their number. Scores are
    rounded to 9 decimals so that the order does not depend on how the product is summed.
    """
    spark = vectors.sparkSession
    vectors = vectors.where(F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long"), "embedding")
    queries = queries.where(F.col("embedding").isNotNull()).select(F.col("query_id").cast("long"), "embedding")
    at = scratch_path(spark, "queries")
    queries.write.parquet(at)
    queries = spark.read.schema(queries.schema).parquet(at)
    size = queries.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("query_id").alias("ids"), F.count("query_id").alias("named"),
        F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("width"),
    ).first()
    if size["ids"] != size["n"] or size["named"] != size["n"]:
        raise ValueError("query ids must be unique")
    if not size["n"]:
        return spark.createDataFrame([], f"{RESULT}, position int")
    width = max(1, size["width"])
    most = max(1, PASS_NUMBERS // width)

    def answer(some: DataFrame) -> tuple[DataFrame, Broadcast]:
        table = some.toArrow()
        return _one_pass(vectors, table["query_id"].to_numpy(), _matrix(table["embedding"], width), k)

    if size["n"] <= most:
        return answer(queries)[0]
    passes = -(-size["n"] // most)
    while True:
        dealt = F.pmod(F.xxhash64("query_id"), F.lit(passes).cast("long"))
        if queries.groupBy(dealt.alias("pass")).count().agg(F.max("count")).first()[0] <= most:
            break
        passes *= 2
    results = []
    for number in range(passes):
        best, sent = answer(queries.where(dealt == number))
        results.append(scratch_path(spark, "nearest"))
        best.write.parquet(results[-1])
        sent.destroy()
    return spark.read.schema(f"{RESULT}, position int").parquet(*results)
