"""Top-k retrieval against brute force, over one and many blocks of queries."""

import numpy as np
import pytest

from farebox.operators import similarity


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    vectors, queries = rng.normal(size=(300, 8)), rng.normal(size=(12, 8))
    vectors[10] = vectors[20]  # equal scores: the smaller id comes first
    as_df = lambda m, name: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} long, embedding array<double>")
    return vectors, queries, as_df(vectors, "vec_id").repartition(5), as_df(queries, "query_id")


def _brute_force(vectors, queries, k):
    scores = np.round((queries / np.linalg.norm(queries, axis=1)[:, None]) @ (vectors / np.linalg.norm(vectors, axis=1)[:, None]).T, 9)
    return {(q, int(v), p + 1) for q, row in enumerate(scores) for p, v in enumerate(sorted(range(len(row)), key=lambda i: (-row[i], i))[:k])}


@pytest.mark.parametrize(("pass_numbers", "block"), [(similarity.PASS_NUMBERS, similarity.BLOCK_QUERIES), (similarity.PASS_NUMBERS, 5), (24, 2)])
def test_equals_brute_force(data, monkeypatch, pass_numbers, block):
    monkeypatch.setattr(similarity, "PASS_NUMBERS", pass_numbers)  # 24: at most three queries a pass
    monkeypatch.setattr(similarity, "BLOCK_QUERIES", block)
    monkeypatch.setattr(similarity, "CELLS", 50)
    vectors, queries, vector_df, query_df = data
    got = similarity.top_k_similar(vector_df, query_df, 5)
    assert {(r.query_id, r.vec_id, r.position) for r in got.collect()} == _brute_force(vectors, queries, 5)


def test_vectors_are_neither_copied_nor_shuffled(spark, data, plan_of):
    vectors = spark.range(0, 50, 1, 5).selectExpr("id as vec_id", "transform(sequence(1, 8), i -> sin(id * i)) as embedding")
    plan = plan_of(similarity.top_k_similar(vectors, data[3], 5))
    tree = plan[:plan.index("(1)")]
    assert "Join" not in tree and "Generate" not in tree
    assert "Exchange" not in tree[tree.index("MapInArrow"):]


def test_query_ids_must_be_unique(data):
    *_, vector_df, query_df = data
    for wrong in (query_df.union(query_df), query_df.selectExpr("nullif(query_id, 3) as query_id", "embedding")):
        with pytest.raises(ValueError, match="unique"):
            similarity.top_k_similar(vector_df, wrong, 3)


def test_lengths_must_agree(spark):
    query = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0])], "query_id long, embedding array<double>")
    for wrong in ([1.0] * 3, [1.0, None, 0.0, 0.0]):
        vectors = spark.createDataFrame([(1, wrong), (2, [1.0] * 5)], "vec_id long, embedding array<double>").coalesce(1)
        with pytest.raises(Exception, match="must hold 4 numbers"):
            similarity.top_k_similar(vectors, query, 3).collect()


def test_no_queries_and_zero_vector(data, spark):
    *_, vector_df, query_df = data
    assert similarity.top_k_similar(vector_df, query_df.limit(0), 3).count() == 0
    zero = spark.createDataFrame([(1, [0.0, 0.0])], "vec_id long, embedding array<double>")
    query = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert similarity.top_k_similar(zero, query, 3).first().score == 0.0
