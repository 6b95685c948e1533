from __future__ import annotations

import numpy as np
import pytest
from fareflow.llm import catalogue, vector_graph
from pyspark.sql import functions as F


def plain(rows: list[tuple], queries: list[tuple], k: int) -> dict:
    """Every vector compared, in double precision."""
    valid = [(i, np.array(v, np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, matrix = np.array([i for i, _ in valid]), np.array([v for _, v in valid])
    found = {}
    for q, v in queries:
        scores = (matrix * np.array(v, np.float64)).sum(1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        found[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def recall(rows, expected) -> float:
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(expected)
    hits = total = 0
    for q, near in expected.items():
        ours = sorted(found[q])
        assert [x[0] for x in ours] == list(range(1, len(near) + 1))
        assert [x[2] for x in ours] == sorted((x[2] for x in ours), reverse=True)
        assert q not in [x[1] for x in ours]
        hits += len({x[1] for x in ours} & {i for i, _ in near})
        total += len(near)
    return hits / total


def test_query_finds_nearly_all(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = plain(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = catalogue.QUERIES["op8_vector_graph"](spark, folder).collect()
    assert recall(found, expected) >= 0.95
    scores = {(q, i): s for q, near in expected.items() for i, s in near}
    assert all(abs(scores[r.query_id, r.vec_id] - r.score) < 1e-12 for r in found if (r.query_id, r.vec_id) in scores)


def test_lengths_differ_and_many_points(spark):
    rng = np.random.default_rng(2)
    matrix = (rng.normal(size=(3000, 16)) * rng.uniform(0.2, 3, size=(3000, 1))).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x"))
    index = vector_graph.build_index(vectors, k=10, shard_points=700)
    assert index.select("band", "shard").distinct().count() > 4
    found = vector_graph.search(index, vectors.filter("vec_id % 50 = 0"), k=10).collect()
    assert recall(found, plain(rows, rows[::50], 10)) >= 0.9


@pytest.mark.parametrize("unit", [1.0, 1e-30])
def test_a_full_shard_of_all_directions(spark, unit):
    # Directions without any structure are the hard case; two vectors are far longer than all others.
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(vector_graph.SHARD_POINTS, 64))
    matrix *= unit / np.sqrt((matrix**2).sum(1))[:, None]
    matrix *= rng.uniform(1.0, 1.02, size=(len(matrix), 1))
    matrix[7] *= 1e4
    matrix[8] *= 1e20
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vector_graph.build_index(vectors, k=20)
    if unit == 1.0:
        assert index.groupBy("band", "shard").count().agg(F.max("count")).first()[0] == vector_graph.SHARD_POINTS - 2
    found = vector_graph.search(index, vectors.filter("vec_id % 80 = 0"), k=20).collect()
    assert recall(found, plain(rows, rows[::80], 20)) >= 0.9


def test_lengths_up_to_twice_as_long(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(4000, 64))
    matrix *= rng.uniform(1, 2, size=(len(matrix), 1)) / np.sqrt((matrix**2).sum(1))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_graph.search(vector_graph.build_index(vectors, k=20), vectors.filter("vec_id % 40 = 0"), k=20).collect()
    assert recall(found, plain(rows, rows[::40], 20)) >= 0.95


def test_lengths_at_the_ends_of_what_numbers_hold(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (v * 10.0**e).tolist()) for i, (v, e) in enumerate(zip(rng.normal(size=(90, 4)), [-300, 0, 150] * 30, strict=True))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_graph.search(vector_graph.build_index(vectors, k=5), vectors, k=5).collect()
    assert recall(found, plain(rows, rows, 5)) >= 0.98


def test_copies_ties_and_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(100, 160)] + [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None])]
    rows += [(5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (8, [2.0, 0.0, 1.0]), (None, [1.0, 1.0]), (100, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = vector_graph.build_index(vectors, k=5)
    near = {}
    for r in vector_graph.search(index, vectors.filter("vec_id in (1, 110, 2, 3, 8)"), k=5).collect():
        near.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(near) == [1, 110]
    assert [i for _, i in sorted(near[110])] == [100, 101, 102, 103, 104]
    assert [i for _, i in sorted(near[1])][:5] == [100, 101, 102, 103, 104]
    none = vectors.limit(0)
    assert vector_graph.search(vector_graph.build_index(none, k=5), none, k=5).count() == 0
