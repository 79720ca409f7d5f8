import numpy as np
import pytest
from pyspark.sql import functions as F

from sitecensus.llm import topk_search


def brute(rows, every, k):
    good = {i: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, a in good.items():
        if q % every == 0:
            scores = sorted((-int(a[: len(b)] @ b[: len(a)]), i) for i, b in good.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_matches_brute_force(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    points = centres[rng.integers(0, 12, 3000)] + spread * rng.normal(size=(3000, 8))
    points[100:180] = points[100]  # ties
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(5000, None), (5001, [1.0, None] + [0.0] * 6), (5002, [float("nan")] * 8), (5003, [float("inf")] * 8), (5004, []), (5005, [2.0, 1.0]), (5006, [-1e-30] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS v", "2 AS score").repartition(4)
    got = topk_search.top_k(frame, F.col("vec_id") % 50 == 0, k=7, tree_rows=700, seed_rows=100, query_block=1000)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 50, 7)
    blocks = topk_search.top_k(frame, F.col("vec_id") % 50 == 0, k=7, query_block=20)
    assert sorted(tuple(r) for r in blocks.collect()) == brute(rows, 50, 7)


def test_pruning_skips_pairs_of_clustered_data():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 300
    points = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 8)))
    queries = points[::100]
    search = topk_search.Search(topk_search.CoverTree(queries, 8), np.arange(0, 8000, 100), 5, np.full(80, -np.inf))
    search.run(topk_search.CoverTree(points, 64), np.arange(8000))
    assert search.pairs < 0.5 * 80 * 8000


@pytest.mark.parametrize("spread", [0.5, 30.0])
def test_covering_and_separation_of_every_node(spread):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 6)) * 200
    points = np.floor(centres[rng.integers(0, 30, 4000)] + spread * rng.normal(size=(4000, 6)))
    tree = topk_search.CoverTree(points, 32)
    inside, held = 0, []
    for node, children in enumerate(tree.children):
        held.append(tree.rows[node])
        if children:
            inside += 1
            own = points[[tree.centre[c] for c in children]]
            apart = np.sqrt(((own[:, None] - own[None]) ** 2).sum(axis=2)) + np.eye(len(own)) * 1e9
            assert all(tree.radius[c] <= tree.radius[node] / 2 for c in children) and apart.min() > tree.radius[node] / 2
            assert 1 < len(children) <= topk_search.MOST_CHILDREN
        else:
            d = np.sqrt(((points[tree.rows[node]] - points[tree.centre[node]]) ** 2).sum(axis=1))
            assert d.max() == tree.radius[node]
    assert inside > 10 and sorted(np.concatenate(held)) == list(range(4000))


def test_repeated_ids_and_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])] + [(i, [0.0, 0.0]) for i in range(3, 60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(tuple(r) for r in topk_search.top_k(frame, F.col("vec_id") == 0, k=3).collect())
    one, m = 1024 * 1024, "candidates of the query's own id take no part"
    assert got == sorted([(0, 1, 2, 2 * one), (0, 2, 1, one), (0, 3, 1, one)] * 2 + [(0, 1, 1, one), (0, 2, 1, one), (0, 3, 2, 0)]), m


def test_few_or_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (None, [3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk_search.top_k(few, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
