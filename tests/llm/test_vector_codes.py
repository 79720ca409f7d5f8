import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitecensus.llm import vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """The contract, in Python integers."""
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-len(kept[0][1]) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, p: min((square(x, y), e) for e, y in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            of = {}
            for c in cut:
                of.setdefault(nearest(c[p], p)[1], []).append(c[p])
            for e, group in of.items():
                new[p][e] = tuple(sum(x) // len(group) for x in zip(*group, strict=True))
        books = new
    last = [[nearest(c[p], p) for p in range(parts)] for c in cut]
    totals = {}
    for (_, _, label), best in zip(kept, last, strict=True):
        totals[label] = totals.get(label, 0) + sum(d for d, _ in best)
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), totals[label], digest) for (i, _, label), best in zip(kept, last, strict=True)), key=str)


def found(frame, **options):
    return sorted((tuple(r) for r in vector_codes.compress(frame, **options).collect()), key=str)


def vectors(n, length, seed, spread=0.3, kinds=None):
    random = np.random.default_rng(seed)
    points = random.normal(0, spread, (kinds or n, length)).astype(np.float32)
    return [(int(i), points[random.integers(len(points)) if kinds else i].tolist(), int(random.integers(4)) if i % 7 else None) for i in random.permutation(n)]


@pytest.mark.parametrize(("n", "length", "kinds"), [(300, 64, None), (40, 32, None), (250, 16, 30), (90, 50, 70)])
def test_matches_brute_force(spark, n, length, kinds):
    """Also with fewer vectors than entries, many equal vectors (ties), and a length that 16 does not divide."""
    rows = vectors(n, length, n, kinds=kinds)
    assert found(spark.createDataFrame(rows, VECTORS).repartition(5)) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = vectors(80, 16, 5, kinds=12)
    bad = [(-1, None, 1), (-2, [None] * 16, 1), (-3, [float("nan")] * 16, 1), (-4, [1.0] * 15 + [float("inf")], 1), (-5, [1.0] * 15 + [float("-inf")], None)]
    rows += [rows[3], rows[3], (None, [0.25] * 16, 2), (None, [0.25] * 16, None), (7, [0.5] * 16, 1), (7, [-0.5] * 16, 1)]
    frame = spark.createDataFrame(rows + bad, VECTORS).selectExpr("*", "1 AS code", "2 AS error", "3 AS points", "4 AS place")
    assert found(frame) == brute(rows)


def test_other_sizes_and_lengths(spark):
    rows = vectors(70, 12, 9)
    frame = spark.createDataFrame(rows, VECTORS)
    for options in ({"parts": 3, "entries": 7, "rounds": 3, "scale": 100}, {"parts": 1, "entries": 5, "rounds": 0}, {"parts": 4, "entries": 200, "rounds": 1}):
        assert found(frame, **options) == brute(rows, **options)
    other = [(min(r[0] for r in rows) + 1_000, [1.0] * 9, 1), (0.5 and 5_000, [], 1)]
    assert found(spark.createDataFrame(rows + other, VECTORS), parts=3) == brute(rows, parts=3)


def test_empty_tables_and_large_components(spark):
    assert found(spark.createDataFrame([], VECTORS)) == []
    assert found(spark.createDataFrame([(1, None, 1)], VECTORS)) == []
    rows = [(i, [float(i) * 1000, -float(i) * 500_000], 1) for i in range(3)]
    assert found(spark.createDataFrame(rows[:2], VECTORS), parts=2) == brute(rows[:2], parts=2)
    with pytest.raises(Exception, match="squared distances would not fit"):
        found(spark.createDataFrame(rows, VECTORS), parts=2)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 1_000_000), st.integers(1, 3), st.integers(1, 12), st.integers(1, 4), st.integers(1, 30))
def test_the_ball_holds_every_nearest_entry(seed, parts, entries, width, spread):
    """From any start, also with equal entries and entries at equal distances."""
    random = np.random.default_rng(seed)
    books = random.integers(-spread, spread + 1, (parts, entries, width))
    points = random.integers(-spread, spread + 1, (50, parts, width))
    codes, distances, computed = vector_codes.Codebooks(books).nearest(points, random.integers(0, entries, (50, parts)))
    every = ((points[:, :, None] - books[None]) ** 2).sum(axis=3)
    assert (codes == every.argmin(axis=2)).all() and (distances == every.min(axis=2)).all()
    assert computed <= 50 * parts * entries


def test_the_ball_leaves_out_far_entries():
    random = np.random.default_rng(1)
    centres = random.integers(-1000, 1000, (1, 64, 4))
    near = centres[0, random.integers(0, 64, 500)][:, None] + random.integers(-20, 21, (500, 1, 4))
    books = vector_codes.Codebooks(centres)
    codes, _, _ = books.nearest(near, np.zeros((500, 1), np.int64))
    assert books.nearest(near, codes)[2] < 500 * 4  # 64 without the ball
