import random
import re

import numpy as np
import pytest

from sitecensus.llm import jaccard_join

from sample_rows import ROWS


def shingle_set(text, k=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            if one and two and 100 * len(one & two) >= 80 * len(one | two):
                label[root(a)] = root(b)
    out = []
    for a, (i, s) in enumerate(sets):
        ids = [sets[b][0] for b in range(len(sets)) if root(b) == root(a) and sets[b][0] is not None]
        out.append((i, len(s), min(ids, default=None)))
    return sorted(out, key=str)


def found(frame, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join_components(frame, **options).collect()), key=str)


def near_copies(seed, n=260):
    """Families of near copies around the border of 0.8, texts with a shared passage, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    families = [[rng.choice(words) for _ in range(rng.choice([6, 30, 120, 700]))] for _ in range(12)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.6:
            text = list(rng.choice(families))
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(text) // 45])):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind < 0.85:
            text = [rng.choice(words) for _ in range(rng.choice([3, 10, 20, 80]))] + passage
        else:
            text = [rng.choice(words[:3]) for _ in range(rng.randrange(8))]
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"part_rows": 4}, {"max_bitmap_mb": 0}])
def test_matches_brute_force(spark, options):
    rows = near_copies(len(options))
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), **options) == brute(rows)


def test_edge_cases(docs, no_docs):
    assert found(docs) == brute([r[:2] for r in ROWS])
    assert jaccard_join.join_components(no_docs).count() == 0
    assert jaccard_join.drop_near_copies(no_docs).count() == 0
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    # 1, 2 and 3 are alike and 1 stays, one of the two without an id stays, texts without words all stay
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 4, 5, 6, 7, 8, None]


def test_dropping_leaves_one_of_each_component(spark):
    rows = near_copies(9)
    frame = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, row_key string")
    expected = {c if n else i for i, n, c in brute(rows)}
    assert {r.doc_id for r in jaccard_join.drop_near_copies(frame).collect()} == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    labels = {r.node: r.label for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


def test_tree_finds_all_partners_that_the_bound_allows():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 6, (30, jaccard_join.GROUPS))
    vectors = np.maximum(0, base[rng.integers(0, 30, 900)] + rng.integers(-1, 2, (900, jaccard_join.GROUPS)) * (rng.random((900, 1)) < 0.5)).astype("<u2")
    sizes, labels = vectors.sum(axis=1, dtype=np.int64), rng.integers(0, 400, 900)
    tree = jaccard_join.CountTree(vectors, sizes, labels)
    for q in range(0, 900, 37):
        minima = np.minimum(vectors, vectors[q]).sum(axis=1, dtype=np.int64)
        wanted = np.flatnonzero((minima * 180 >= (sizes + sizes[q]) * 80) & (labels != labels[q]))
        assert sorted(tree.partners(vectors[q], int(sizes[q]), int(labels[q]), 80)) == wanted.tolist()
