"""Neighbours and hard negatives against all pairs, and vectors of every odd kind."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from salescope.llm.four_russians import from_planes, mine_negatives, scores, subset_sums, to_planes
from salescope.llm.kmeans_tree import Tree, calibrated_visits, nearest_neighbours, nearest_rows
from salescope.llm.queries import QUERIES, table

DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, row string, cell string, key string, query string, score string"


def frame(spark, rows):
    """Rows of (vec_id, embedding, label), with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, c, *"xxxxx") for i, v, c in rows], SCHEMA).repartition(3)


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# ---- brute force ---------------------------------------------------------------


def all_neighbours(rows, count=20):
    kept = {(i, tuple(v)) for i, v, _ in rows if i is not None and sound(v) and any(v)}
    found = {}
    for i, q in kept:
        if i % 20 == 0:
            others = sorted((-product(q, v), j) for j, v in kept if (j, v) != (i, q))
            found.setdefault(i, []).append([(j, -s) for s, j in others[:count]])
    return found


def all_negatives(rows):
    kept = set()
    for i, v, label in rows:
        if i is not None and label is not None and sound(v):
            whole = [math.floor(256 * x) for x in v]
            while whole and not whole[-1]:  # shorter vectors end in zeros
                whole.pop()
            kept.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(whole)))
    found = []
    for anchor in kept:
        if anchor[0] % 100:
            continue
        others = sorted(((-product(anchor[2], o[2]), o[0], o) for o in kept if o != anchor))
        for p, i, _ in [o for o in others if o[2][1] == anchor[1]][:5]:
            fit = [(-s, j) for s, j, o in others if o[1] != anchor[1] and 30 * -p <= 100 * -s <= 90 * -p]
            found += [(anchor[0], i, k + 1, j, -p, s) for k, (s, j) in enumerate(fit[:10])]
    return sorted(found)


# ---- op11 -----------------------------------------------------------------------


def test_neighbours_recall(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, DIR, "embeddings").collect()]
    found = {}
    for r in QUERIES["op11_kmeans_tree"](spark, DIR).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    wanted = all_neighbours(rows)
    assert set(found) == set(wanted)
    hits = 0
    for q, (best,) in wanted.items():
        assert sorted(found[q]) == list(range(1, 21))
        hits += len({j for j, _ in best} & {j for j, _ in found[q].values()})
        scores_of = dict(best)
        in_order = [found[q][k] for k in range(1, 21)]
        assert in_order == sorted(in_order, key=lambda x: (-x[1], x[0]))
        assert all(abs(scores_of[j] - s) < 1e-12 for j, s in in_order if j in scores_of)
    assert hits >= 0.9 * 20 * len(wanted)


def clustered(count, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims)) * 3
    return centres[rng.integers(0, 30, count)] + rng.normal(size=(count, dims))


def test_tree_visits_few_leaves_of_clustered_vectors(spark):
    vectors = clustered(6000, 12, 1)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    found = {}
    for r in nearest_neighbours(frame(spark, rows)).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 6000, 20):
        s = vectors @ vectors[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.9 * 20 * 300


def test_calibration_widens_until_the_recall(spark):
    vectors = clustered(4000, 8, 2)
    tree = Tree.fit(vectors, float((vectors**2).sum(axis=1).max()), 64)
    leaf = tree.leaf_of(vectors)
    queries = vectors[:50]
    held = [leaf[np.argsort(-(vectors @ q))[:20]].tolist() for q in queries]
    orders = list(tree.best_bins(queries, tree.leaves))
    assert all(sorted(o) == list(range(tree.leaves)) for o in orders)

    def recall(visits):
        return np.mean([x in o[:visits] for o, have in zip(orders, held) for x in have])

    for wanted in (0.5, 0.9, 1.0):
        visits = calibrated_visits(tree, queries, held, wanted)
        assert recall(visits) >= wanted and (visits == 1 or recall(visits - 1) < wanted)
    assert calibrated_visits(tree, queries, held, 0.9) < tree.leaves


def test_nearest_rows_of_a_block():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, (40, 4)).astype(float)  # many ties
    ids = pa.array([[100 - i, 200 + i] for i in range(40)])
    queries = rng.integers(-2, 3, (9, 4)).astype(float)
    seen = rng.random((9, 40)) < 0.7
    q, v, i, s = nearest_rows(queries, vectors, ids, 11, seen)
    for k in range(9):
        wanted = sorted((-vectors[r] @ queries[k], i_) for r in range(40) if seen[k, r] for i_ in (100 - r, 200 + r))[:11]
        assert list(zip((-s[q == k]).tolist(), i[q == k].tolist())) == [(float(a), b) for a, b in wanted]


ODD = [
    (0, [1.0, 0.0, 0.5], 1), (20, [1.0, 0.0, 0.5], 1), (40, [0.0, 0.0, 0.0], 1), (60, None, 1), (80, [None, 1.0, 1.0], 1),
    (100, [float("nan"), 1.0, 1.0], 1), (120, [float("inf"), 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (0, [1.0, 0.0, 0.5], 1),
    (1, [1.0], 2), (2, [], 2), (3, [0.5, 0.25, 0.125], None), (4, [-1.0, 0.0, -0.5], 3), (200, [0.5, 2.0, 0.0], 1), (200, [2.0, 0.5, 0.0], 1),
    (7, [0.75, 0.5, 0.0], 0), (14, [0.25, 0.5, 0.75], 9), (8, [0.75, 0.5, -0.0], 1),
]


def test_neighbours_of_odd_rows(spark):
    got = {}
    for r in nearest_neighbours(frame(spark, ODD)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    wanted = all_neighbours(ODD)
    assert set(got) == set(wanted)
    for q, lists in wanted.items():
        assert sorted(got[q]) == sorted((k + 1, i, s) for best in lists for k, (i, s) in enumerate(best))


def test_neighbours_among_very_many_copies(spark):
    rng = random.Random(5)
    rows = [(i, [0.6, 0.8, 0.0], 0) for i in range(3000)]
    rows += [(i, [rng.uniform(-1, 1) for _ in range(3)], 0) for i in range(3000, 3200)]
    got = {}
    for r in nearest_neighbours(frame(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert len(got) == 160
    wanted = all_neighbours([r for r in rows if r[0] < 60 or r[0] >= 3000])
    for q in (0, 20, 40, 3000, 3180):
        assert [i for _, i in sorted(got[q])] == [i for i, _ in wanted[q][0]]
    assert [i for _, i in sorted(got[1000])] == [i for _, i in sorted([*got[2000]])]


def test_vectors_of_no_use(spark):
    for rows in ([], [(1, [1.0], 1)], [(20, None, None)], [(20, [0.0], 1)], [(20, [], 1)]):
        assert nearest_neighbours(frame(spark, rows)).collect() == []
    for rows in ([], [(1, [1.0], 1)], [(100, None, 1)], [(100, [1.0], 1)], [(100, [], 1), (200, [], 1)]):
        assert mine_negatives(frame(spark, rows)).collect() == []
    assert nearest_neighbours(frame(spark, [(20, [1.0], 1), (1, [0.5], 1)])).collect() == [(20, 1, 1, 0.5)]


# ---- op12 -----------------------------------------------------------------------


def test_planes_tables_and_scores():
    rng = np.random.default_rng(4)
    numbers = rng.integers(-300, 300, (50, 21))
    planes = to_planes(numbers, 10)
    whole = from_planes(planes)
    assert (whole[:, :21] == numbers).all() and not whole[:, 21:].any()
    for kind in (np.int32, np.int64):
        assert (scores(subset_sums(whole[:7], kind), planes) == numbers @ numbers[:7].T).all()


def test_negatives_match_all_pairs(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, DIR, "embeddings").collect()]
    got = sorted(map(tuple, QUERIES["op12_four_russians"](spark, DIR).collect()))
    assert got == all_negatives(rows)


def test_negatives_of_odd_rows_and_ties(spark, monkeypatch):
    rng = random.Random(6)
    rows = list(ODD)
    rows += [(i, [rng.choice([0.25, 0.5, 1.0, -0.5]) for _ in range(3)], rng.randrange(3)) for i in range(300, 1100)]
    monkeypatch.setattr("salescope.llm.four_russians.CANDIDATE_BLOCK", 128)
    monkeypatch.setattr("salescope.llm.four_russians.ANCHOR_BLOCK", 4)
    got = sorted(map(tuple, mine_negatives(frame(spark, rows)).collect()))
    assert got == all_negatives(rows)


def test_components_too_large_for_a_score(spark):
    with pytest.raises(ValueError, match="50 bits"):
        mine_negatives(frame(spark, [(100, [1e9], 1), (1, [1.0], 1)]))
