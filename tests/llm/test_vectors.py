"""Whitening and clustering of vectors against brute force, and odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from riskloom.llm import centroids, vectors, whitening
from riskloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, Cluster string, vector string, n string"


def table(make, rows):
    return make(SCHEMA, [(i, v, 0, "x", "c", None, "n") for i, v in rows])


def ints(rows, size, scale):
    return [(i, [math.floor(scale * float(c)) for c in v]) for i, v in rows if v is not None and len(v) == size
            and all(c is not None and math.isfinite(c) for c in v)]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(64)]) for i in range(150)]
    nan, inf = float("nan"), float("inf")
    return rows + [(500, None), (501, []), (502, [0.5] * 63), (503, [nan] + [0.1] * 63), (504, [inf] + [0.1] * 63),
                   (505, [None] + [0.1] * 63), (None, rows[0][1]), rows[1], rows[1], (506, rows[2][1]), (507, [0.0] * 64),
                   (508, [0.0] * 64), *[(600 + i, rows[3][1]) for i in range(60)]]


# whitening -----------------------------------------------------------------------------------------

def check_whitening(got, rows, size=64, components=32):
    x = np.array([v for _, v in rows], np.int64).reshape(len(rows), size) + 1000000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    assert len(got) == n * components and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    want = {}
    for (i, v), row in zip(rows, centred @ axes / np.sqrt(values)):
        exact = sum((n * (a + 1000000) - int(s)) ** 2 for a, s in zip(v, sums))
        want.setdefault(i, (exact, row))
    by_component = {}
    for r in got:
        exact, row = want[r.vec_id]
        assert r.deviation == exact
        assert abs(r.explained - values[r.component - 1] / (centred ** 2).sum() * n) < 1e-9
        by_component.setdefault(r.component, []).append((r.whitened, row[r.component - 1]))
    for pairs in by_component.values():
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-6


def test_whitening_query_against_eigh(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check_whitening(QUERIES["op11_whitening"](spark, SMALL).collect(), ints([(r.vec_id, r.embedding) for r in rows], 64, 64))


def test_whitening_of_odd_rows(make, odd):
    many = table(make, odd).repartition(40)  # more partitions than one task folds
    check_whitening(whitening.whiten(many).collect(), ints(odd, 64, 64))


def test_whitening_without_spread(make, odd):
    assert whitening.whiten(table(make, [])).collect() == []
    assert whitening.whiten(table(make, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(table(make, [(i, [0.25] * 64) for i in range(9)])).collect() == []
    flat = whitening.whiten(table(make, [(i, [float(i % 3), float(i), 1.0]) for i in range(9)] + [(99, [1.0])])).collect()
    assert {r.component for r in flat} == {1, 2} and {r.n for r in flat} == {9}  # the third entry never changes


def test_deviation_beyond_a_long():
    x = np.array([[1 << 30, -5], [3, 7]], np.int64)
    apart = whitening.centred(x, 1 << 40, np.array([17, 4], np.int64))
    want = [sum(((1 << 40) * int(v) - s) ** 2 for v, s in zip(row, (17, 4))) for row in x]
    assert [int(v) for v in whitening.deviations(whitening.centred(x, 1 << 20, np.array([17, 4], np.int64))).to_pylist()] == [
        sum(((1 << 20) * int(v) - s) ** 2 for v, s in zip(row, (17, 4))) for row in x]
    assert [int((row ** 2).sum()) for row in apart] == want


@pytest.mark.parametrize("size, kind", [(1, "plain"), (2, "plain"), (12, "plain"), (12, "copies"), (12, "flat"), (12, "grid")])
def test_rank_one_updates_against_eigh(size, kind):
    rng = np.random.default_rng(size)
    x = rng.integers(-30, 30, (300, size))
    if kind == "copies":
        x[50:200] = x[0]
    if kind == "flat":
        x[:, 1:4], x[:, 5] = 7, x[:, 6]
    if kind == "grid":
        x = np.repeat(np.eye(size, dtype=np.int64) * 9, 20, axis=0)
    none = 0, np.zeros(size, np.int64), np.zeros(size), np.eye(size)
    states = [none, none]
    for i, row in enumerate(x):
        states[i % 3 == 0] = whitening.take_in(states[i % 3 == 0], row)
    n, sums, values, basis = whitening.combine(*states)
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    assert n == len(x) and (sums == x.sum(axis=0)).all()
    assert np.abs(basis.T @ basis - np.eye(size)).max() < 1e-11
    assert np.abs(basis * values @ basis.T - scatter).max() < 1e-10 * max(1, np.abs(scatter).max())


def test_fold_by_levels(make):
    parts = make("slot long, entries array<double>", [(i, [float(i)]) for i in range(100)])
    got = vectors.fold(parts, lambda rows: {"entries": [sum(r["entries"][0] for r in rows)]}, "sum").collect()
    assert len(got) == 1 and got[0].entries == [4950.0]


# clusters ------------------------------------------------------------------------------------------

def check_clusters(got, rows, k=40, rounds=5):
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [list(v) for _, v in sorted(rows, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in rows]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centres)):
            own = [v for (_, v), (_, m) in zip(rows, found) if m == n]
            if own:
                centres[n] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    want = sorted((i or -1, n, d, sum(e for e, m in found if m == n), sum(e for e, _ in found), shas[n])
                  for (i, _), (d, n) in zip(rows, found))
    assert sorted((r[0] or -1, *r[1:]) for r in got) == want


def test_clusters_of_odd_rows(make, odd):
    got = centroids.cluster(table(make, odd).repartition(7))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    check_clusters(got.collect(), ints(odd, 64, 256))


def test_few_and_no_vectors(make, odd):
    check_clusters(centroids.cluster(table(make, odd[:3])).collect(), ints(odd[:3], 64, 256))
    assert centroids.cluster(table(make, [])).collect() == []
    assert centroids.cluster(table(make, [(1, None), (None, [1.0])])).collect() == []
    assert centroids.cluster(table(make, [(1, [3e38] + [0.0] * 63)])).collect() == []  # no long holds its square


@pytest.mark.parametrize("size, spread, k", [(2, 3, 60), (3, 50, 40), (64, 60, 40), (1, 5, 17), (4, 1, 9)])
def test_tree_search_against_all_distances(size, spread, k):
    rng = np.random.default_rng(size)
    centres, points = rng.integers(-spread, spread, (k, size)), rng.integers(-2 * spread, 2 * spread, (500, size))
    nodes = centroids.build_tree(centres)
    assert sorted(m for node in nodes for m in node.members) == list(range(k))
    label, best = centroids.nearest(nodes, centres, points)
    away = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (best == away.min(axis=1)).all() and (label == away.argmin(axis=1)).all()  # argmin: the first of equals
