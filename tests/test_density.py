"""Density clustering by cells against all pairs: labels, counts, forced splits, odd rows."""

import itertools
import math
import random

import pytest

from aerolytics.operators import clusters, density


def cloud(d, seed):
    """A dense blob, a line of points, sparse points, repeats and a pair at exactly eps."""
    r = random.Random(seed)
    pts = [[r.gauss(0, 0.3) for _ in range(d)] for _ in range(120)]
    pts += [[5 + 0.4 * i] + [0.0] * (d - 1) for i in range(25)]
    pts += [[r.uniform(-6, 6) for _ in range(d)] for _ in range(60)]
    pts += [pts[0], pts[0], [20.0] + [0.0] * (d - 1), [20.5] + [0.0] * (d - 1)]
    return [(i * 7 % 1009, p) for i, p in enumerate(pts)]


def brute(points, eps, min_points):
    """Counts and labels from all pairs."""
    def d2(a, b):
        t = 0.0
        for x, y in zip(a, b):
            t += (x - y) * (x - y)
        return t
    near = {i: [j for j, q in points if d2(p, q) <= eps * eps] for i, p in points}
    core = {i for i, n in near.items() if len(n) >= min_points}
    label = {}
    for i in sorted(core):
        if i in label:
            continue
        label[i], todo = i, [i]
        while todo:
            for j in near[todo.pop()]:
                if j in core and j not in label:
                    label[j] = i
                    todo.append(j)
    out = {i: label.get(i, min((label[j] for j in near[i] if j in core), default=-1)) for i, _ in points}
    return {i: len(n) for i, n in near.items()}, out


def frame(spark, points, d):
    cols = [f"c{i}" for i in range(d)]
    return spark.createDataFrame([(i, *p) for i, p in points], ["id", *cols]), cols


@pytest.mark.parametrize("d,min_points", [(1, 4), (2, 2), (3, 6), (6, 4)])
def test_labels_and_counts_equal_all_pairs(spark, d, min_points):
    points = cloud(d, d)
    df, cols = frame(spark, points, d)
    counts, labels = brute(points, 0.5, min_points)
    assert dict(clusters.dbscan(df, cols, "id", 0.5, min_points).collect()) == labels
    got = clusters.dbscan_neighbours(df, cols, "id", 0.5, min_points).collect()
    assert {r["id"]: r["n_neighbours"] for r in got} == counts
    assert all(r["is_core"] == (counts[r["id"]] >= min_points) for r in got)


def test_boxes_are_split_until_few_pairs_are_left(spark, monkeypatch):
    points = cloud(2, 9)
    df, cols = frame(spark, points, 2)
    counts, labels = brute(points, 0.5, 5)
    monkeypatch.setattr(density, "SALT_ROWS", 7)
    for budget in (100,):
        got = density.neighbour_counts(df, cols, "id", 0.5, budget=budget)
        assert dict(got.collect()) == counts
        got = dict(density.density_labels(df, cols, "id", 0.5, 5, budget=budget).collect())
        assert got == {i: v for i, v in labels.items() if v >= 0}


def test_a_dense_cell_costs_no_pairs(spark):
    """A third of all points in one cell: the shuffled rows grow with the points."""
    def written(n):
        df = spark.range(n).selectExpr("id", "id % 3 * 10 + (id % 97) / 1e4 AS x", "(id % 89) / 1e4 AS y")
        cells = density.Cells(df, ["x", "y"], "id", 0.5)
        return cells.near.count(), cells.counts().count(), cells.boxes.count()
    assert written(30_000) == (0, 0, 3) or written(30_000)[2] <= 12
    out = clusters.dbscan(spark.range(30_000).selectExpr("id", "id % 3 * 10 + (id % 97) / 1e4 AS x", "(id % 89) / 1e4 AS y"),
                          ["x", "y"], "id", 0.5, 5)
    assert sorted(tuple(r) for r in out.groupBy("cluster_dbscan").count().collect()) == [(0, 10_000), (1, 10_000), (2, 10_000)]


def test_rows_without_coordinates_are_noise(spark):
    rows = [(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (4, math.nan, 0.0), (5, math.inf, 0.0), (None, 0.05, 0.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = {r["id"]: r["cluster_dbscan"] for r in clusters.dbscan(df, ["x", "y"], "id", 0.5, 3).collect()}
    assert got == {1: 1, 2: 1, 3: -1, 4: -1, 5: -1, None: 1}
    counts = {r["id"]: r["n_neighbours"] for r in clusters.dbscan_neighbours(df, ["x", "y"], "id", 0.5, 3).collect()}
    assert counts == {1: 3, 2: 3, None: 3}
    assert clusters.dbscan(df.limit(0), ["x", "y"], "id", 0.5, 3).count() == 0


def test_cell_diagonals_stay_within_eps():
    for d, eps in itertools.product((1, 2, 3, 5, 12, 40), (0.8, 1e-3, 1e6)):
        side = eps / math.sqrt(d) * (1 - density.MARGIN)
        assert sum(side * side for _ in range(d)) <= eps * eps


def test_stored_rows_grow_with_the_points(spark, monkeypatch):
    """Sparse points in four dimensions have hundreds of cells around each: no pair of cells or
    of a point and a cell is written, and the labels agree with all pairs in many chunks."""
    r = random.Random(4)
    points = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(600)]
    df, cols = frame(spark, points, 4)
    counts, labels = brute(points, 0.8, 4)
    written, plain = [], density.stored

    def counted(table, label):
        out = plain(table, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(density, "stored", counted)
    got = clusters.dbscan(df, cols, "id", 0.8, 4)
    assert dict(got.collect()) == labels
    assert dict(density.neighbour_counts(df, cols, "id", 0.8, budget=100).collect()) == counts
    assert max(written) <= 2 * len(points)


def test_a_core_cell_without_a_key_joins_nothing(spark):
    rows = [(1, 0.0), (2, 0.1), (None, 0.6), (None, 0.6), (4, 1.1), (5, 1.15)]
    df = spark.createDataFrame(rows, "id long, x double")
    got = sorted(map(tuple, clusters.dbscan(df, ["x"], "id", 0.5, 2).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (None, -1), (None, -1), (4, 4), (5, 4)], key=str)
