import math
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from webgrain.functions import money as M
from webgrain.functions import vectors as V
from webgrain.operators import numeric as N
from webgrain.sources.readers import scan_pixels


def vectors(spark, matrix, labels=None):
    rows = [(i, [float(x) for x in row], int(labels[i]) if labels is not None else 0)
            for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, vec array<double>, label int")


def lloyd(x, k, steps):
    c = x[:k].copy()
    for _ in range(steps):
        nearest = np.linalg.norm(x[:, None] - c, axis=2).argmin(1)
        new = np.array([x[nearest == i].mean(0) if (nearest == i).any() else c[i] for i in range(k)])
        if np.allclose(c, new):
            return new
        c = new
    return c


@pytest.mark.parametrize("steps", [1, 3, 100])
def test_kmeans(spark, steps):
    x = np.random.default_rng(1).normal(size=(120, 3))
    got = N.kmeans(vectors(spark, x).repartition(5), "vec", 4, "id", max_iter=steps)
    centroids = np.array([r["centroid"] for r in got.orderBy("cluster").collect()])
    assert np.allclose(centroids, lloyd(x, 4, steps))


def test_kmeans_keeps_the_centroid_of_an_empty_cluster(spark):
    x = np.array([[0.0], [0.0], [5.0], [6.0]])
    # both start at 0: the first takes all rows, the second none
    got = N.kmeans(vectors(spark, x), "vec", 2, "id", max_iter=1).orderBy("cluster").collect()
    assert [r["centroid"] for r in got] == [[2.75], [0.0]]


def brute_knn(train, labels, test, k):
    out = []
    for t in test:
        order = sorted(range(len(train)), key=lambda i: (((train[i] - t) ** 2).sum(), i))[:k]
        out.append(int(np.bincount(labels[order]).argmax()))
    return out


@pytest.mark.parametrize("options", [{}, {"cell_rows": 10, "block_rows": 7, "visit_rows": 3, "cells": 40}, {"cell_rows": 1}])
def test_knn_on_both_ways(spark, options):
    rng = np.random.default_rng(2)
    train, test = rng.integers(0, 4, (150, 3)).astype(float), rng.integers(0, 4, (40, 3)).astype(float)
    labels = rng.integers(0, 3, 150)  # whole numbers: many equal distances and votes
    got = N.knn_classify(vectors(spark, train, labels).repartition(4), vectors(spark, test).drop("label"),
                         5, **options)
    assert {r["id"]: r["label"] for r in got.collect()} == dict(
        enumerate(brute_knn(train, labels, test, 5)))


def test_knn_without_rows(spark):
    x = vectors(spark, [[1.0]])
    assert N.knn_classify(x, x.filter("id < 0"), 3).count() == 0
    assert N.knn_classify(x.filter("id < 0"), x, 3).count() == 0


def test_knn_compares_few_pairs_of_clustered_rows(spark):
    """Twenty clusters, and one more that holds a third of all rows, half of them equal."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(21, 8)) * 30
    of = np.r_[rng.integers(0, 20, 1000), np.full(500, 20)]
    x = centers[of] + rng.normal(size=(1500, 8))
    x[-250:] = x[-1]
    y = x[::10] + 0.01
    train, test = vectors(spark, x, of).repartition(6), vectors(spark, y).drop("label")
    pairs = []
    got = N.nearest_neighbours(train, test, 4, cell_rows=30, block_rows=40, visit_rows=16, measure=pairs).collect()
    rows = {}
    for r in sorted(got, key=lambda r: (r.test_id, r.dist, r.train_id)):
        rows.setdefault(r.test_id, []).append(r.train_id)
    for i, t in enumerate(y):
        d = ((x - t) ** 2).sum(1)
        assert rows[i] == np.lexsort((np.arange(1500), d))[:4].tolist()
    assert sum(pairs) < 0.15 * len(x) * len(y)


def test_knn_sends_rows_to_few_groups_where_nothing_can_be_pruned(spark, monkeypatch):
    x = np.random.default_rng(9).normal(size=(400, 32))  # no clusters: every block is looked into
    sent, pairs, kept = [], [], N.materialize

    def counted(df, label="stage"):
        out = kept(df, label)
        sent.append(out.count() if label == "visits" else 0)
        return out

    monkeypatch.setattr(N, "materialize", counted)
    rows = vectors(spark, x, np.arange(400) % 3).repartition(4)
    got = N.nearest_neighbours(rows, rows.drop("label"), 3, cell_rows=20, block_rows=8, measure=pairs).collect()
    assert sum(pairs) > 0.9 * 400 * 400 and sum(sent) <= 2 * (N.GROUPS + 2) * 400
    want = [(i, j) for i in range(400) for j in np.argsort(((x - x[i]) ** 2).sum(1), kind="stable")[:3]]
    assert sorted((r.test_id, r.train_id) for r in got) == sorted(want)


def test_knn_blocks_of_one_cell_are_bounded(spark):
    x = np.r_[np.zeros((300, 2)), np.random.default_rng(5).normal(size=(30, 2))]
    blocks, rings = N._ring_index(
        vectors(spark, x, np.zeros(330, int)).selectExpr("cast(id as long) id", "cast(label as long) label", "vec"), 330, 8, 40, 25, 1000)
    sizes = {r["block"]: r["count"] for r in blocks.groupBy("block").count().collect()}
    assert max(sizes.values()) <= 25 and sizes == dict(zip(rings.block.tolist(), rings.size.tolist()))
    assert sum(sizes.values()) == 330


KERNEL = [[1, 2, 0], [0, -1, 3], [2, 0, 1]]


def correlate(g, kernel):
    k = len(kernel)
    h, w = g.shape[0] - k + 1, g.shape[1] - k + 1
    return np.array([[(g[y:y + k, x:x + k] * kernel).sum() for x in range(w)] for y in range(h)])


def pool(g, k, s):
    return np.array([[g[y:y + k, x:x + k].max() for x in range(0, g.shape[1] - k + 1, s)]
                     for y in range(0, g.shape[0] - k + 1, s)])


def test_grid_functions_in_rows_and_as_pixels(spark):
    g = np.random.default_rng(3).integers(0, 10, (12, 9)).astype(float)
    grid = spark.createDataFrame([(g.tolist(),)], "g array<array<double>>")
    pixels = spark.createDataFrame(
        [(1, y, x, float(g[y, x])) for y in range(12) for x in range(9)], "id int, y int, x int, v double")

    def as_array(df):
        cells = {(r["y"], r["x"]): r["v"] for r in df.collect()}
        h, w = max(y for y, _ in cells) + 1, max(x for _, x in cells) + 1
        return np.array([[cells[y, x] for x in range(w)] for y in range(h)])

    want = correlate(g, np.array(KERNEL))
    assert np.allclose(grid.select(V.convolve(F.col("g"), KERNEL)).first()[0], want)
    assert np.allclose(as_array(N.grid_convolve(pixels, KERNEL)), want)
    for k, s in ((3, 1), (3, 2), (2, 3), (1, 1)):
        want = pool(g, k, s)
        assert np.allclose(grid.select(V.maxpool(F.col("g"), k, s)).first()[0], want)
        assert np.allclose(as_array(N.grid_maxpool(pixels, k, s)), want)


@pytest.mark.parametrize("k, stride", [(3, 1), (3, 2), (2, 3), (5, 70), (1, 1), (9, 4)])
def test_windows_over_many_tiles(spark, k, stride):
    """Two images with holes, missing values and places below zero against brute force; few pixels are copied."""
    rnd = random.Random(k * 100 + stride)
    images = {i: {(y, x): rnd.choice([None, *[rnd.randint(-9, 9) / 2] * 9]) for y in range(-70, h) for x in range(-5, w)
                  if rnd.random() < 0.995} for i, (h, w) in enumerate([(80, 140), (3, 4)])}
    df = spark.createDataFrame([(i, y, x, v) for i, cells in images.items() for (y, x), v in cells.items()],
                               "id int, y int, x int, v double").repartition(5)
    kernel = [[rnd.randint(-2, 2) for _ in range(k)] for _ in range(k)]

    def brute(step, fold):
        out = {}
        for i, cells in images.items():
            for y, x in cells:
                if y % step == 0 and x % step == 0:
                    window = [(dy, dx, cells.get((y + dy, x + dx), "hole")) for dy in range(k) for dx in range(k)]
                    if all(v != "hole" for _, _, v in window):
                        known = [w for w in window if w[2] is not None]
                        out[i, y // step, x // step] = fold(known) if known else None
        return out

    rows = lambda out: {(r.id, r.y, r.x): r.v for r in out.collect()}
    assert rows(N.grid_maxpool(df, k, stride)) == brute(stride, lambda w: max(v for _, _, v in w))
    want = brute(1, lambda w: sum(v * kernel[dy][dx] for dy, dx, v in w))
    assert rows(N.grid_convolve(df, kernel)) == want and len(want) > 5000
    copies = N._tiles(df, k, stride).agg(F.sum(F.size("cells"))).first()[0]
    assert copies < 1.5 * df.count()
    assert N.grid_convolve(df.limit(0), kernel).count() == 0


def test_shapes(spark):
    grid = spark.range(1).select(V.to_grid(
        F.transform(F.sequence(F.lit(1), F.lit(1024)), lambda i: i.cast("double")), 32).alias("g"))
    once = grid.select(V.convolve(F.col("g"), KERNEL).alias("g"))
    twice = once.select(V.maxpool(F.col("g"), 3, 1).alias("g"))
    for df, n in ((once, 30), (twice, 28)):
        assert df.select(F.size("g"), F.size(F.col("g")[0])).first() == (n, n)
    tiny = spark.range(1).select(F.array(F.array(F.lit(1.0))).alias("g"))
    assert tiny.select(V.convolve(F.col("g"), KERNEL)).first()[0] == []


def test_crop(spark):
    g = np.arange(48.0).reshape(6, 8)
    grid = spark.createDataFrame([(g.tolist(),)], "g array<array<double>>")
    pixels = spark.createDataFrame(
        [(y, x, float(g[y, x])) for y in range(6) for x in range(8)], "y int, x int, v double")
    for x, y, size in ((4, 3, 4), (4, 3, 5), (0, 0, 4), (8, 6, 4), (4, 3, 1)):
        h = size // 2
        want = g[max(y - h, 0):y + h, max(x - h, 0):x + h]
        got = grid.select(V.crop(F.col("g"), x, y, size)).first()[0]
        assert np.array_equal(np.array(got).reshape(want.shape), want)
        assert sorted(r["v"] for r in N.crop(pixels, x, y, size).collect()) == sorted(want.ravel())


def test_scaling(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0)], "k string, v double")
    assert [r["scaled"] for r in N.minmax_scale(df, "v", 0.0, 10.0).collect()] == [0.0, 5.0, 10.0, 10.0]
    by = {(r["k"], r["v"]): r["scaled"] for r in N.minmax_scale(df, "v", by="k").collect()}
    assert by == {("a", 1.0): 0.0, ("a", 3.0): 1.0, ("b", 5.0): None}
    plan = N.minmax_scale(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_softmax(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1000.0, 1000.0],)], "v array<double>")
    rows = df.select(V.softmax(F.col("v")), V.softmax(F.col("v"), stable=True)).collect()
    e = np.exp([1.0, 2.0, 3.0])
    assert np.allclose(rows[0][0], e / e.sum()) and np.allclose(rows[0][1], e / e.sum())
    assert all(math.isnan(x) for x in rows[1][0]) and rows[1][1] == [0.5, 0.5]


def test_network_and_loss(spark):
    w1, b1, w2, b2 = [[1, -1], [-2, 0.5]], [0.5, 0.0], [2, -3], 0.25
    x = np.array([0.3, 1.2])
    hidden = np.maximum(np.array(w1) @ x + b1, 0)
    want = 1 / (1 + math.exp(-(np.array(w2) @ hidden + b2)))
    row = spark.range(1).select(V.mlp_score(F.array(F.lit(0.3), F.lit(1.2)), w1, b1, w2, b2)).first()
    assert row[0] == pytest.approx(want)
    p = spark.createDataFrame([(0.0, 1), (1.0, 1), (0.25, 0)], "p double, y int")
    losses = [r[0] for r in p.select(V.bce(F.col("p"), F.col("y"))).collect()]
    assert losses == pytest.approx([100.0, 0.0, -math.log(0.75)])


def test_deposits(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    p, r, y, n = F.lit(1000.0), F.lit(6.5), F.lit(10), F.lit(3)
    fd = [round(1000 * 1.065 ** k, 2) for k in range(11)]
    rd = round(1000 * ((1 + 0.065 / 4) ** 12 - 1) / (1 - (1 + 0.065 / 4) ** (-1 / 3)), 2)
    assert one(M.fixed_deposit(p, r, y)) == fd[10]
    assert one(M.recurring_deposit(p, r, n)) == rd
    assert one(M.deposit_ladder(p, r, y, n)) == pytest.approx(fd[10] + fd[9] + fd[8])
    assert one(M.deposit_ladder(p, r, y, F.lit(0))) == 0.0
    assert one(M.rd_then_fd(p, r, y, n)) == round(rd * 1.065 ** 7, 2)
    assert one(M.recurring_deposit(p, F.lit(0.0), n)) is None
    assert one(M.maturity(p, r, y, n, F.lit(True))) == pytest.approx(fd[10] + fd[9] + fd[8])
    assert one(M.maturity(p, r, y, n, F.lit(False))) == round(rd * 1.065 ** 7, 2)
    assert [one(M.lakhs(F.lit(v))) for v in (99999.99, 100000.0, -150000.0)] == [0, 1, -1]


def write_png(path, rgb):
    """Smallest RGB file."""
    raw = b"".join(b"\0" + row.astype(np.uint8).tobytes() for row in rgb)

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    head = struct.pack(">IIBBBBB", rgb.shape[1], rgb.shape[0], 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head)
                     + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images_to_gray(spark, tmp_path):
    rgb = np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255]], [[0, 0, 0], [255, 255, 255], [10, 20, 30]]])
    write_png(tmp_path / "a.png", rgb)
    pixels = scan_pixels(spark, str(tmp_path))
    rows = pixels.collect()
    assert {(r["y"], r["x"]): [r["r"], r["g"], r["b"]] for r in rows} == {
        (y, x): rgb[y, x].tolist() for y in range(2) for x in range(3)}
    gray = {(r["y"], r["x"]): r["gray"] for r in N.grayscale(pixels, by="path").collect()}
    assert gray[0, 0] == pytest.approx(0.299) and gray[1, 1] == pytest.approx(1.0) and gray[1, 0] == 0.0


def test_centroid_mean(spark):
    df = vectors(spark, [[1, 2], [3, 4], [10, 20]], [0, 0, 1])
    got = {(r["label"], r["pos"]): r["mean"] for r in N.centroid_mean(df, "label", "vec").collect()}
    assert got == {(0, 0): 2.0, (0, 1): 3.0, (1, 0): 10.0, (1, 1): 20.0}


def test_knn_leaves_out_null_vectors(spark):
    rows = [(0, [0.0], 1), (1, None, 2), (2, [5.0], 3)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label long")
    assert {r["id"]: r["label"] for r in N.knn_classify(df, df.drop("label"), 1).collect()} == {0: 1, 2: 3}
