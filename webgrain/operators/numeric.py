"""Scaling, pixel tables, clustering and nearest neighbours."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.lookups import LUMA
from webgrain.plans.scale import materialize, running_totals, top_n_per_key


def minmax_scale(df: DataFrame, col: str, new_min=0.0, new_max=1.0, by: str | None = None,
                 name: str = "scaled") -> DataFrame:
    """Scale to [new_min, new_max] over the table, or per ``by``; null for constant data."""
    value = F.col(col)
    bounds = [F.min(col).alias("_lo"), F.max(col).alias("_hi")]
    if by is None:
        pair = df.agg(F.struct(*bounds)).scalar()
        low, high = pair["_lo"], pair["_hi"]
    else:
        df = df.join(df.groupBy(by).agg(*bounds), by)
        low, high = F.col("_lo"), F.col("_hi")
    unit = F.try_divide(value - low, high - low)
    return df.withColumn(name, (new_max - new_min) * unit + new_min).drop("_lo", "_hi")


def grayscale(df: DataFrame, r: str = "r", g: str = "g", b: str = "b", by: str | None = None,
              name: str = "gray") -> DataFrame:
    """Luma, scaled to 0..1 per table or per image."""
    luma = sum((F.col(c) * w for c, w in zip((r, g, b), LUMA)), F.lit(0.0))
    return minmax_scale(df.withColumn("_luma", luma), "_luma", by=by, name=name).drop("_luma")


def crop(df: DataFrame, x: int, y: int, size: int) -> DataFrame:
    """Pixel table (y, x, ..) cut to a square."""
    h = size // 2
    return df.filter(
        F.col("y").between(y - h, y + h - 1) & F.col("x").between(x - h, x + h - 1)
    )


TILE = 64  # pixels along the edge of a tile, more for wide windows


def _tiles(df: DataFrame, k: int, stride: int) -> DataFrame:
    """(id, ty, tx, cells): the pixels of each tile, with the border that the windows which start in it
    reach into. Only border pixels are copied, to the tiles before; places count from the tile's corner."""
    edge = max(TILE, 8 * k) // stride * stride or stride

    def tiles(c):
        last = F.floor(F.col(c) / edge)
        first = F.ceil((F.col(c) - (k - 1) - (edge - stride)) / edge)
        return F.explode(F.when(first <= last, F.sequence(first, last)))

    at = [(F.col(c) - F.col(t) * edge).cast("int").alias(c) for c, t in (("y", "ty"), ("x", "tx"))]
    return df.select("id", "y", "x", F.col("v").cast("double").alias("v")).withColumn("ty", tiles("y")).withColumn(
        "tx", tiles("x")).groupBy("id", "ty", "tx").agg(F.collect_list(F.struct(*at, "v")).alias("cells")).select(
        "id", (F.col("ty") * edge).alias("ty"), (F.col("tx") * edge).alias("tx"), "cells")


def _over_windows(df: DataFrame, k: int, stride: int, start: float, add) -> DataFrame:
    """(id, y, x, v) of all full k x k windows, ``stride`` apart. ``add(total, values, dy, dx)`` folds the values
    at one place of all windows of a tile into ``total``, which starts as ``start``; so do missing values."""

    def fold(y, x, v, known):
        shape = (y.max() + 1, x.max() + 1)
        high, wide = [(n - k) // stride + 1 for n in shape]
        if high < 1 or wide < 1:
            return [np.zeros(0)] * 4
        dense, there, number = np.full(shape, start), np.zeros(shape, bool), np.zeros(shape, bool)
        there[y, x], number[y, x] = True, known
        dense[y[known], x[known]] = v[known]
        total, full, some = np.full((high, wide), start), np.ones((high, wide), bool), np.zeros((high, wide), bool)
        for dy in range(k):
            for dx in range(k):
                part = np.s_[dy:dy + (high - 1) * stride + 1:stride, dx:dx + (wide - 1) * stride + 1:stride]
                total = add(total, dense[part], dy, dx)
                full &= there[part]
                some |= number[part]
        oy, ox = np.nonzero(full)
        return oy, ox, total[oy, ox], some[oy, ox]

    @F.arrow_udf("array<struct<y:int,x:int,v:double>>")
    def run(cells: pa.Array) -> pa.Array:
        if not len(cells):
            return pa.array([], pa.list_(pa.struct([("y", pa.int32()), ("x", pa.int32()), ("v", pa.float64())])))
        flat, ends = cells.flatten(), np.cumsum(cells.value_lengths().to_numpy(zero_copy_only=False))
        y, x, v = (flat.field(i) for i in range(3))
        known = np.asarray(v.is_valid())
        y, x, v = (c.to_numpy(zero_copy_only=False) for c in (y, x, v))
        found = [fold(y[first:end], x[first:end], v[first:end], known[first:end])
                 for first, end in zip([0, *ends[:-1]], ends)]
        oy, ox, out, some = (np.concatenate(c) for c in zip(*found))
        rows = pa.StructArray.from_arrays(
            [pa.array(oy, pa.int32()), pa.array(ox, pa.int32()), pa.array(out, pa.float64(), mask=~some.astype(bool))],
            names=["y", "x", "v"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(f[0]) for f in found]]), pa.int32()), rows)

    place = lambda t, c: (F.col(t) / stride + F.col(f"_w.{c}")).cast("int").alias(c)
    return _tiles(df, k, stride).select("id", "ty", "tx", F.explode(run("cells")).alias("_w")).select(
        "id", place("ty", "y"), place("tx", "x"), F.col("_w.v").alias("v"))


def grid_convolve(df: DataFrame, kernel) -> DataFrame:
    """Valid cross-correlation on a pixel table (id, y, x, v), one row per pixel. Missing values add nothing; a
    window of missing values only gives null.

    Pixels travel to their tile, and only those on its border to the neighbours as well, so about as many rows
    are shuffled as there are pixels; one huge image is spread like many small ones.
    """
    weights = [[float(w) for w in row] for row in kernel]
    return _over_windows(df, len(weights), 1, 0.0, lambda total, v, dy, dx: total + weights[dy][dx] * v)


def grid_maxpool(df: DataFrame, k: int = 3, stride: int = 1) -> DataFrame:
    """Maximum of each full k x k window of a pixel table, windows ``stride`` apart; tiles as above."""
    out = _over_windows(df, k, stride, -math.inf, lambda total, v, dy, dx: np.maximum(total, v))
    return out.withColumn("v", F.col("v").cast(df.schema["v"].dataType))


def centroid_mean(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Mean vector per key as (key, pos, mean), combined on the map side."""
    return df.select(key, F.posexplode(vec).alias("pos", "x")).groupBy(key, "pos").agg(
        F.avg(F.col("x").cast("double")).alias("mean")
    )


# --- k-means --------------------------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    """Arrow list column to a 2-D array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def _partial_sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per task: rows and vector sum per nearest centroid (lowest number on ties)."""

    def run(batches):
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros_like(centroids)
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                nearest = _square_distances(x, centroids).argmin(1)
                counts += np.bincount(nearest, minlength=len(centroids))
                np.add.at(sums, nearest, x)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(range(len(centroids)), pa.int32()),
            "n": pa.array(counts),
            "sums": pa.array(sums.tolist(), pa.list_(pa.float64())),
        })

    return vectors.mapInArrow(run, "cluster int, n long, sums array<double>")


def kmeans(df: DataFrame, vec: str, k: int, order: str, max_iter: int = 100, rtol: float = 1e-5,
           atol: float = 1e-8) -> DataFrame:
    """Lloyd's algorithm from the k rows lowest in ``order``: (cluster, centroid).

    Every pass is one scan that sends k partial sums per task; only the k centroids reach the
    driver, and no lineage builds up. A cluster that loses all rows keeps its centroid.
    """
    vectors = df.filter(F.col(vec).isNotNull()).select(vec)
    start = df.filter(F.col(vec).isNotNull()).orderBy(order).select(vec).limit(k).collect()
    centroids = np.array([r[0] for r in start], dtype=np.float64)
    for _ in range(max_iter):
        means = (
            _partial_sums(vectors, centroids).filter("n > 0")
            .select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
            .groupBy("cluster", "pos").agg((F.sum("s") / F.sum("n")).alias("mean"))
            .collect()
        )
        moved = centroids.copy()
        for r in means:
            moved[r["cluster"], r["pos"]] = r["mean"]
        done = np.allclose(centroids, moved, rtol=rtol, atol=atol)
        centroids = moved
        if done:
            break
    return df.sparkSession.createDataFrame(
        [(i, c.tolist()) for i, c in enumerate(centroids)], "cluster int, centroid array<double>"
    )


# --- nearest neighbours ---------------------------------------------------------------------


MAX_BLOCKS = 1 << 15  # blocks whose bounds every task holds
GROUPS = 8  # groups of blocks that the train rows are exchanged in, if these are not larger than
GROUP_CELLS = 1 << 22  # numbers in the vectors of a group
_NEIGHBOUR = "test_id long, train_id long, label long, dist double"


def _candidates(train, test, k):
    """Mask (test x train) that holds the k nearest of each test row: distances from the fast product
    form with some slack."""
    rough = _square_distances(test, train)
    slack = 1e-9 * (1 + (test * test).sum(1) + (train * train).sum(1).max())
    n = min(k, rough.shape[1])
    kth = np.partition(rough, n - 1, axis=1)[:, n - 1]
    return rough <= (kth + slack)[:, None]


def _best(parts, k):
    """k nearest per test row by exact distance, then id."""
    test_id, train_id, label, dist = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((train_id, dist, test_id))
    test_id = test_id[order]
    start = np.flatnonzero(np.r_[True, test_id[1:] != test_id[:-1]])
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    kept = order[place < k]
    return [np.concatenate(x)[kept] for x in zip(*parts)]


def _tile_neighbours(train, test, k, cells):
    """k nearest of one group; the distances are held for ``cells`` pairs at a time and the best so
    far are kept from tile to tile."""
    ids, labels, x = np.asarray(train["id"]), np.asarray(train["label"]), _matrix(train["vec"])
    test_ids, y = np.asarray(test["id"]), _matrix(test["vec"])
    if x.shape[1] != y.shape[1]:
        raise ValueError("vectors of both sides must have one width")
    wide = max(1, min(len(x), cells))
    high = max(1, cells // wide)
    found = []
    for a in range(0, len(y), high):
        best = []
        for b in range(0, len(x), wide):
            i, j = np.nonzero(_candidates(x[b:b + wide], y[a:a + high], k))
            exact = ((x[b + j] - y[a + i]) ** 2).sum(1)
            best = [_best([*best, (test_ids[a + i], ids[b + j], labels[b + j], exact)], k)]
        found += best
    return [np.concatenate(c) for c in zip(*found)]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(_square_distances(a, b), 0))


def _row_chunks(rows: int, columns: int, cells: int):
    step = max(1, cells // max(1, columns))
    return ((i, min(rows, i + step)) for i in range(0, rows, step))


def _in_cells(vectors: DataFrame, pivots: np.ndarray, cells: int) -> DataFrame:
    """(id, label, vec) with the nearest pivot and the distance to it."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2)) if batch.num_rows else np.zeros((0, pivots.shape[1]))
            cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
            for i, j in _row_chunks(len(x), len(pivots), cells):
                d = _distances(x[i:j], pivots)
                cell[i:j] = d.argmin(1)
                dist[i:j] = d.min(1)
            yield pa.record_batch([*batch.columns, pa.array(cell), pa.array(dist)],
                                  names=["id", "label", "vec", "cell", "d"])

    kind = vectors.schema["vec"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id long, label long, vec {kind}, cell int, d double")


class _Rings:
    """The blocks of the train rows: a cell's rows in the order of their distance to its pivot, cut
    into rings of a bounded number of rows. A distance of a test row to any row of a block is bounded from
    below by the triangle inequality, and by the plane between the pivots of both."""

    def __init__(self, pivots, block, cell, low, high, size):
        self.pivots, self.block, self.cell, self.low, self.high, self.size = pivots, block, cell, low, high, size
        scale = 1 + np.sqrt((pivots * pivots).sum(1).max(initial=0)) + high.max(initial=0)
        self.slack = 4e-6 * scale  # rounding of the distances
        self.between = np.maximum(_distances(pivots, pivots), self.slack)

    def bounds(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (test rows x blocks)."""
        to_pivot = _distances(y, self.pivots)
        near = to_pivot.argmin(1)
        own = to_pivot[np.arange(len(y)), near][:, None]
        plane = (to_pivot ** 2 - own ** 2) / (2 * self.between[near])
        plane[np.arange(len(y)), near] = 0
        d = to_pivot[:, self.cell]
        least = np.maximum(np.maximum(d - self.high, self.low - d), plane[:, self.cell])
        return np.maximum(least - self.slack, 0), d + self.high + self.slack

    def reach(self, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The lower bounds, the first block to look into, and a distance that the kth neighbour is
        within: the blocks with the least upper bounds that hold k rows."""
        least, most = self.bounds(y)
        order = np.argsort(most, axis=1)
        enough = np.minimum((np.cumsum(self.size[order], axis=1) < k).sum(1), most.shape[1] - 1)
        rows = np.arange(len(y))
        limit = most[rows, order[rows, enough]]
        if self.size.sum() < k:
            limit[:] = np.inf
        return least, np.argmin(least + 1e-9 * most, axis=1), limit


def _visits(test: DataFrame, rings: _Rings, k: int, cells: int, span: int, first: bool) -> DataFrame:
    """(group, id, vec, blocks): the block that a test row looks into first, or all others that its kth
    neighbour (within ``reach``, if it has one) may be in. A row goes once to each group of ``span``
    blocks, with the list of those it looks into."""
    kind = test.schema["vec"].dataType

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch.column(batch.schema.get_field_index("vec")))
            known = None if first else np.asarray(batch.column(batch.schema.get_field_index("reach")).fill_null(np.inf))
            for i, j in _row_chunks(len(y), len(rings.block) * 4, cells):
                least, start, limit = rings.reach(y[i:j], k)
                if first:
                    row, col = np.arange(j - i), start
                else:
                    limit = np.minimum(limit, known[i:j] + rings.slack)
                    wanted = least <= limit[:, None]
                    wanted[np.arange(j - i), start] = False
                    row, col = np.nonzero(wanted)
                blocks = rings.block[col]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (blocks[1:] // span != blocks[:-1] // span)
                lead = np.flatnonzero(new)
                lists = pa.ListArray.from_arrays(pa.array(np.append(lead, len(row)).astype(np.int32)), pa.array(blocks))
                part = batch.slice(i, j - i).select(["id", "vec"]).take(pa.array(row[lead]))
                yield pa.record_batch([pa.array(blocks[lead] // span), *part.columns, lists],
                                      names=["group", "id", "vec", "blocks"])

    return test.mapInArrow(run, f"group int, id long, vec {kind.simpleString()}, blocks array<int>")


def _group_neighbours(train: pa.Table, test: pa.Table, k: int, cells: int):
    """k nearest of each test row in the blocks of its list."""
    blocks = np.asarray(train["block"])
    lists = test["blocks"].combine_chunks()
    wanted = np.asarray(lists.flatten())
    row = np.repeat(np.arange(test.num_rows), np.asarray(lists.value_lengths()))
    best = None
    for b in np.unique(blocks):
        rows = row[wanted == b]
        if len(rows):
            found = _tile_neighbours(train.take(pa.array(np.flatnonzero(blocks == b))), test.take(pa.array(rows)), k, cells)
            best = found if best is None else _best([best, found], k)
    return best or [[], [], [], []]


def _compared(blocks: DataFrame, visits: DataFrame, k: int, rows: int, cells: int, span: int) -> DataFrame:
    """The k nearest of each visit inside its blocks. The visits of a group of ``span`` blocks are dealt into
    parts of about ``rows``, and the group goes to each of them, so that a group near many test rows is no
    hot key."""
    parts = F.broadcast(  # at most MAX_BLOCKS rows
        visits.groupBy("group").agg(F.ceil(F.count("*") / rows).cast("int").alias("parts")))
    left = blocks.withColumn("group", F.floor(F.col("block") / span).cast("int")).join(parts, "group").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = visits.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int"))

    def run(train: pa.Table, test: pa.Table) -> pa.Table:
        found = _group_neighbours(train, test, k, cells) if train.num_rows and test.num_rows else [[], [], [], []]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("test_id", "train_id", "label", "dist"), found, types)})

    return left.select("group", "part", "block", "id", "label", "vec").groupBy("group", "part").cogroup(
        right.select("group", "part", "id", "vec", "blocks").groupBy("group", "part")).applyInArrow(run, _NEIGHBOUR)


def _ring_index(train: DataFrame, total: int, pivots: int, cell_rows: int, block_rows: int, cells: int) -> tuple[DataFrame, _Rings]:
    """The train rows with their block, and the bounds of the blocks."""
    sample = train.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(min(pivots, math.ceil(total / cell_rows)))
    chosen = np.array([r[0] for r in sample.select("vec").collect()], dtype=np.float64)
    block_rows = max(block_rows, math.ceil(total / MAX_BLOCKS))
    placed = running_totals(
        _in_cells(train, chosen, cells).withColumn("one", F.lit(1)), ["cell"], ["d", "id"], ["one"])
    blocks = placed.select(
        "id", "label", "vec", "cell", "d", F.floor(F.col("one_before") / block_rows).cast("int").alias("ring"))
    facts = blocks.groupBy("cell", "ring").agg(
        F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("size")).orderBy("cell", "ring").toPandas()
    first = facts.groupby("cell", sort=True).size().reindex(range(len(chosen)), fill_value=0).cumsum().shift(fill_value=0)
    start = F.array(*[F.lit(int(x)) for x in first])
    rings = _Rings(chosen, np.arange(len(facts), dtype=np.int32), facts["cell"].to_numpy(), facts["low"].to_numpy(float),
                   facts["high"].to_numpy(float), facts["size"].to_numpy(np.int64))
    return blocks.select((F.get(start, F.col("cell")) + F.col("ring")).alias("block"), "id", "label", "vec"), rings


def nearest_neighbours(train: DataFrame, test: DataFrame, k: int, pivots: int = 512, cell_rows: int = 512,
                       block_rows: int = 2048, visit_rows: int | None = None, cells: int = 1 << 20, measure: list | None = None) -> DataFrame:
    """Exact k nearest train rows (id, vec, label) for each test row (id, vec). Rows without a vector
    are left out; all vectors must have one width, ids of the test rows must be unique.

    The train rows go to the nearest of some pivots (one for ``cell_rows`` rows, at most ``pivots``,
    picked by hash) and, ordered by the distance to it, into blocks of ``block_rows``: a cell that
    holds a third of all rows, or of equal ones, is many blocks. A test row is first compared with the
    block it is nearest to; the kth distance found there, and the bounds of the blocks, leave only the
    blocks that can hold something nearer, and it is compared with these alone. Rows are exchanged by groups
    of blocks: where nothing can be pruned, each row of both sides is sent about ``GROUPS`` times, until groups
    and the ``visit_rows`` dealt to them (by default as many as a group has) are as large as ``GROUP_CELLS``
    allows. Only pivots and bounds of
    the blocks (at most ``MAX_BLOCKS``) reach the driver. How much is pruned depends on the data: vectors
    without any clusters in many dimensions are all about equally far, and all pairs are compared.

    ``measure``, if given, gets the number of pairs compared (two more jobs).
    """
    train = train.filter(F.col("vec").isNotNull()).select(
        F.col("id").cast("long"), F.col("label").cast("long"), "vec")
    test = test.filter(F.col("vec").isNotNull()).select(F.col("id").cast("long"), "vec")
    total = train.count()
    if not total:
        return test.sparkSession.createDataFrame([], _NEIGHBOUR)
    blocks, rings = _ring_index(train, total, pivots, cell_rows, block_rows, cells)
    group_rows = min(math.ceil(total / GROUPS), GROUP_CELLS // max(1, rings.pivots.shape[1]))
    span = max(1, round(group_rows / rings.size.max()))
    visit_rows = visit_rows or max(block_rows, group_rows)
    start = materialize(_visits(test, rings, k, cells, span, first=True), "visits")
    near = materialize(_compared(blocks, start, k, visit_rows, cells, span), "nearest")
    # a test row with fewer than k rows in its first block has no bound from there
    reach = near.groupBy("test_id").agg(F.sqrt(F.max("dist")).alias("reach"), F.count("*").alias("n")).filter(
        F.col("n") >= k).select(F.col("test_id").alias("id"), "reach")
    rest = materialize(_visits(start.select("id", "vec").join(reach, "id", "left"), rings, k, cells, span, first=False), "visits")
    if measure is not None:
        for visits in (start, rest):
            counts = visits.select(F.explode("blocks").alias("block")).groupBy("block").count().toPandas()
            measure.append(int((rings.size[counts["block"]] * counts["count"]).sum()))
    found = near.unionByName(_compared(blocks, rest, k, visit_rows, cells, span))
    return top_n_per_key(found, ["test_id"], ["dist", "train_id"], k)


def knn_classify(train: DataFrame, test: DataFrame, k: int, **options) -> DataFrame:
    """(id, label): majority label of the k nearest, smallest label on ties."""
    votes = nearest_neighbours(train, test, k, **options).groupBy("test_id", "label").agg(
        F.count("*").alias("n"))
    return votes.groupBy(F.col("test_id").alias("id")).agg(
        F.max_by("label", F.struct("n", -F.col("label"))).alias("label"))
