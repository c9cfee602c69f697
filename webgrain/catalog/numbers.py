"""Vectors, grids, clustering and scaling."""

from pyspark.sql import functions as F

from webgrain.catalog.registry import query, table
from webgrain.functions import vectors as V
from webgrain.operators import numeric as N
from webgrain.plans.scale import fresh_path
from webgrain.sources.readers import scan_pixels
from webgrain.sources.records import write_records

# element i (from 1) of a vector, as a row source
ELEMENTS = """
with e as (select vec_id, label, i - 1 as pos, cast(embedding[i] as double) as x
  from (select vec_id, label, embedding, unnest(range(1, 65)) as i from embeddings))
"""


@query("""
select event_id, round((value - lo) / (hi - lo) * 10 - 5, 6) as scaled
from events, (select min(value) as lo, max(value) as hi from events)
""")
def minmax_scale(spark, sf):
    scaled = N.minmax_scale(table(spark, sf, "events").select("event_id", "value"), "value", -5.0, 5.0)
    return scaled.select("event_id", F.round("scaled", 6).alias("scaled"))


@query("""
with y as (select vec_id, 0.299 * embedding[1]::double + 0.587 * embedding[2]::double
  + 0.114 * embedding[3]::double as y from embeddings)
select vec_id, round((y - lo) / (hi - lo), 6) as gray from y, (select min(y) as lo, max(y) as hi from y)
""")
def grayscale(spark, sf):
    pixel = table(spark, sf, "embeddings").select(
        "vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("rgb")])
    return N.grayscale(pixel).select("vec_id", F.round("gray", 6).alias("gray"))


@query(ELEMENTS + """
select 'image' || vec_id // 64 as image, cast(vec_id % 64 * 8 + pos // 8 as int) as y, cast(pos % 8 as int) as x,
  cast(floor(abs(x) * 40) as int) % 256 as r, cast(pos * 3 as int) as g, cast(vec_id % 256 as int) as b from e
""")
def image_pixels(spark, sf):
    """Images written of the vectors, 8 rows of pixels each and 64 vectors to an image, read as pixels."""
    import struct
    import zlib

    import pyarrow as pa

    @F.arrow_udf("binary")
    def png(rows: pa.Array) -> pa.Array:
        def chunk(kind, data):
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

        def one(lines):
            head = struct.pack(">IIBBBBB", 8, len(lines), 8, 2, 0, 0, 0)
            data = zlib.compress(b"".join(b"\0" + bytes(line) for line in lines), 1)
            return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", data) + chunk(b"IEND", b"")

        return pa.array([one(r.as_py()) for r in rows], pa.binary())

    def channels(x, i):
        return F.array(F.floor(F.abs(x.cast("double")) * 40).cast("int") % 256, i * 3, (F.col("vec_id") % 256).cast("int"))

    cells = F.transform("embedding", channels)
    line = lambda k: F.flatten(F.slice(cells, k * 8 + 1, 8))
    images = table(spark, sf, "embeddings").select(
        "vec_id", F.transform(F.sequence(F.lit(0), F.lit(7)), line).alias("lines")).groupBy(
        F.floor(F.col("vec_id") / 64).alias("n")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "lines"))).alias("rows"))
    root = fresh_path(spark, "images")
    files = images.select("n", F.concat(F.lit("image"), F.col("n").cast("string"), F.lit(".png")).alias("file"),
                          png(F.flatten(F.col("rows.lines"))).alias("payload"))
    write_records(files, root, "file", "n")
    return scan_pixels(spark, root).select(
        F.regexp_extract("path", r"([^/]+)\.png$", 1).alias("image"), "y", "x", "r", "g", "b")


def grids(spark, sf):
    vec = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", V.to_grid(vec, 8).alias("grid"))


def cells(df, column):
    """Grid column to (vec_id, y, x, v)."""
    rows = df.select("vec_id", F.posexplode(column).alias("y", "row"))
    return rows.select("vec_id", "y", F.posexplode("row").alias("x", "v"))


GRID = ELEMENTS + ", g as (select vec_id, cast(pos // 8 as int) as y, cast(pos % 8 as int) as x, x as v from e)"


@query(GRID + """
select vec_id, cast(y - 1 as int) as y, cast(x - 3 as int) as x, v from g
where y >= 1 and y < 5 and x >= 3 and x < 7
""")
def roi_crop(spark, sf):
    return cells(grids(spark, sf), V.crop(F.col("grid"), x=5, y=3, size=5))


KERNEL = [[1, 0, -1], [2, 0, -2], [1, 0, -1]]
KERNEL_SQL = """(values (0, 0, 1), (0, 2, -1), (1, 0, 2), (1, 2, -2), (2, 0, 1), (2, 2, -1)) k(dy, dx, w)"""


@query(GRID + f"""
select vec_id, cast(y - dy as int) as y, cast(x - dx as int) as x, round(sum(v * w), 6) as v from g, {KERNEL_SQL}
where y - dy between 0 and 5 and x - dx between 0 and 5 group by all
""")
def grid_convolve(spark, sf):
    out = cells(grids(spark, sf), V.convolve(F.col("grid"), KERNEL))
    return out.withColumn("v", F.round("v", 6))


@query(GRID + f"""
select vec_id, cast(y - dy as int) as y, cast(x - dx as int) as x, round(sum(v * w), 6) as v from g, {KERNEL_SQL}
where y - dy between 0 and 5 and x - dx between 0 and 5 group by all
""")
def pixel_convolve(spark, sf):
    """The same on a pixel table, where one image may be of any size."""
    pixels = cells(grids(spark, sf), F.col("grid")).withColumnRenamed("vec_id", "id")
    out = N.grid_convolve(pixels, KERNEL)
    return out.select(F.col("id").alias("vec_id"), "y", "x", F.round("v", 6).alias("v"))


POOL = GRID + """
select vec_id, oy as y, ox as x, max(v) as v from g, range(0, 3) a(oy), range(0, 3) b(ox)
where y between oy * 2 and oy * 2 + 2 and x between ox * 2 and ox * 2 + 2 group by all
"""


@query(POOL)
def grid_maxpool(spark, sf):
    return cells(grids(spark, sf), V.maxpool(F.col("grid"), 3, 2))


@query(POOL)
def pixel_maxpool(spark, sf):
    pixels = cells(grids(spark, sf), F.col("grid")).withColumnRenamed("vec_id", "id")
    return N.grid_maxpool(pixels, 3, 2).withColumnRenamed("id", "vec_id")


@query(ELEMENTS + "select label, pos, round(avg(x), 6) as mean from e group by 1, 2")
def centroid_mean(spark, sf):
    means = N.centroid_mean(table(spark, sf, "embeddings"), "label", "embedding")
    return means.withColumn("mean", F.round("mean", 6))


@query(ELEMENTS + """
select vec_id, pos, round(exp(x) / sum(exp(x)) over (partition by vec_id), 6) as p from e
""")
def softmax_rows(spark, sf):
    soft = table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(V.softmax(F.col("embedding"))).alias("pos", "p"))
    return soft.withColumn("p", F.round("p", 6))


@query("""
with p as (select quality as y, 1 / (1 + exp(2 - n_chars / 1000)) as p from labels join documents using (doc_id))
select round(avg(-(y * greatest(ln(p), -100) + (1 - y) * case when p = 1 then -100 else greatest(ln(1 - p), -100) end)), 6) as loss,
  count(*) as n from p
""")
def bce_loss(spark, sf):
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    p = V.sigmoid(F.col("n_chars") / 1000 - 2)
    return joined.agg(
        F.round(F.avg(V.bce(p, F.col("quality"))), 6).alias("loss"), F.count("*").alias("n"))


HIDDEN, WIDTH = 4, 64
W1 = [[((i * 7 + j * 3) % 11 - 5) / 50 for i in range(WIDTH)] for j in range(HIDDEN)]
B1 = [j / 10 for j in range(HIDDEN)]
W2, B2 = [0.5, -1.0, 1.5, -0.25], 0.1


@query(ELEMENTS + """
, h as (select vec_id, j, greatest(0, sum(x * (((pos * 7 + j * 3) % 11 - 5) / 50)) + j / 10) as h
  from e, range(0, 4) t(j) group by 1, 2)
select vec_id, round(1 / (1 + exp(-(sum(h * [0.5, -1.0, 1.5, -0.25][j + 1]) + 0.1))), 6) as p from h group by 1
""")
def mlp_score(spark, sf):
    p = V.mlp_score(F.col("embedding"), W1, B1, W2, B2)
    return table(spark, sf, "embeddings").select("vec_id", F.round(p, 6).alias("p"))


@query("""
with recursive v as (select vec_id, cast(embedding as double[64]) as v from embeddings where embedding is not null),
c as (
  select 0 as step, cast(row_number() over (order by vec_id) - 1 as int) as cluster, v as c
  from (select * from v order by vec_id limit 4)
  union all
  select step + 1, cluster, cast(list(m order by pos) as double[64]) from (
    select step, cluster, pos, avg(v[pos]) as m
    from (select c.step, v.vec_id, arg_min(c.cluster, (array_distance(v.v, c.c), c.cluster)) as cluster, any_value(v.v) as v
          from c, v group by 1, 2), range(1, 65) p(pos) group by 1, 2, 3)
  where step < 3 group by step, cluster)
select cluster, cast(pos - 1 as int) as pos, round(c[pos], 6) as x from c, range(1, 65) p(pos) where step = 3
""")
def kmeans_3_iters(spark, sf):
    centroids = N.kmeans(table(spark, sf, "embeddings"), "embedding", 4, "vec_id", max_iter=3)
    rows = centroids.select("cluster", F.posexplode("centroid").alias("pos", "x"))
    return rows.withColumn("x", F.round("x", 6))


@query("""
with v as (select vec_id, label, cast(embedding as double[64]) as v from embeddings where vec_id % 50 <> 7),
d as (select a.vec_id as id, b.label, array_distance(a.v, b.v) as dist, b.vec_id as other from v a, v b
  qualify row_number() over (partition by a.vec_id order by array_distance(a.v, b.v), b.vec_id) <= 5),
n as (select id, label, count(*) as n from d group by 1, 2)
select id, arg_max(label, (n, -label)) as label from n group by 1
""")
def knn_classify(spark, sf):
    """Some vectors are made null: they take no part on either side."""
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.when(F.col("vec_id") % 50 != 7, F.col("embedding")).alias("vec"))
    return N.knn_classify(vectors, vectors.drop("label"), 5)
