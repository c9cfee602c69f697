"""Functions on array columns: vectors and small grids held in one row. No shuffle."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from webgrain.functions.binding import let


def vector_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return vector_sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def softmax(vec: Column, stable: bool = False) -> Column:
    """``exp(x) / sum(exp(x))``; without ``stable`` large values overflow to NaN, as written."""
    shift = F.array_max(vec) if stable else F.lit(0.0)
    powers = F.transform(vec, lambda x: F.exp(x.cast("double") - shift))
    both = let(powers, lambda p: F.struct(p.alias("p"), vector_sum(p).alias("total")))
    return let(both, lambda b: F.transform(b["p"], lambda e: e / b["total"]))


def relu(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def dense(vec: Column, weights, bias) -> list[Column]:
    """One column per row of ``weights``."""
    return [dot(vec, literal_vector(w)) + F.lit(float(b)) for w, b in zip(weights, bias)]


def mlp_score(vec: Column, w1, b1, w2, b2) -> Column:
    """Two dense layers with ReLU and sigmoid, one output."""
    hidden = F.array(*[relu(h) for h in dense(vec, w1, b1)])
    return sigmoid(dense(hidden, [w2], [b2])[0])


def bce(p: Column, y: Column) -> Column:
    """Binary cross-entropy of one prediction; logarithms are not taken below -100."""

    def log(x):
        return F.greatest(F.coalesce(F.log(x), F.lit(-100.0)), F.lit(-100.0))

    return -(y * log(p) + (1 - y) * log(1 - p))


def to_grid(vec: Column, width: int) -> Column:
    """Row-major vector to rows of ``width``."""
    starts = F.sequence(F.lit(0), (F.size(vec) / width).cast("int") - 1)
    return F.transform(starts, lambda y: F.slice(vec, y * width + 1, F.lit(width)))


def _starts(length: Column, k: int, stride: int) -> Column:
    """First positions of the full windows."""
    return F.when(length >= k, F.sequence(F.lit(0), length - k, F.lit(stride))).otherwise(
        F.array().cast("array<int>")
    )


def _windows(grid: Column, k: int, stride: int, cell) -> Column:
    ys = _starts(F.size(grid), k, stride)
    xs = _starts(F.size(F.get(grid, F.lit(0))), k, stride)
    return F.transform(ys, lambda y: F.transform(xs, lambda x: cell(y, x)))


def convolve(grid: Column, kernel) -> Column:
    """Valid cross-correlation with a square kernel, stride 1."""
    k = len(kernel)

    def cell(y, x):
        total = F.lit(0.0)
        for dy in range(k):
            for dx in range(k):
                total = total + F.get(F.get(grid, y + dy), x + dx) * F.lit(float(kernel[dy][dx]))
        return total

    return _windows(grid, k, 1, cell)


def maxpool(grid: Column, k: int = 3, stride: int = 1) -> Column:
    return _windows(grid, k, stride, lambda y, x: F.greatest(
        *[F.get(F.get(grid, y + dy), x + dx) for dy in range(k) for dx in range(k)]
    ) if k > 1 else F.get(F.get(grid, y), x))


def crop(grid: Column, x: int, y: int, size: int) -> Column:
    """Square ``[y-h, y+h) x [x-h, x+h)`` with ``h = size // 2``, clipped to the grid."""
    half = size // 2

    def cut(values, centre):
        low = max(centre - half, 0)
        return F.slice(values, low + 1, max(centre + half - low, 0))

    return F.transform(cut(grid, y), lambda row: cut(row, x))
