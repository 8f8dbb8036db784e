"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, so sums and, after centring at the nearest whole number to the mean,
products add up exactly in any order of tasks. The centred scatter is a small matrix of dimensions
by dimensions. Its pivoted Cholesky factor is turned by plane rotations until its columns are
orthogonal: their squared lengths are the eigenvalues of the scatter, and the columns at unit length
its eigenvectors. Rows are only read and projected, never gathered.
"""

import numpy as np
from pyspark.sql import DataFrame, functions as F

SCALE = 64
COMPONENTS = 32
BLOCK = 1 << 16             # vectors multiplied at a time
LARGEST = 1 << 40           # entries beyond it are clipped: they would not fit a long
SWEEPS = 60


def usable(rows: DataFrame, column="embedding"):
    """Whether a vector is there and holds finite numbers only."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(column, number), F.lit(False))


def whole(vectors, scale=SCALE):
    """floor(scale * c) of a matrix, as long. A constant added to all, as the contract has it, moves
    the mean along and changes no deviation, covariance or projection."""
    return np.floor(np.clip(vectors * float(scale), -LARGEST, LARGEST)).astype(np.int64)


def _matrix(column, dims):
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _partial(dims, measure):
    """One row of numbers per task: the sum of `measure` over its blocks of whole vectors."""
    def run(batches):
        import pyarrow as pa
        total = None
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = measure(whole(_matrix(batch.column(0).slice(k, BLOCK), dims)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], ["part"])
    return run


def _sum(vectors, dims, measure, kind):
    """The measure over all vectors: partial sums per task, added cell by cell in Spark, so that
    the driver gets one number per cell however many tasks there are."""
    parts = vectors.mapInArrow(_partial(dims, measure), f"part array<{kind}>")
    cells = parts.select(F.posexplode("part").alias("cell", "value")).groupBy("cell").agg(
        F.sum("value").alias("value")).collect()
    out = np.zeros(len(cells), np.int64 if kind == "bigint" else np.float64)
    for cell, value in cells:
        out[cell] = value
    return out


def cholesky(a, tolerance=1e-13):
    """(factor, order) with a[order][:, order] = factor @ factor.T, by the largest remaining
    diagonal; the factor has as many columns as `a` has rank. Zero for a negligible rest."""
    order, left = np.arange(len(a)), a.diagonal().astype(float)
    factor, limit = np.zeros_like(a, float), tolerance * max(left.max(initial=0), 0)
    for k in range(len(a)):
        best = k + int(np.argmax(left[k:]))
        if left[best] <= limit:
            return factor[:, :k], order
        swap = [best, k]
        order[[k, best]], left[[k, best]] = order[swap], left[swap]
        factor[[k, best]] = factor[swap]
        factor[k, k] = np.sqrt(left[k])
        column = a[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]
        factor[k + 1:, k] = column / factor[k, k]
        left[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def _rounds(n):
    """All pairs of n columns as rounds of disjoint pairs, one column standing still."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < n]
        yield np.array([p for p, _ in pairs], int), np.array([q for _, q in pairs], int)
        ring = ring[:1] + ring[-1:] + ring[1:-1]


def orthogonal_columns(factor, tolerance=1e-15):
    """The factor times a rotation that makes its columns orthogonal."""
    w = factor.copy()
    rounds = list(_rounds(w.shape[1]))
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in rounds:
            a, b = w[:, p], w[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, off.max(initial=0))
            turn = off > tolerance
            zeta = (bb - aa) / (2 * np.where(turn, ab, 1))
            t = np.where(turn, np.copysign(1, zeta) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            w[:, p], w[:, q] = c * a - c * t * b, c * t * a + c * b
        if worst <= tolerance * 10:
            break
    return w


def principal(scatter):
    """(eigenvalues, falling, and unit eigenvectors as columns) of a scatter; as many as its rank."""
    factor, order = cholesky(scatter)
    turned = orthogonal_columns(factor)
    sizes = (turned ** 2).sum(axis=0)
    by_size = np.argsort(-sizes, kind="stable")
    vectors = np.empty_like(turned)
    vectors[order] = turned / np.sqrt(np.where(sizes > 0, sizes, 1))
    # The sign is the rows' to share: the largest entry of a component is positive.
    vectors = vectors[:, by_size]
    top = np.abs(vectors).argmax(axis=0)
    return sizes[by_size], vectors * np.sign(vectors[top, np.arange(len(top))])


class Whitening:
    """A fitted whitening: exact sums, centre, components and scales."""

    def __init__(self, n, sums, scatter, components=COMPONENTS):
        self.n, self.sums = n, [int(s) for s in sums]        # sums of floor(scale * c)
        dims = len(self.sums)
        self.centre = np.array([round(s / n) for s in self.sums], np.int64)
        self.offset = np.array([(s - n * int(m)) / n for s, m in zip(self.sums, self.centre)])
        # The scatter is around the whole centre; what is left of the mean is below one half.
        v = scatter.reshape(dims, dims) / n - np.outer(self.offset, self.offset)
        sizes, vectors = principal(v)
        self.components = vectors[:, :components]
        self.eigenvalues = sizes[:components]
        self.explained = self.eigenvalues / np.trace(v) if len(self.eigenvalues) else sizes
        self.basis = self.components / np.sqrt(self.eigenvalues)

    def centred(self, x):
        return (x - self.centre) - self.offset

    def whitened(self, x):
        return self.centred(x) @ self.basis

    def deviation(self, x):
        """Sum over dimensions of (n*x - S)^2, exact; None where it is beyond a long."""
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.centre)], object)
        y = x - self.centre
        reach = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
        if reach * reach * max(1, len(rest)) < 1 << 62:
            z = self.n * y - rest.astype(np.int64)
            return (z * z).sum(axis=1).tolist()
        z = self.n * y.astype(object) - rest
        return [d if d < 1 << 63 else None for d in (z * z).sum(axis=1)]


def _length(vectors: DataFrame):
    """The commonest length of vectors, the greater of equally common ones; None without any."""
    best = vectors.groupBy(F.size("embedding").alias("size")).count().filter("size > 0").orderBy(
        F.desc("count"), F.desc("size")).first()
    return best and best["size"]


def fit(rows: DataFrame, components=COMPONENTS):
    """The whitening of all usable vectors, or None without any; two passes over the vectors."""
    vectors = rows.filter(usable(rows)).select("embedding")
    dims = _length(vectors)
    if dims is None:
        return None
    vectors = vectors.filter(F.size("embedding") == dims)
    counted = _sum(vectors, dims, lambda x: np.append(len(x), x.sum(axis=0)), "bigint")
    n, sums = int(counted[0]), counted[1:]
    centre = np.array([round(int(s) / n) for s in sums], np.int64)

    def scatter(x):
        # Whole numbers: sums of products below 2^53 are exact in whatever order.
        y = (x - centre).astype(np.float64)
        return y.T @ y
    return Whitening(n, sums, _sum(vectors, dims, scatter, "double"), components)


def identity_error(rows: DataFrame, model: Whitening):
    """Largest entry of the whitened vectors' covariance minus the identity."""
    vectors = rows.filter(usable(rows)).select("embedding").filter(
        F.size("embedding") == len(model.sums))
    mean = _sum(vectors, len(model.sums), lambda x: model.whitened(x).sum(axis=0), "double") / model.n

    def products(x):
        y = model.whitened(x) - mean
        return y.T @ y
    cov = _sum(vectors, len(model.sums), products, "double") / model.n
    k = len(mean)
    return float(np.abs(cov.reshape(k, k) - np.eye(k)).max())


def _projected(model):
    def run(batches):
        import pyarrow as pa
        dims, k = len(model.sums), len(model.eigenvalues)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                x = whole(_matrix(part.column(1), dims))
                flat = pa.array(model.whitened(x).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.deviation(x), pa.int64()), lists],
                    ["vec_id", "deviation", "whitened"])
    return run


def whitened(rows: DataFrame, components=COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: one row for each
    usable vector and component.

    Vectors that are null, empty or hold null or non-finite entries are left out, and so are those
    of another length than the commonest. Components without variance do not exist, so equal
    vectors give no rows. Repeated rows and null vec_ids count and are returned each. Entries
    beyond 2^40 / 64 count as that. A deviation beyond a long is null. Other columns are ignored;
    an empty table gives an empty result.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    model = fit(rows, components)
    if model is None or not len(model.eigenvalues):
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
                "explained double, identity_error double")
    vectors = rows.filter(usable(rows)).filter(F.size("embedding") == len(model.sums))
    found = vectors.select("vec_id", "embedding").mapInArrow(
        _projected(model), f"vec_id {kind}, deviation bigint, whitened array<double>")
    error = identity_error(rows, model)
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return found.select("vec_id", "deviation", F.posexplode("whitened")).select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", F.col("col").alias("whitened"),
        F.get(explained, F.col("pos")).alias("explained"), F.lit(error).alias("identity_error"))
