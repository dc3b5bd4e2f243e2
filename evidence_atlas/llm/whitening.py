"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, stored

#: How an entry becomes an integer.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this are held there, so that they stay exact in a double.
LARGEST = 2.0**53
#: Vectors packed into one row of the stored fit list.
BLOCK = 2048
#: Tasks whose sums the driver adds up itself.
FEW = 64
#: A direction shorter than this share of the largest one counts as none.
TINY = 1e-12


@dataclass
class Whitening:
    """The fitted model: n and S of the fit list, components (rows), their deviations (roots of e) and trace(V)."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray
    trace: float


def integers(vector: str) -> Column:
    """floor(64 c) + 1000000 of every entry; null unless all entries are finite numbers."""
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when(F.coalesce(whole, F.lit(False)), F.transform(vector, lambda c: held(c).cast("long") + SHIFT))


def pack_distinct(vectors: DataFrame, x: str = "x") -> DataFrame:
    """(rows, data): each distinct vector once, BLOCK of them in one binary of doubles."""

    def pack(batches):
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = np.array(batch[x].iloc[at : at + BLOCK].tolist(), np.float64)
                yield pd.DataFrame({"rows": [len(part)], "data": [part.tobytes()]})

    return vectors.select(x).distinct().mapInPandas(pack, "rows long, data binary")


def _summed(blocks: DataFrame, f, kind=np.float64) -> np.ndarray | None:
    """f(block), an array of numbers, summed over all blocks.

    Each task sends one array. The arrays of more than FEW tasks are summed
    by as many tasks as the root of their number, so that the driver sums at
    most about that many.
    """

    def part(batches):
        total = None
        for batch in batches:
            for rows, data in zip(batch["rows"], batch["data"], strict=True):
                got = f(np.frombuffer(data).reshape(rows, -1))
                total = got if total is None else total + got
        if total is not None:
            yield pd.DataFrame({"data": [np.asarray(total, kind).tobytes()]})

    def join(batches):
        total = sum(np.frombuffer(d, kind) for batch in batches for d in batch["data"])
        if not isinstance(total, int):
            yield pd.DataFrame({"data": [total.tobytes()]})

    partial = blocks.mapInPandas(part, "data binary")
    if blocks.tasks > FEW:
        partial = partial.repartition(math.isqrt(blocks.tasks)).mapInPandas(join, "data binary")
    arrays = [np.frombuffer(r.data, kind) for r in partial.collect()]
    return np.sum(arrays, axis=0) if arrays else None


def exact_sums(blocks: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and whole-number sums by dimension."""
    total = _summed(blocks, lambda x: np.append(x.astype(np.int64).sum(axis=0), len(x)), np.int64)
    return (0, []) if total is None else (int(total[-1]), [int(s) for s in total[:-1]])


def bidiagonalise(blocks: DataFrame, n: int, sums: list[int], steps: int | None = None, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (columns) and the small matrix B with X V = U B, for the centred rows X of ``blocks``.

    Each step sends v to the rows and takes back, in one pass, what it needs
    of u = X v: its products with all earlier u, its length and X'u. A left
    vector is never stored: u_j = X w_j, and the few w_j travel with v. After
    a step that lost length (less than half is left) the new u goes through
    the rows once more, so left vectors stay orthogonal; right vectors are
    made orthogonal twice on the driver. An exhausted direction is followed
    by a fresh one orthogonal to all before, so that ties of deviations and
    ranks below the dimension are no obstacle. The driver holds a few arrays
    of dims x dims numbers whatever the number of rows.
    """
    dims = len(sums)
    count = min(steps or dims, dims)
    mean = np.array(sums, object)
    V, W, Z = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    B = np.zeros((count, count))
    rng = np.random.default_rng(seed)

    def apart(v):
        for _ in range(2):
            v = v - V @ (V.T @ v)
        return v

    def passed(w, before):
        """[U'u, u'u, X'u] of u = X w."""
        m = before.shape[1]

        def f(x):
            c = (n * x - np.array(mean, np.float64)) / n if n * np.abs(x).max(initial=0.0) < 2**53 else x - np.array(mean / n, np.float64)
            u = c @ w
            return np.concatenate([(c @ before).T @ u, [u @ u], c.T @ u])

        got = _summed(blocks, f)
        return got[:m], float(got[m]), got[m + 1 :]

    v, largest = apart(rng.standard_normal(dims)), 0.0
    column = []  # the step of each left vector
    for k in range(count):
        v = v / np.linalg.norm(v)
        V = np.column_stack([V, v])
        along, square, back = passed(v, W)
        left = square - float(along @ along)
        w, z = v - W @ along, back - Z @ along
        scale = np.sqrt(max(square, 0.0))
        largest = max(largest, scale)
        for j, a in zip(column, along, strict=True):
            B[j, k] = a
        alpha = np.sqrt(max(left, 0.0))
        if left < 0.25 * square and alpha > TINY * max(largest, 1e-300):
            more, square, back = passed(w, W)
            w, z = w - W @ more, back - Z @ more
            alpha = np.sqrt(max(square - float(more @ more), 0.0))
        fresh = True
        if alpha > TINY * max(largest, 1e-300) and largest > 0:
            B[k, k] = alpha
            w, z = w / alpha, z / alpha
            W, Z, column = np.column_stack([W, w]), np.column_stack([Z, z]), [*column, k]
            v = apart(z)
            fresh = np.linalg.norm(v) <= TINY * largest
        if fresh and k + 1 < count:
            v = apart(rng.standard_normal(dims))
    return V, B


def fit_whitening(vectors: DataFrame, x: str = "x", components: int = 16, steps: int | None = None) -> tuple[Whitening | None, float]:
    """The model of a column of whole-number vectors of one length, and identity_error measured on its fit list.

    ``steps`` below the dimension save passes at the price of accuracy.
    """
    blocks = stored(pack_distinct(vectors, x), "fit")
    blocks.tasks = blocks.rdd.getNumPartitions()
    n, sums = exact_sums(blocks)
    if not sums:
        release(blocks)
        return None, 0.0
    V, B = bidiagonalise(blocks, n, sums, steps)
    _, deviations, right = np.linalg.svd(B)
    found = (V @ right.T).T[:components]
    sd = deviations[:components] / np.sqrt(n)
    sd[sd <= TINY * max(float(sd.max(initial=0.0)), 1e-300)] = 0.0
    centre, safe = np.array([s / n for s in sums]), np.where(sd > 0, sd, 1.0)

    def moments(b):
        c = b - centre
        y = (c @ found.T) / safe
        return np.concatenate([[np.square(c).sum()], (y.T @ y).ravel()])

    got = _summed(blocks, moments) / n
    real = np.nonzero(sd > 0)[0]
    miss = np.abs(got[1:].reshape(len(found), -1) - np.eye(len(found)))[np.ix_(real, real)]
    release(blocks)
    return Whitening(n, sums, found, sd, float(got[0])), float(miss.max(initial=0.0))


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = 16, steps: int | None = None) -> DataFrame:
    """``vectors`` with n, deviation, whitened (array<double>), explained (array<double>) and identity_error.

    Rows whose vector is null or holds null or non-finite entries go, and so
    do vectors of another length than most have (the longest of equally
    common lengths). The model is fitted on each distinct vector once.
    Repeated rows keep their number; columns of the made names are replaced.
    A component without deviation (vectors in fewer dimensions, or a single
    vector) has null in whitened and 0 in explained (null if nothing
    deviates at all); a deviation beyond 63 bits is null. Tables without
    any vector give no rows.
    """
    made = ["n", "deviation", "whitened", "explained", "identity_error"]
    own = [c for c in vectors.columns if c not in (*made, "_x")]
    rows = vectors.select(*[F.col(f"`{c}`") for c in own], integers(vector).alias("_x")).where("_x is not null")
    common = rows.groupBy(F.size("_x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    model, miss = (None, 0.0) if not common else fit_whitening(rows.where(F.size("_x") == common[0].dims), "_x", components, steps)
    if model is None:
        kinds = "long long array<double> array<double> double".split()
        return rows.where("false").drop("_x").withColumns({c: F.lit(None).cast(k) for c, k in zip(made, kinds, strict=True)})
    n, centre = model.n, [int(s) for s in model.sums]
    axes, sd = model.components.T, model.deviations

    @F.pandas_udf("array<double>")
    def projected(x: pd.Series) -> pd.Series:
        whole = np.array(x.tolist(), object) * n - np.array(centre, object) if n > 2**32 else np.array(x.tolist(), np.int64) * n - np.array(centre, np.int64)
        y = (whole.astype(np.float64) / n) @ axes
        return pd.Series([[v / s if s > 0 else None for v, s in zip(r, sd.tolist(), strict=True)] for r in y.tolist()])

    gap = F.zip_with("_x", F.array(*[F.lit(s).cast("long") for s in centre]), lambda a, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), a), s))
    deviation = F.aggregate(F.transform(gap, lambda d: F.try_multiply(d, d)), F.lit(0).cast("long"), lambda a, d: F.try_add(a, d))
    share = [float(s * s / model.trace) if model.trace > 0 else None for s in sd]
    out = rows.where(F.size("_x") == len(centre)).withColumns({"n": F.lit(n).cast("long"), "deviation": deviation, "whitened": projected("_x"), "explained": F.array(*[F.lit(s).cast("double") for s in share]), "identity_error": F.lit(miss)})
    return out.select(*own, *made)


def op13_whiten(spark, sf_dir):
    """Every vector on the first sixteen components."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    each = whiten(rows).select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("pos", "c"))
    return each.select("vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
