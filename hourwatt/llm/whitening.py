"""Embedding whitening from variances alone: covariances by polarisation.

Components become whole numbers, ``floor(256 * c)``, so that every sum is exact. Over the distinct vectors
(the fit list) the squared centred value is summed for each dimension and for the sum of each pair of
dimensions; since Var(x + y) = Var(x) + Var(y) + 2 Cov(x, y), differences of these variances are the covariances. The
matrix is put together on the driver, which holds one number per pair of dimensions whatever the number of rows,
and its eigenvectors whiten all rows in one pass.

A row is left out if its vector is null, empty, or holds a null or a number that is not finite, or if its vector is
not as long as the commonest length of the fit list (the longer one, if two are equally common). Components
beyond 64 bits are held at the 64-bit limits; a ``deviation`` beyond 64 bits is null. Repeated rows count once in the
fit and keep a row each in the result, as do rows with a null id. Directions without variance (eigenvalues of 1e-12 of the largest or less)
are no components, so equal vectors, a single vector or an empty table give an empty result. Only the id and the
vector are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.common import Scratch

SCALE, COMPONENTS = 256, 4
ROWS, LIMB = 512, 26  # rows squared at once; bits of a limb: 512 products of 26-bit limbs fit 64 bits
_BASE = 10**30  # sums travel as two decimals
_TOTALS = "i int, j int, high decimal(38,0), low decimal(38,0)"


def whole_vectors(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with its usable vectors as whole numbers in ``x``; vectors of any length."""
    c = F.col(vector).cast("array<double>")
    usable = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return df.where(c.isNotNull() & (F.size(c) > 0) & usable).withColumn("x", F.transform(c, lambda e: F.floor(e * SCALE)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _totals(found: dict[tuple[int, int], int]) -> pa.RecordBatch:
    parts = [divmod(total, _BASE) for total in found.values()]
    kind = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in found], pa.int32()), pa.array([j for _, j in found], pa.int32()),
            pa.array([Decimal(high) for high, _ in parts], kind), pa.array([Decimal(low) for _, low in parts], kind),
        ],
        ["i", "j", "high", "low"],
    )


def _summed(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Exact totals by (i, j): a row per pair of dimensions reaches the driver."""
    sums = rows.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): int(r.high) * _BASE + int(r.low) for r in sums.collect()}


def sums(fit: DataFrame) -> dict[int, int]:
    """Exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in filter(len, batches):
            x = _matrix(batch.column(0))
            total = total or [0] * x.shape[1]
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + k for t, h, k in zip(total, high, low)]
        if total:
            yield _totals({(i, i): t for i, t in enumerate(total)})

    found = _summed(fit.select("x").mapInArrow(run, _TOTALS))
    return {i: total for (i, _), total in found.items()}


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``n * x - total``: 64-bit numbers if all and their pair sums fit limbs, else Python's."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, total)) if len(x) else 0
    if 2 * most < 1 << (2 * LIMB):
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def squares(z: np.ndarray) -> list[int]:
    """Exact sum of the squares of each column, of at most ``ROWS`` rows."""
    if z.dtype == object:
        return (z * z).sum(axis=0).tolist()
    high, low = z >> LIMB, z & ((1 << LIMB) - 1)
    parts = [np.einsum("rc,rc->c", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(hh << 2 * LIMB) + (hl << LIMB + 1) + ll for hh, hl, ll in zip(*parts)]


def squared_sums(fit: DataFrame, n: int, total: list[int]) -> dict[tuple[int, int], int]:
    """Sum of squared centred values: (i, i) of dimension i, (i, j) of the sum of dimensions i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = centred(_matrix(batch.column(0).slice(at, ROWS)), n, total)
                for i in range(y.shape[1]):
                    pairs = y[:, i + 1 :] + y[:, i : i + 1]
                    for j, q in enumerate(squares(np.concatenate([y[:, i : i + 1], pairs], axis=1)), i):
                        found[i, j] = found.get((i, j), 0) + q
        if found:
            yield _totals(found)

    return _summed(fit.select("x").mapInArrow(run, _TOTALS))


def covariance(found: dict[tuple[int, int], int], n: int, d: int) -> np.ndarray:
    """The covariance matrix, each entry rounded once."""
    v = np.zeros((d, d))
    for (i, j), q in found.items():
        exact = Fraction(q, n**3) if i == j else Fraction(q - found[i, i] - found[j, j], 2 * n**3)
        v[i, j] = v[j, i] = float(exact)
    return v


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns."""
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    keep = e[:most] > 1e-12 * max(e[0], 0.0)
    return e[:most][keep], w[:, :most][:, keep]


def whitened(df: DataFrame, ids: list[str], n: int, total: list[int], e: np.ndarray, w: np.ndarray) -> DataFrame:
    """``ids``, exact squared distance from the centre (times n squared), and the whitened components in ``w``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            y = centred(_matrix(batch.column("x")), n, total)
            if y.dtype == object or y.shape[1] * int(np.abs(y).max(initial=0)) ** 2 >= 2**63:
                far = [sum(int(a) * int(a) for a in row) for row in y]
                far = pa.array([f if f < 2**63 else None for f in far], pa.int64())
            else:
                far = pa.array(np.einsum("rc,rc->r", y, y), pa.int64())
            out = y.astype(float) / n @ w / np.sqrt(e)
            ends = np.arange(0, out.size + 1, len(e), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ids], far, lists], [*ids, "deviation", "w"])

    kinds = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in ids] + ["deviation long", "w array<double>"])
    return df.select(*ids, "x").mapInArrow(run, kinds)


def identity_error(fit: DataFrame, n: int, total: list[int], e: np.ndarray, w: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the data."""
    k = len(e)
    rows = whitened(fit, [], n, total, e, w).select(*[F.col("w")[a].alias(f"w{a}") for a in range(k)])
    cells = [F.covar_pop(f"w{a}", f"w{b}") - F.lit(float(a == b)) for a in range(k) for b in range(a, k)]
    return max(map(abs, rows.agg(*cells).first()))


def whitening(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and component."""
    scratch = Scratch(df.sparkSession, "whitening")
    rows = whole_vectors(df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")), "v")
    fit = scratch.keep(rows.select("x").distinct())
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    e = np.zeros(0)
    if best is not None:
        d, n = best
        fit = fit.where(F.size("x") == d)
        by_dimension = sums(fit)
        total = [by_dimension[i] for i in range(d)]
        v = covariance(squared_sums(fit, n, total), n, d)
        e, w = components(v, most)
    if not len(e):
        rows = rows.limit(0).select(
            "vec_id", F.lit(1).alias("component"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")],
        )
        return scratch.close(rows, "whitening-result")
    error = identity_error(fit, n, total, e, w)
    out = whitened(rows.where(F.size("x") == d), ["vec_id"], n, total, e, w)
    each = out.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    share = F.array(*[F.lit(float(x / np.trace(v))) for x in e])
    result = each.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("k")].alias("explained"), F.lit(error).alias("identity_error"),
    )
    return scratch.close(result, "whitening-result")
