"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter n * sum(y y') - s s' is an exact integer
matrix. Its characteristic polynomial is computed modulo many primes (Hessenberg
form, one Spark task per group of primes) and put together by Chinese remaindering.
All its roots are real, so the sign changes of its Taylor shift count the roots
above a point exactly, with multiplicity; bisection isolates the largest ones to far
below double precision. A component is the null vector of scatter - root, found by
inverse iteration in high-precision decimals, one Spark task per root.

The driver holds numbers of the order of dimensions squared, never of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.common import written

#: Units of one in which entries are counted, and what is added to each count.
UNITS = 1024
SHIFT = 100_000
#: Entries in units are clipped here; finite doubles beyond have no 64-bit form.
CLIP = 2 ** 62
#: Entries below this in size, in strips of so many rows, multiply exactly in doubles.
SMALL = 2 ** 20
STRIP = 4096
#: Sums leave a task as base-2**40 digits, so that adding them up cannot overflow.
DIGIT = 40
DIGITS = 4
#: Bits to which roots are isolated, and decimal digits of the inverse iteration.
ROOT_BITS = 200
PRECISION = 100


@dataclass(frozen=True)
class Whitener:
    """n vectors of sums ``sums`` (units, unshifted); per component the root of the
    integer scatter and a unit vector; ``trace`` of the integer scatter."""

    n: int
    sums: list[int]
    roots: list[float]
    explained: list[float]
    vectors: np.ndarray


# --- exact sums ---------------------------------------------------------------

def units(column: pa.Array) -> np.ndarray:
    """Rows of entries in whole units, as longs, from an Arrow list column without nulls."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.clip(np.floor(UNITS * flat), -CLIP, CLIP).astype(np.int64).reshape(len(column), -1)


def products(y: np.ndarray) -> np.ndarray:
    """Exact y'y as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    small = len(y) == 0 or int(np.abs(y).max(initial=0)) < SMALL
    for at in range(0, len(y), STRIP):
        strip = y[at:at + STRIP]
        total += (strip.astype(np.float64).T @ strip.astype(np.float64)).astype(np.int64).astype(object) if small else strip.astype(object).T @ strip.astype(object)
    return total


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    n, first, second = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for batch in batches:
        y = units(batch.column(0))
        n += len(y)
        first += y.astype(object).sum(axis=0) if len(y) else 0
        second += products(y)
    i, j = np.triu_indices(dims)
    values = [n, *first.tolist(), *second[i, j].tolist()]
    digits = [pa.array([v >> (DIGIT * k) if k == DIGITS - 1 else (v >> (DIGIT * k)) & (2 ** DIGIT - 1) for v in values], pa.int64()) for k in range(DIGITS)]
    yield pa.RecordBatch.from_arrays([pa.array([-1, *[-1] * dims, *i.tolist()], pa.int32()), pa.array([-1, *range(dims), *j.tolist()], pa.int32()), *digits],
                                     names=["i", "j", *[f"d{k}" for k in range(DIGITS)]])


def scatter(vectors: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and exact integer scatter of the array column ``embedding``."""
    schema = "i int, j int, " + ", ".join(f"d{k} long" for k in range(DIGITS))
    parts = vectors.select("embedding").mapInArrow(lambda batches: _sums(batches, dims), schema)
    rows = parts.groupBy("i", "j").agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(DIGITS)]).collect()
    total = {(r["i"], r["j"]): sum(r[f"d{k}"] << (DIGIT * k) for k in range(DIGITS)) for r in rows}
    n = sum(v for (i, j), v in total.items() if (i, j) == (-1, -1))
    sums, matrix = [0] * dims, np.zeros((dims, dims), object)
    for (i, j), v in total.items():
        if i >= 0:
            matrix[i, j] = matrix[j, i] = v
        elif j >= 0:
            sums[j] = v
    return n, sums, matrix


# --- characteristic polynomial --------------------------------------------------

def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (at most 2**31), by Miller-Rabin."""
    def prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        # the bases 2, 3, 5 and 7 decide below 3,215,031,751
        return all(pow(a, odd, p) == 1 or any(pow(a, odd << k, p) == p - 1 for k in range(twos)) for a in (2, 3, 5, 7))

    found, p = [], top - 1 - top % 2
    while len(found) < count:
        if prime(p):
            found.append(p)
        p -= 2
    return found


def polynomial_mod(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo each prime, lowest power first."""
    m, p = len(matrix), np.array(primes, np.int64)[:, None]
    a = np.stack([(matrix % q).astype(np.int64) for q in primes])
    every = np.arange(len(primes))
    for k in range(1, m - 1):
        # a row with an entry to eliminate with comes to place k, with its column
        pivot = k + (a[:, k:, k - 1] != 0).argmax(axis=1)
        a[every, k], a[every, pivot] = a[every, pivot], a[every, k]
        a[every, :, k], a[every, :, pivot] = a[every, :, pivot], a[every, :, k]
        inverse = np.array([pow(int(x), -1, q) if x else 0 for x, q in zip(a[:, k, k - 1], primes, strict=True)], np.int64)[:, None]
        factor = a[:, k + 1:, k - 1] * inverse % p
        a[:, k + 1:] = (a[:, k + 1:] - factor[:, :, None] * a[:, None, k]) % p[:, :, None]
        a[:, :, k] = (a[:, :, k] + (a[:, :, k + 1:] * factor[:, None] % p[:, :, None]).sum(axis=2)) % p
    poly = np.zeros((m + 1, len(primes), m + 1), np.int64)
    poly[0, :, 0] = 1
    for k in range(1, m + 1):
        poly[k, :, 1:] = poly[k - 1, :, :-1]
        poly[k] = (poly[k] - a[:, k - 1, k - 1, None] * poly[k - 1]) % p
        below = np.ones(len(primes), np.int64)
        for i in range(1, k):
            below = below * a[:, k - i, k - i - 1] % p[:, 0]
            if not below.any():
                break
            poly[k] = (poly[k] - (a[:, k - 1 - i, k - 1] * below % p[:, 0])[:, None] * poly[k - 1 - i]) % p
    return poly[m]


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(x - matrix) of a symmetric non-negative definite integer
    matrix, lowest power first. Its coefficients are at most (1 + trace / m)**m."""
    m = len(matrix)
    trace = int(sum(matrix[i, i] for i in range(m)))
    count = int(m * math.log2(2 + trace // m) + 2) // 30 + 2
    primes = primes_below(2 ** 31, count)
    group = max(1, min(32, (32 << 20) // (24 * m * m)))

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, group):
                some = batch.column(0).slice(at, group)
                found = polynomial_mod(matrix, some.to_pylist())
                yield pa.RecordBatch.from_arrays([some, pa.array(found.tolist(), pa.list_(pa.int64()))], names=["prime", "residues"])

    tasks = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(count, max(1, count // 16)))
    found = {r["prime"]: r["residues"] for r in tasks.mapInArrow(residues, "prime long, residues array<long>").collect()}
    value, modulus = np.zeros(m + 1, object), 1
    for p in primes:
        step = (np.array(found[p], object) - value) * pow(modulus, -1, p) % p
        value, modulus = value + step * modulus, modulus * p
    return [int(v) - modulus if 2 * v > modulus else int(v) for v in value]


# --- roots ----------------------------------------------------------------------

def roots_above(poly: list[int], x: int) -> int:
    """Roots above ``x``, with multiplicity: the sign changes of the coefficients of
    poly(x + t), exact since all roots are real (Descartes)."""
    a = list(poly)
    for i in range(len(a) - 1):
        for j in range(len(a) - 2, i - 1, -1):
            a[j] += x * a[j + 1]
    signs = [c > 0 for c in a if c]
    return sum(p != q for p, q in zip(signs, signs[1:], strict=False))


def largest_roots(poly: list[int], most: int) -> tuple[int, list[tuple[int, int]]]:
    """(s, [(root times 2**s, multiplicity)]): the positive roots from the largest down,
    until ``most`` are counted. Roots that agree in ROOT_BITS bits count as one."""
    m, bound = len(poly) - 1, -poly[-2] + 1
    s = max(0, ROOT_BITS - bound.bit_length())
    scaled = [c << (s * (m - k)) for k, c in enumerate(poly)]

    def sign(x: int) -> int:
        value = 0
        for c in reversed(scaled):
            value = value * x + c
        return (value > 0) - (value < 0)

    found: list[tuple[int, int]] = []
    counted = 0
    # the roots in (low, high], of which ``above`` lie over high and ``total`` over low
    todo = [(0, bound << s, 0, roots_above(scaled, 0))]
    while todo and counted < most:
        low, high, above, total = todo.pop()
        if total == above:
            continue
        if total - above == 1:
            side = sign(high)
            while high - low > 1 and side:
                middle = (low + high) // 2
                at = sign(middle)
                low, high = (low, middle) if at in (0, side) else (middle, high)
                side = at if at in (0, side) else side
        if high - low <= 1:
            found.append((high, total - above))
            counted += total - above
            continue
        if total - above > 1:
            middle = (low + high) // 2
            split = roots_above(scaled, middle)
            todo += [(low, middle, split, total), (middle, high, above, split)]
        else:
            todo.append((low, high, above, total))
    return s, found


# --- components -------------------------------------------------------------------

def null_vectors(matrix: np.ndarray, root: Decimal, count: int) -> np.ndarray:
    """``count`` orthonormal vectors of the null space of matrix - root, by inverse
    iteration in PRECISION decimal digits. Call within a context of that precision."""
    m = len(matrix)
    a = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
    size = max(abs(v) for v in a.ravel()) or Decimal(1)
    a = (a - root * np.array([[Decimal(int(i == j)) for j in range(m)] for i in range(m)], object)) / size
    order = list(range(m))
    for k in range(m):
        best = k + int(np.abs(a[k:, k]).argmax())
        a[[k, best]] = a[[best, k]]
        order[k], order[best] = order[best], order[k]
        if not a[k, k]:
            a[k, k] = Decimal(10) ** (10 - PRECISION)
        a[k + 1:, k] = a[k + 1:, k] / a[k, k]
        a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - np.outer(a[k + 1:, k], a[k, k + 1:])
    # starts that no vector of the null space is orthogonal to: fixed irregular numbers
    x = np.array([[Decimal((i + 1) * (i + 1) * (7 * c + 3) % 1009 + c + 1) for c in range(count)] for i in range(m)], object)
    for _ in range(3):
        x = x[order]
        for k in range(m):
            x[k] = x[k] - a[k, :k] @ x[:k] if k else x[k]
        for k in range(m - 1, -1, -1):
            x[k] = (x[k] - a[k, k + 1:] @ x[k + 1:] if k < m - 1 else x[k]) / a[k, k]
        for c in range(count):
            x[:, c] = x[:, c] / max(abs(v) for v in x[:, c])
            for _ in range(2):
                for b in range(c):
                    x[:, c] = x[:, c] - x[:, b] * (x[:, b] @ x[:, c])
                x[:, c] = x[:, c] / (x[:, c] @ x[:, c]).sqrt()
    return x


def components(spark, matrix: np.ndarray, s: int, roots: list[tuple[int, int]], most: int) -> np.ndarray:
    """Unit vectors of the ``most`` largest roots, one row each; each root is a task."""
    m = len(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, root, count in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                with localcontext() as ctx:
                    ctx.prec = PRECISION
                    x = null_vectors(matrix, Decimal(int(root)) / Decimal(2 ** s), count)
                vectors = x.astype(np.float64).T
                yield pa.RecordBatch.from_arrays([pa.array(range(first, first + count), pa.int32()), pa.array(vectors.tolist(), pa.list_(pa.float64()))], names=["place", "vector"])

    firsts = np.cumsum([0, *[c for _, c in roots]]).tolist()
    tasks = spark.createDataFrame([(f, str(r), c) for f, (r, c) in zip(firsts, roots, strict=False)], "first int, root string, n int").repartition(max(1, len(roots)))
    found = {r["place"]: r["vector"] for r in tasks.mapInArrow(solve, "place int, vector array<double>").collect()}
    return np.array([found[k] for k in range(min(most, len(found)))], np.float64).reshape(-1, m)


# --- operator -----------------------------------------------------------------------

def usable(df: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that can be whitened."""
    v = F.col("embedding")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select("vec_id", v).where(v.isNotNull() & (F.size(v) > 0) & good)


def fit(vectors: DataFrame, dims: int, most: int) -> Whitener:
    """The whitening of all ``vectors``, each of ``dims`` entries."""
    spark = vectors.sparkSession
    n, sums, second = scatter(vectors, dims)
    sums_ = np.array(sums, object)
    matrix = n * second - np.outer(sums_, sums_)
    trace = int(sum(matrix[i, i] for i in range(dims)))
    if not trace:
        return Whitener(n, sums, [], [], np.zeros((0, dims)))
    s, roots = largest_roots(characteristic_polynomial(spark, matrix), most)
    each = [r for r, count in roots for _ in range(count)][:most]
    return Whitener(n, sums, [r / 2 ** s for r in each], [r / (trace << s) for r in each], components(spark, matrix, s, roots, most))


def project(vectors: DataFrame, model: Whitener) -> DataFrame:
    """vec_id, deviation, and ``whitened``: one entry per component."""
    kind = vectors.schema["vec_id"].dataType
    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    n, sums = model.n, np.array(model.sums, object)
    basis = (model.vectors / np.sqrt(np.array(model.roots))[:, None]).T if model.roots else np.zeros((len(sums), 0))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = units(batch.column(1))
            reach = n * int(np.abs(y).max()) + int(np.abs(sums).max())
            if reach * reach * y.shape[1] < 2 ** 63:
                centred = n * y - sums.astype(np.int64)
                deviation = (centred * centred).sum(axis=1).tolist()
            else:
                centred = n * y.astype(object) - sums
                deviation = [d if d < 2 ** 63 else None for d in (centred * centred).sum(axis=1)]
            whitened = centred.astype(np.float64) @ basis
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), pa.array(whitened.tolist(), pa.list_(pa.float64()))], names=schema.names)

    return vectors.mapInArrow(apply, schema)


def whiten(df: DataFrame, most: int = 8) -> DataFrame:
    """Whiten the array column ``embedding`` of ``df`` on its ``most`` largest components.

    Rows whose vector is NULL, empty or holds NULL or non-finite entries take no part;
    a vector shorter than the longest one lacks entries, which counts as NULL. All
    others are fitted on. An entry c counts as x = floor(1024 * c) + 100000 (counts
    beyond 2**62 are clipped). One row per vector and component: vec_id, component
    (from 1, by falling eigenvalue), n, deviation (the exact sum over dimensions of
    (n * x - S)**2; NULL where it exceeds a long), whitened, explained (share of the
    trace) and identity_error (largest absolute entry of the covariance of all whitened
    rows minus the identity).

    Components of eigenvalue 0 can't be whitened and are left out, so equal vectors, a
    single vector or an empty table give no rows. Equal eigenvalues get orthonormal
    components of their space. Repeated rows count each by itself, as do rows with a
    NULL vec_id. Only vec_id and embedding are read, so other columns can't clash.
    """
    spark = df.sparkSession
    vectors = usable(df)
    dims = vectors.agg(F.max(F.size("embedding")).alias("d")).first()["d"] or 0
    vectors = vectors.where(F.size("embedding") == dims)
    model = fit(vectors, dims, min(most, dims)) if dims else Whitener(0, [], [], [], np.zeros((0, 0)))
    if not model.roots:
        kind = df.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = written(project(vectors, model), "whitened")
    k = len(model.roots)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = rows.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.array(*[F.lit(float(e)) for e in model.explained])[F.col("place")].alias("explained"), F.lit(float(error)).alias("identity_error")))
