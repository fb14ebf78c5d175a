"""Embedding whitening through the exact characteristic polynomial.

1. Every vector's entries become integers, y = floor(scale * c).  (x = y plus any
   fixed shift has the same deviations, covariance and components, so none is
   added.)  One pass sums y and its products in each task, exactly (products of
   limbs that a double holds, or Python integers), and Spark adds the partial sums
   as decimals.  The scatter n * sum(y y') - sum(y) sum(y)' is the sum of
   (n y - sum)(n y - sum)' over n, and n^2 times the covariance, to the last digit:
   as nothing is rounded, it is the centred product whatever the offset.
2. Its characteristic polynomial: for each of enough 31-bit primes a Spark task
   reduces the matrix to Hessenberg form modulo the prime and reads the
   polynomial off it; Chinese remaindering gives the integer coefficients.  The
   matrix is positive semidefinite, so (1 + trace/d)^d bounds them.
3. All roots are real, so Descartes' rule counts them exactly, with their
   multiplicity: the roots above t are the sign changes of the polynomial shifted
   by t.  Bisection on the counts isolates the greatest roots; signs of the
   polynomial at dyadic points, in integers, then narrow each to `BITS` bits.
   Roots that no such interval tells apart count as one with a multiplicity.
4. A component is the null space of (scatter - root): Gaussian elimination with
   row exchanges in integers of `BITS` bits behind the point, and inverse
   iteration; one Spark task for each distinct root.
5. A second pass projects the rows; the error of the whitened covariance is then
   measured on the rows written.

Only sums of d * d numbers, the polynomial and the components reach the driver,
whatever the number of rows.  The work of 2 to 4 depends on the dimension alone.

Defined cases: vectors that are null, empty or hold null or non-finite entries are
dropped; so are vectors of another length than the table's most frequent one
(ties: the greater).  A component has a positive eigenvalue, so a table with n
equal vectors, or an empty one, has no component and gives no row.  Equal
eigenvalues share their space: its basis is arbitrary, but the same for all rows.
A null id is carried as null, repeated rows stay and count as often as they occur.
Other columns are ignored.  Entries may be of any size that keeps the sums within
38 digits; beyond, the job fails and nothing is rounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

#: Bits behind the point in root narrowing and elimination.
BITS = 320
#: Integers of this size have products that a double adds up exactly in numbers.
EXACT = 1 << 53


# -- 1: exact sums -----------------------------------------------------------

def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of doubles) of the rows whose vector is whole."""
    v = F.col("v")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(v.isNotNull() & ~bad & (F.size(v) > 0)))


def _matrix(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """floor(scale * c) of a batch: int64, or Python integers if those are too small."""
    c = np.floor(batch["v"].flatten().to_numpy(zero_copy_only=False) * scale).reshape(batch.num_rows, -1)
    if np.abs(c).max(initial=0) < 1 << 62:
        return c.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(c)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a'b in Python integers, exactly: in limbs of 20 bits where one double
    product could round, and entry by entry where the limbs are too large too."""
    most = max(1, _top(a) * _top(b))
    if most < EXACT:
        rows, total = EXACT // most, np.zeros((a.shape[1], b.shape[1]), object)
        for at in range(0, len(a), rows):
            total += (a[at:at + rows].T.astype(float) @ b[at:at + rows].astype(float)).astype(np.int64).astype(object)
        return total
    if object not in (a.dtype, b.dtype) and max(_top(a), _top(b)) < 1 << 46:
        (a0, a1), (b0, b1) = ((x & 0xFFFFF, x >> 20) for x in (a, b))
        return products(a0, b0) + ((products(a0, b1) + products(a1, b0)) << 20) + (products(a1, b1) << 40)
    return a.astype(object).T.dot(b.astype(object))


def _top(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def _decimals(values) -> pa.Array:
    with localcontext() as c:
        c.prec = 60
        return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))


def _sums(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch, scale)
                n, total, square = n + len(y), total + products(y, np.ones((len(y), 1), np.int64))[:, 0], square + products(y, y)
        if n:
            d = len(total)
            i, j = np.triu_indices(d)
            yield pa.record_batch({"i": pa.array(np.r_[-1, np.full(d, -1), i].astype(np.int32)), "j": pa.array(np.r_[-1, np.arange(d), j].astype(np.int32)),
                                   "part": _decimals([n, *total, *square[i, j]])})
    return run


def scatter(vectors: DataFrame, scale: int) -> tuple[int, list[int], np.ndarray]:
    """n, sums of y = floor(scale * c), and n * sum(y y') - sum(y) sum(y)'."""
    cells = vectors.select("v").mapInArrow(_sums(scale), "i int, j int, part decimal(38,0)")
    got = {(r["i"], r["j"]): int(r["s"]) for r in cells.groupBy("i", "j").agg(F.sum("part").alias("s")).collect()}
    n = got.pop((-1, -1), 0)
    sums = [got[-1, j] for j in range(sum(i < 0 for i, _ in got))]
    m = np.zeros((len(sums), len(sums)), object)
    for (i, j), s in got.items():
        if i >= 0:
            m[i, j] = m[j, i] = n * s - sums[i] * sums[j]
    return n, sums, m


# -- 2: characteristic polynomial --------------------------------------------

def primes(count: int, below: int = 1 << 31) -> list[int]:
    """The greatest `count` primes below a bound, by sieving windows."""
    found, root = [], int(below ** 0.5) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for p in range(2, int(root ** 0.5) + 1):
        if sieve[p]:
            sieve[p * p::p] = False
    small = np.flatnonzero(sieve).tolist()
    while len(found) < count:
        low = max(2, below - (1 << 16))
        window = np.ones(below - low, bool)
        for p in small:
            if p * p >= below:
                break
            window[max(p * p, -(-low // p) * p) - low::p] = False
        found += (np.flatnonzero(window)[::-1] + low).tolist()
        below = low
    return found[:count]


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """det(t - matrix) modulo p, constant first: similar to a Hessenberg matrix,
    whose leading minors follow from each other."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(1, d - 1):
        pivots = np.flatnonzero(h[k:, k - 1])
        if not len(pivots):
            continue
        q = k + int(pivots[0])
        if q != k:
            h[[k, q]] = h[[q, k]]
            h[:, [k, q]] = h[:, [q, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factor[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factor % p).sum(1)) % p        # column k takes back what the rows gave
    minors = [np.array([1], np.int64)]
    for k in range(d):
        new = np.r_[0, minors[k]]
        new[:-1] = (new[:-1] - h[k, k] * minors[k]) % p
        chain = 1
        for j in range(k - 1, -1, -1):
            chain = chain * int(h[j + 1, j]) % p
            if not chain:
                break
            new[:j + 1] = (new[:j + 1] - chain * int(h[j, k]) % p * minors[j]) % p
        minors.append(new)
    return minors[d]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(t - matrix), constant first, of a positive
    semidefinite integer matrix."""
    d = len(matrix)
    bound = 2 * (1 + -(-int(np.trace(matrix)) // d)) ** d + 1      # twice the greatest coefficient
    moduli = primes(bound.bit_length() // 30 + 1)
    rows = matrix.tolist()

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.array(rows, object)
        for batch in batches:
            ps = batch["p"].to_pylist()
            yield pa.record_batch({"p": batch["p"], "c": pa.array([polynomial_mod(m, p) for p in ps], pa.list_(pa.int64()))})

    tasks = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    got = (spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks, "p")
           .mapInArrow(residues, "p long, c array<long>").collect())
    product = 1
    for p in moduli:
        product *= p
    total = [0] * (d + 1)
    for r in got:
        rest = product // r["p"]
        lift = rest * pow(rest, -1, r["p"])
        total = [(x + lift * c) % product for x, c in zip(total, r["c"])]
    return [x - product if 2 * x > product else x for x in total]


# -- 3: real roots -----------------------------------------------------------

def sign_changes(coefficients: list[int]) -> int:
    signs = [c > 0 for c in coefficients if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def roots_above(coefficients: list[int], at: int, bits: int) -> int:
    """How many roots, with multiplicity, exceed at / 2^bits; all roots are real."""
    d = len(coefficients) - 1
    c = [x << (bits * (d - k)) for k, x in enumerate(coefficients)]     # roots times 2^bits
    for k in range(d):                                                  # Taylor shift
        for j in range(d - 1, k - 1, -1):
            c[j] += at * c[j + 1]
    return sign_changes(c)


def value_sign(coefficients: list[int], at: int, bits: int) -> int:
    value, scale = 0, 0
    for x in reversed(coefficients):
        value, scale = value * at + (x << scale), scale + bits
    return (value > 0) - (value < 0)


def greatest_roots(coefficients: list[int], count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """The greatest positive roots as (root times 2^bits, multiplicity), falling,
    until `count` are named; each within 2^-bits."""
    positive = sign_changes(coefficients)
    count = min(count, positive)
    if not count:
        return []
    # a bound from the coefficients: 2 max |c_k|^(1/(d-k)), as a power of two
    d = len(coefficients) - 1
    top = 1 << (2 + max(-(-abs(c).bit_length() // (d - k)) for k, c in enumerate(coefficients[:-1]) if c))
    out, todo = [], [(0, top, 0, positive, 0)]         # low, high (times 2^-scale), roots above high, above low
    while todo and sum(m for _, m in out) < count:
        low, high, above_high, above_low, scale = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1 or (scale == bits and high - low == 1):
            out.append((_narrow(coefficients, low, high, scale, bits) if inside == 1 else high, inside))
            continue
        if high - low == 1:
            finer = min(8, bits - scale)
            low, high, scale = low << finer, high << finer, scale + finer
        middle = (low + high) // 2
        above = roots_above(coefficients, middle, scale)
        todo += [(low, middle, above, above_low, scale), (middle, high, above_high, above, scale)]      # the greater half first
    return out


def _narrow(coefficients: list[int], low: int, high: int, scale: int, bits: int) -> int:
    """The one root in (low, high]: bisection on the sign of the polynomial.
    Right of the root, up to the next, the sign is that at high (or high is the root)."""
    low, high, scale = low << (bits - scale), high << (bits - scale), bits
    right = value_sign(coefficients, high, scale)
    if not right:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        at = value_sign(coefficients, middle, scale)
        if not at:
            return middle
        low, high = (low, middle) if at == right else (middle, high)
    return high


# -- 4: components -----------------------------------------------------------

def null_space(matrix: np.ndarray, root: int, multiplicity: int, bits: int = BITS, steps: int = 3) -> np.ndarray:
    """Unit vectors (rows, doubles) that span the null space of matrix - root / 2^bits,
    by inverse iteration in integers with `bits` bits behind the point."""
    d, one = len(matrix), 1 << bits
    a = matrix * one
    for k in range(d):
        a[k, k] -= root
    lower, order = np.zeros((d, d), object), np.arange(d)
    for k in range(d):                                             # rows exchanged: the greatest pivot
        q = k + max(range(d - k), key=lambda x: abs(a[k + x, k]))
        if q != k:
            a[[k, q]], lower[[k, q]], order[[k, q]] = a[[q, k]], lower[[q, k]], order[[q, k]]
        if not a[k, k]:
            a[k, k] = 1                                            # exactly singular: the least number instead
        lower[k + 1:, k] = (a[k + 1:, k] << bits) // a[k, k]
        if k + 1 < d:
            a[k + 1:, k + 1:] -= (lower[k + 1:, k, None] * a[k, k + 1:]) >> bits
    found: list[np.ndarray] = []
    for m in range(multiplicity):
        x = np.array([one * ((k * (2 * m + 3) + 7 * m) % 11 - 5 or 1) for k in range(d)], object)
        for _ in range(steps):
            x = _solve(a, lower, x[order], bits)
            for y in found:                                        # apart from those found before
                x = x - ((y * (int((x * y).sum()) >> bits)) >> bits)
            x = _unit(x, bits)
        found.append(x)
    return np.array([[_double(v, bits) for v in x] for x in found]).reshape(multiplicity, d)


def _solve(upper: np.ndarray, lower: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    b, d = b.copy(), len(b)
    for k in range(d):
        b[k + 1:] -= (lower[k + 1:, k] * b[k]) >> bits
    for k in range(d - 1, -1, -1):
        b[k] = (int(b[k]) << bits) // int(upper[k, k])
        b[:k] -= (upper[:k, k] * b[k]) >> bits
    return b


def _unit(x: np.ndarray, bits: int) -> np.ndarray:
    length = isqrt(int((x * x).sum())) or 1
    return (x << bits) // length


def _double(x: int, bits: int) -> float:
    """x / 2^bits, rounded once."""
    return int(x) / (1 << bits)


def components(spark: SparkSession, matrix: np.ndarray, count: int, bits: int = BITS) -> tuple[list[int], np.ndarray]:
    """Roots times 2^bits, falling, and their unit vectors as rows."""
    roots = greatest_roots(characteristic(spark, matrix), count, bits)
    rows = matrix.tolist()

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.array(rows, object)
        for batch in batches:
            for r in batch.to_pylist():
                vectors = null_space(m, int(r["root"], 16), min(r["times"], count), bits)
                yield pa.record_batch({"k": pa.array([r["k"]], pa.int32()), "v": pa.array([vectors.tolist()], pa.list_(pa.list_(pa.float64())))})

    if not roots:
        return [], np.empty((0, len(matrix)))
    todo = spark.createDataFrame([(k, hex(root), times) for k, (root, times) in enumerate(roots)], "k int, root string, times int")
    got = {r["k"]: r["v"] for r in todo.repartition(len(roots), "k").mapInArrow(solved, "k int, v array<array<double>>").collect()}
    pairs = [(root, v) for k, (root, _) in enumerate(roots) for v in got[k]][:count]
    return [r for r, _ in pairs], np.array([v for _, v in pairs])


# -- 5: projection -----------------------------------------------------------

def _projected(scale: int, n: int, sums: list[int], axes: np.ndarray):
    """`axes`: components over the roots of their eigenvalues, a column for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.array([s // n for s in sums], object)
        part = np.array([s % n for s in sums], object)             # n * mean - n * base
        fraction = np.array([int(r) / n for r in part])
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch, scale)
            top = max(_top(y), max(abs(int(b)) for b in base), 1) * 2
            if y.dtype != object and (2 * n * top) ** 2 * len(sums) < 1 << 63:
                z = n * (y - base.astype(np.int64)) - part.astype(np.int64)
                deviation = (z * z).sum(1).tolist()
                centred = (y - base.astype(np.int64)).astype(float)
            else:
                off = y.astype(object) - base
                z = n * off - part
                deviation, centred = (z * z).sum(1), off.astype(float)
            w = (centred - fraction) @ axes
            yield pa.record_batch({"id": batch["id"], "deviation": _decimals(deviation), "w": pa.array(list(w), pa.list_(pa.float64()))})
    return run


def whiten(rows: DataFrame, count: int = 8, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained,
    identity_error: one row for each whole vector and component."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, id_col, vector_col)
    lengths = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(1)
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not lengths:
        return spark.createDataFrame([], schema)
    vectors = vectors.filter(F.size("v") == lengths[0]["d"])
    n, sums, m = scatter(vectors, scale)
    roots, axes = components(spark, m, count)
    if not roots:
        return spark.createDataFrame([], schema)
    # an eigenvalue of the covariance is root / (2^BITS * n^2)
    spread = np.array([_root(r, BITS) / n for r in roots])
    trace = int(np.trace(m))
    explained = [r / (trace << BITS) for r in roots]
    done = stage(vectors.mapInArrow(_projected(scale, n, sums, axes.T / spread), "id long, deviation decimal(38,0), w array<double>"), "whitened")
    places = range(len(roots))
    errors = [F.abs(F.covar_pop(_at(i), _at(j)) - float(i == j)) for i in places for j in places if i <= j]
    error = done.agg(F.greatest(*errors).alias("e") if len(errors) > 1 else errors[0].alias("e")).first()["e"]
    part = F.explode(F.arrays_zip(F.array(*(F.lit(k + 1) for k in places)).alias("component"), F.col("w").alias("whitened"),
                                  F.array(*map(F.lit, explained)).alias("explained"))).alias("c")
    return done.select("id", "deviation", part).select(
        F.col("id").alias("vec_id"), F.col("c.component").cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), F.lit(error).alias("identity_error"))


def _at(k: int) -> Column:
    return F.col("w")[k]


def _root(x: int, bits: int) -> float:
    """Square root of x / 2^bits, for numbers beyond a double's range too."""
    return isqrt(x << (256 + bits % 2)) / (1 << (128 + (bits + 1) // 2))
