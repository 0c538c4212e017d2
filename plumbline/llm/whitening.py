"""Whitening by an exact characteristic polynomial.

Spark sums the integer scatter matrix n * sum(x x') - sum(x) sum(x)' exactly. Its characteristic
polynomial is worked out modulo many primes (reduction to Hessenberg form, a task per few
primes) and put together by Chinese remaindering. All its roots are real, so the sign changes of
the shifted polynomial count the roots above a point exactly, multiple ones included; that
isolates the largest eigenvalues, and halving refines them to ``BITS`` bits. Components come
from inverse iteration on the nearly singular shifted matrix in integers of fixed point, several
at once where an eigenvalue is multiple.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import lean, written
from plumbline.llm.vectors import matrices, scaled

#: Scale and shift of the entries; components returned at most.
SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Scaled entries are held to this, so that sums of products fit 38 digits.
HELD = 1 << 40
#: Bits of an eigenvalue behind the trace's first; further bits that inverse iteration works with.
BITS, SPARE = 192, 96
#: Primes of a task.
PRIMES = 16


# -------------------------------------------------------------------- scatter
def _products(y: np.ndarray) -> np.ndarray:
    """y'y as exact integers."""
    size = y.shape[1]
    most = int(np.abs(y).max(initial=0))
    step = (1 << 53) // max(1, most * most)
    total = np.zeros((size, size), dtype=object)
    if step >= 64:
        f = y.astype(np.float64)
        for at in range(0, len(y), step):
            total += (f[at:at + step].T @ f[at:at + step]).astype(np.int64)
        return total
    # Halves of 21 bits, whose products are exact in doubles.
    high, low = (y >> 21).astype(np.float64), (y & ((1 << 21) - 1)).astype(np.float64)
    for at in range(0, len(y), 1024):
        h, l = high[at:at + 1024], low[at:at + 1024]
        hh, hl, ll = ((a.T @ b).astype(np.int64).astype(object) for a, b in ((h, h), (h, l), (l, l)))
        total += (hh << 42) + ((hl + hl.T) << 21) + ll
    return total


MOMENTS = "size int, i int, j int, total decimal(38,0)"


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (i = -2), sums (i = -1) and products (i <= j) of a task's vectors, by length."""
    held: dict[int, list] = {}
    for batch in batches:
        for at, rows in matrices(batch.column(0)):
            y = scaled(rows, SCALE, HELD)
            own = held.setdefault(y.shape[1], [0, np.zeros(y.shape[1], dtype=object), np.zeros((y.shape[1],) * 2, dtype=object)])
            own[0] += len(y)
            own[1] = own[1] + y.sum(axis=0)
            own[2] = own[2] + _products(y)
    for size, (n, sums, products) in held.items():
        i, j = np.triu_indices(size)
        i, j = np.concatenate([[-2], np.full(size, -1), i]), np.concatenate([[0], np.arange(size), j])
        total = [n, *sums, *products[np.triu_indices(size)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), size, dtype=np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], names=["size", "i", "j", "total"])


def scatter(table: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, matrix) of the fit list: n * sum(y y') - sum(y) sum(y)', with y = floor(SCALE * c).

    The matrix does not depend on a shift of the entries. Of vectors of several lengths those
    of the most frequent one make up the fit list, the longer of equally frequent ones.
    """
    sums = table.select(F.col("embedding").cast("array<double>")).mapInArrow(lean(_moments), MOMENTS)
    sums = written(sums.groupBy("size", "i", "j").agg(F.sum("total").alias("total")), "moments")
    best = sums.where("i = -2").orderBy(F.desc("total"), F.desc("size")).limit(1).collect()
    if not best:
        return 0, [], np.zeros((0, 0), dtype=object)
    size, n = best[0]["size"], int(best[0]["total"])
    total, products = [0] * size, np.zeros((size, size), dtype=object)
    # The square of the vectors' length, whatever the number of rows.
    for r in sums.where((F.col("size") == size) & (F.col("i") > -2)).collect():
        if r["i"] < 0:
            total[r["j"]] = int(r["total"])
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = int(r["total"])
    s = np.array(total, dtype=object)
    return n, total, n * products - np.outer(s, s)


# -------------------------------------------------------------------- polynomial
def _is_prime(n: int) -> bool:
    # These bases decide primality below 3,215,031,751.
    if any(n % b == 0 for b in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """Primes below 2**31, largest first, whose product has more than ``bits`` bits."""
    out, n, product = [], (1 << 31) - 1, 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.array([pow(int(a), -1, int(q)) for a, q in zip(x, p)], dtype=np.int64)


def characteristic_modulo(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Characteristic polynomials of h[k] modulo p[k], lowest coefficient first.

    Similarity transforms make each matrix Hessenberg, then its leading minors follow by recurrence.
    """
    k, size = h.shape[:2]
    h, q = h.copy(), p[:, None]
    rows = np.arange(k)
    for c in range(size - 2):
        # A row with an entry below the subdiagonal is swapped up, columns alike.
        pivot = c + 1 + (h[:, c + 1:, c] != 0).argmax(axis=1)
        h[rows, pivot], h[:, c + 1] = h[:, c + 1].copy(), h[rows, pivot].copy()
        h[rows, :, pivot], h[:, :, c + 1] = h[:, :, c + 1].copy(), h[rows, :, pivot].copy()
        top = h[:, c + 1, c]
        factor = h[:, c + 2:, c] * _inverse(np.where(top == 0, 1, top), p)[:, None] % q
        h[:, c + 2:] = (h[:, c + 2:] - factor[:, :, None] * h[:, None, c + 1] % q[:, :, None]) % q[:, :, None]
        added = np.zeros((k, size), dtype=np.int64)
        for i in range(factor.shape[1]):
            added = (added + h[:, :, c + 2 + i] * factor[:, i, None]) % q
        h[:, :, c + 1] = (h[:, :, c + 1] + added) % q
    poly = np.zeros((size + 1, k, size + 1), dtype=np.int64)
    poly[0, :, 0] = 1
    for m in range(1, size + 1):
        now = np.zeros((k, size + 1), dtype=np.int64)
        now[:, 1:] = poly[m - 1, :, :-1]
        now = (now - h[:, m - 1, m - 1, None] * poly[m - 1]) % q
        chain = np.ones(k, dtype=np.int64)
        for i in range(1, m):
            chain = chain * h[:, m - i, m - i - 1] % p
            now = (now - (h[:, m - i - 1, m - 1] * chain % p)[:, None] * poly[m - i - 1]) % q
        poly[m] = now
    return poly[size]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(t - matrix), lowest first, of a symmetric matrix without negative eigenvalues."""
    size = len(matrix)
    trace = max(1, int(sum(matrix[i, i] for i in range(size))))
    # All coefficients together are at most (1 + trace / size)**size; one bit is for the sign.
    bits = size * (trace // size + 2).bit_length() + 2
    primes = primes_for(bits)
    held = spark.sparkContext.broadcast(matrix)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PRIMES):
                p = np.asarray(batch.column(0).slice(at, PRIMES), dtype=np.int64)
                poly = characteristic_modulo(np.array([(held.value % int(q)).astype(np.int64) for q in p]), p)
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(poly.tolist(), pa.list_(pa.int64()))], names=["prime", "poly"])

    own = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(-(-len(primes) // PRIMES))
    # size + 1 numbers for each prime, whatever the number of rows.
    found = own.mapInArrow(lean(run), "prime long, poly array<long>").collect()
    product = 1
    for p in primes:
        product *= p
    out = [0] * (size + 1)
    for r in found:
        rest = product // r["prime"]
        weight = rest * pow(rest, -1, r["prime"])
        for i, c in enumerate(r["poly"]):
            out[i] += c * weight
    out = [c % product for c in out]
    return [c - product if 2 * c > product else c for c in out]


# -------------------------------------------------------------------- roots
def roots_above(poly: list[int], point: int) -> int:
    """Roots above an integer, with multiplicity, of a polynomial all of whose roots are real."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], point: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * point + c
    return out


def largest_roots(poly: list[int], most: int, bits: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots with their multiplicities, until these make up ``most``.

    Roots are known to 2**-bits; closer ones count as one of their common multiplicity.
    """
    size = len(poly) - 1
    zero = next(i for i, c in enumerate(poly) if c)
    size, poly = size - zero, poly[zero:]
    # Roots of this one are those of the other times 2**bits.
    poly = [c << (bits * (size - i)) for i, c in enumerate(poly)]
    high = 1
    while roots_above(poly, high):
        high <<= 4
    out, open_ = [], [(0, high, size, 0)] if size else []
    while open_ and sum(m for _, m in out) < most:
        low, high, above_low, above_high = open_.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1:
            sign = _value(poly, high) > 0
            while high - low > 1:
                middle = (low + high) // 2
                value = _value(poly, middle)
                if value == 0:
                    low = high = middle
                elif (value > 0) == sign and value:
                    high = middle
                else:
                    low = middle
        if high - low <= 1:
            out.append((Fraction(low + high, 2 << bits), above_low - above_high))
            continue
        middle = (low + high) // 2
        above = roots_above(poly, middle)
        open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return out


# -------------------------------------------------------------------- components
def _solver(b: np.ndarray, bits: int):
    """Gauss elimination of integers of fixed point; returns the solution of b x = rhs as a function."""
    b, size = b.copy(), len(b)
    steps = []
    for c in range(size):
        at = c + max(range(size - c), key=lambda i: abs(b[c + i, c]))
        b[[c, at]] = b[[at, c]]
        if b[c, c] == 0:
            b[c, c] = 1
        factor = (b[c + 1:, c] << bits) // b[c, c]
        b[c + 1:, c:] -= np.outer(factor, b[c, c:]) >> bits
        steps.append((at, factor))

    def solve(rhs: np.ndarray) -> np.ndarray:
        x = rhs.copy()
        for c, (at, factor) in enumerate(steps):
            x[c], x[at] = x[at], x[c]
            x[c + 1:] -= (factor * x[c]) >> bits
        for c in range(size - 1, -1, -1):
            x[c] = ((x[c] - (int((b[c, c + 1:] * x[c + 1:]).sum()) >> bits if c + 1 < size else 0)) << bits) // b[c, c]
        return x

    return solve


def null_space(matrix: np.ndarray, root: Fraction, dimension: int, trace: int, bits: int) -> np.ndarray:
    """Orthonormal vectors, as columns of doubles, that the matrix stretches by ``root``."""
    size = len(matrix)
    b = (matrix << bits) // trace
    shift = (root.numerator << bits) // (root.denominator * trace)
    for i in range(size):
        b[i, i] -= shift
    solve = _solver(b, bits)
    found: list[np.ndarray] = []
    for number in range(dimension):
        x = np.array([((i * 7919 + (number + 1) * 104_729 + i * i * (number + 3)) % 1009 - 504) << bits for i in range(size)], dtype=object)
        for _ in range(3):
            x = solve(x)
            for v in found:
                x = x - ((int((x * v).sum()) >> bits) * v >> bits)
            length = max(1, isqrt(int((x * x).sum())))
            x = (x << bits) // length
        found.append(x)
    out = np.array([[int(a) / (1 << bits) for a in v] for v in found]).T
    # Either sign is right; the largest entry is positive.
    return out * np.sign(out[np.abs(out).argmax(axis=0), np.arange(dimension)])


@dataclass
class Whitening:
    """Count, sums of the unshifted entries, unit components as columns, their eigenvalues, the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: list[float]


def fit(table: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on all vectors of ``table``; only components with variance are there.

    Jobs sum the scatter matrix and work out the polynomial; what comes to the driver grows with
    the square of the vectors' length alone.
    """
    n, sums, matrix = scatter(table)
    size = len(sums)
    trace = int(sum(matrix[i, i] for i in range(size)))
    if not trace:
        return Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), [])
    poly = characteristic(table.sparkSession, matrix)
    roots = largest_roots(poly, components, max(0, BITS - trace.bit_length()))
    columns, values, explained = [], [], []
    for root, times in roots:
        take = min(times, components - len(values))
        columns.append(null_space(matrix, root, take, trace, BITS + SPARE))
        values += [float(root / (n * n))] * take
        explained += [float(root / trace)] * take
    return Whitening(n, sums, np.hstack(columns), np.array(values), explained)


def whitened(table: DataFrame, model: Whitening, key: str = "vec_id") -> DataFrame:
    """(key, deviation, w1 ... wk) of every row of the fit list.

    deviation is the exact sum of (n * x - S)**2, null where a long cannot hold it; w are the
    whitened coordinates.
    """
    size, k = len(model.sums), len(model.eigenvalues)
    held = table.sparkSession.sparkContext.broadcast(model)
    names = [f"w{i + 1}" for i in range(k)]
    own = table.select(F.col(key).alias("__key"), F.col("embedding").cast("array<double>").alias("__vector"))

    def run(batches):
        model = held.value
        sums = np.array(model.sums, dtype=object)
        turn = model.components / np.sqrt(model.eigenvalues)
        widest = max((abs(s) for s in model.sums), default=0)
        for batch in batches:
            for at, rows in matrices(batch.column(1)):
                if rows.shape[1] != size:
                    continue
                y = scaled(rows, SCALE, HELD)
                most = model.n * int(np.abs(y).max(initial=0)) + widest
                if size * most * most < 1 << 63:
                    d = model.n * y - sums.astype(np.int64)
                    deviation = (d * d).sum(axis=1).tolist()
                else:
                    d = model.n * y.astype(object) - sums
                    deviation = [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]
                w = d.astype(np.float64) / model.n @ turn
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(deviation, pa.int64()), *[pa.array(w[:, i].copy()) for i in range(k)]],
                    names=[key, "deviation", *names])

    kind = own.schema["__key"].dataType.simpleString()
    return own.mapInArrow(lean(run), ", ".join([f"`{key}` {kind}", "deviation long", *[f"{c} double" for c in names]]))


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of (vec_id, embedding).

    One row per vector of the fit list and component, numbered from 1 by falling eigenvalue of
    the covariance of x = floor(1024 * c) + 100000 (divisor n). Vectors that are null, empty or
    hold null or non-finite components are left out, and so are those of another length than
    the most frequent one. Components without variance have no rows: with fewer vectors than
    that, or all equal ones, there are fewer than ``components``, or none. Equal eigenvalues get
    orthogonal components of their common space. Repeated rows count each; vec_id may be null;
    an empty table gives no rows; other columns are ignored. A scaled entry beyond 2**40 is held
    there; deviation is null where a long cannot hold it. identity_error is the largest absolute
    entry of the whitened rows' covariance minus the identity, worked out on all rows.
    """
    model = fit(table, components)
    k = len(model.eigenvalues)
    shape = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if not k:
        return table.sparkSession.createDataFrame([], shape)
    own = written(whitened(table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), model), "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    error = own.agg(F.greatest(F.lit(0.0), *[
        F.abs(F.covar_pop(f"w{i + 1}", f"w{j + 1}") - F.lit(1.0 if i == j else 0.0)) for i, j in pairs]).alias("e")).first()["e"]
    each = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col(f"w{i + 1}").alias("whitened"),
                                        F.lit(model.explained[i]).alias("explained")) for i in range(k)])).alias("c")
    return own.select("vec_id", "deviation", each).select(
        "vec_id", "c.component", F.lit(model.n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(error).alias("identity_error"))
