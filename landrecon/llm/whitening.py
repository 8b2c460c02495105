"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Components become integers, x = floor(256 c). Each distinct x vector counts once. Count, sums S and
products of these vectors are added up exactly by Spark, so the scatter M = n * sum(x x') - S S', which
is n^2 times the covariance, is an integer matrix. Its characteristic polynomial is found modulo many
primes, each by reduction to Hessenberg form in a task of its own, and put together by the Chinese
remainder theorem; a bound on the coefficients tells how many primes are needed. The polynomial has real
roots only, so by Descartes' rule the sign changes of its shifted coefficients count the roots above a
point exactly, with multiplicity; bisection on these counts isolates the largest roots to ``BITS`` bits.
The null space of M - root is found by inverse iteration in decimals of ``DIGITS`` digits, components of
a multiple root being kept orthogonal. A vector's sign makes its largest entry positive.

What reaches the driver is bounded by the vectors' length d: d^2 sums and d + 1 coefficients.

Rows whose vector is NULL or holds NULL or non-finite entries are dropped; repeated rows and rows with
NULL id give one result each. Vectors of each length are a fit list of their own. A component without
variance has NULL ``whitened``; a deviation beyond 64 bits is NULL. No rows come from empty vectors or
an empty table. Other columns are left out.
"""

from __future__ import annotations

from decimal import Context, Decimal, localcontext
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from landrecon.llm.common import finite, give_back, grid
from landrecon.session import stage

COMPONENTS = 4
# Relative precision of the roots, in bits, and of the arithmetic that finds their vectors, in digits.
BITS = 160
DIGITS = 90
# Bits of a digit in which sums travel, and most digits of a sum.
LIMB, LIMBS = 40, 8
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


# ---- the characteristic polynomial -------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller's test; the bases 2, 3, 5 and 7 decide it below 3.2e9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_below(limit: int, product: int) -> list[int]:
    """The largest primes below ``limit`` whose product is above ``product``."""
    found, have = [], 1
    while have <= product:
        limit -= 1
        if is_prime(limit):
            found.append(limit)
            have *= limit
    return found


def coefficient_bound(m: list[list[int]]) -> int:
    """No coefficient of the characteristic polynomial is larger: of degree d - k it is the sum of the
    k-fold products of the eigenvalues, whose mean is trace / d as none is negative."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    return max(comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))


def polynomial_modulo(m: np.ndarray, p: int) -> list[int]:
    """Coefficients, lowest first, of det(x - m) modulo a prime below 2**31."""
    h = m.copy()
    d = len(h)
    for c in range(d - 2):
        below = np.flatnonzero(h[c + 1 :, c])
        if not len(below):
            continue
        r = c + 1 + int(below[0])
        if r != c + 1:  # similar: the same swap of rows and columns
            h[[r, c + 1]] = h[[c + 1, r]]
            h[:, [r, c + 1]] = h[:, [c + 1, r]]
        factor = h[c + 2 :, c] * pow(int(h[c + 1, c]), -1, p) % p
        h[c + 2 :] = (h[c + 2 :] - factor[:, None] * h[c + 1][None, :] % p) % p
        added = np.zeros(d, dtype=np.int64)
        for f, column in zip(factor.tolist(), h[:, c + 2 :].T):
            added = (added + column * f) % p
        h[:, c + 1] = (h[:, c + 1] + added) % p
    found = [np.array([1], dtype=np.int64)]
    for k in range(d):
        new = np.zeros(k + 2, dtype=np.int64)
        new[1:] = found[k]
        new[:-1] = (new[:-1] - found[k] * h[k, k]) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            new[: i + 1] = (new[: i + 1] - found[i] * (chain * int(h[i, k]) % p)) % p
        found.append(new % p)
    return found[d].tolist()


def from_remainders(primes: list[int], remainders: list[list[int]]) -> list[int]:
    """The integers of least size with these remainders modulo the primes."""
    product = 1
    for p in primes:
        product *= p
    parts = [(product // p) * pow(product // p, -1, p) for p in primes]
    out = []
    for column in zip(*remainders):
        value = sum(r * part for r, part in zip(column, parts)) % product
        out.append(value - product if 2 * value > product else value)
    return out


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients of det(x - m), lowest first, for a symmetric matrix without negative eigenvalue;
    each prime is a row of a Spark job."""
    d = len(m)
    primes = primes_below(1 << 31, 2 * coefficient_bound(m))
    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64))

    def reduce_all(part):
        for batch in part:
            own = batch["p"].to_pylist()
            if own:
                rest = [polynomial_modulo(np.array([[v % p for v in row] for row in m], dtype=np.int64), p) for p in own]
                yield pa.RecordBatch.from_pydict({"p": own, "c": pa.array(rest, pa.list_(pa.int64()))})
        give_back()

    got = {r.p: r.c for r in table.mapInArrow(reduce_all, "p long, c array<long>").collect()}
    found = from_remainders(primes, [got[p] for p in primes])
    assert len(found) == d + 1 and found[d] == 1
    return found


# ---- roots and vectors -------------------------------------------------------------------------


def roots_above(coefficients: list[int], point: int, shift: int) -> int:
    """How many roots of a real-rooted polynomial lie above point / 2**shift, with multiplicity: the
    sign changes of its coefficients about that point."""
    d = len(coefficients) - 1
    c = [v << (shift * (d - i)) for i, v in enumerate(coefficients)]  # in units of 2**-shift
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(coefficients: list[int], count: int, top: int, bits: int = BITS) -> list[Fraction]:
    """The ``count`` largest roots, each within 2**-bits of its size or of ``top``'s, whichever is more
    precise down to 2**(2 * bits); ``top`` is at least every root and no root is negative."""
    zeros = next(i for i, v in enumerate(coefficients) if v)
    rest = coefficients[zeros:]  # without the roots that are exactly 0
    found: list[Fraction] = []
    known: list[tuple[Fraction, Fraction, int, int]] = []  # (low, high, roots above low, above high)
    for k in range(1, min(count, len(rest) - 1) + 1):
        shared = [v for v in known if v[3] < k <= v[2]]
        if shared:  # one of several roots that are equal to this precision
            found.append((shared[0][0] + shared[0][1]) / 2)
            continue
        shift, low, high = 0, 0, top
        above = (len(rest) - 1, 0)
        while high - low > 1 or not low or low.bit_length() < bits:
            if high - low <= 1:
                if shift > 4 * bits:
                    break
                grow = max(1, bits - low.bit_length()) if low else bits
                shift, low, high = shift + grow, low << grow, high << grow
            middle = (low + high) // 2
            n = roots_above(rest, middle, shift)
            if n >= k:
                low, above = middle, (n, above[1])
            else:
                high, above = middle, (above[0], n)
        scale = 1 << shift
        known.append((Fraction(low, scale), Fraction(high, scale), *above))
        found.append(Fraction(2 * low + 1, 2 * scale))
    return found + [Fraction(0)] * (min(count, len(coefficients) - 1) - len(found))


def _decimal(value: Fraction) -> Decimal:
    return Decimal(value.numerator) / Decimal(value.denominator)


def _factor(a: list[list[Decimal]], tiny: Decimal):
    """Rows of the triangular factors with partial pivoting; a zero pivot becomes ``tiny``."""
    d = len(a)
    order = list(range(d))
    for c in range(d):
        best = max(range(c, d), key=lambda r: abs(a[r][c]))
        a[c], a[best], order[c], order[best] = a[best], a[c], order[best], order[c]
        if not a[c][c]:
            a[c][c] = tiny
        pivot = a[c]
        for r in range(c + 1, d):
            if a[r][c]:
                f = a[r][c] / pivot[c]
                row = a[r]
                row[c] = f
                for j in range(c + 1, d):
                    row[j] -= f * pivot[j]
    return a, order


def _solve(factors, b: list[Decimal]) -> list[Decimal]:
    a, order = factors
    d = len(a)
    y = [b[i] for i in order]
    for r in range(d):
        for c in range(r):
            y[r] -= a[r][c] * y[c]
    for r in range(d - 1, -1, -1):
        for c in range(r + 1, d):
            y[r] -= a[r][c] * y[c]
        y[r] /= a[r][r]
    return y


def _unit(v: list[Decimal]) -> list[Decimal]:
    most = max(abs(x) for x in v)
    v = [x / most for x in v]
    size = sum(x * x for x in v).sqrt()
    return [x / size for x in v]


def null_vectors(m: list[list[int]], roots: list[Fraction], digits: int = DIGITS) -> np.ndarray:
    """Unit eigenvectors for roots in falling order, in double precision."""
    d = len(m)
    with localcontext(Context(prec=digits)):
        tiny = Decimal(max(1, max(abs(v) for row in m for v in row))).scaleb(-digits + 5)
        done: list[list[Decimal]] = []
        factors, last = None, None
        for k, root in enumerate(roots):
            if root != last:
                value = _decimal(root)
                factors, last = _factor([[Decimal(v) - (value if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(m)], tiny), root
            v = [Decimal((i * i + 7 * i * k + k + 3) % 101 + 1) for i in range(d)]
            for _ in range(3):
                for u in done:
                    inner = sum(x * y for x, y in zip(u, v))
                    v = [x - inner * y for x, y in zip(v, u)]
                v = _unit(_solve(factors, _unit(v)))
            for u in done:
                inner = sum(x * y for x, y in zip(u, v))
                v = [x - inner * y for x, y in zip(v, u)]
            v = _unit(v)
            largest = max(range(d), key=lambda i: abs(v[i]))
            done.append([-x for x in v] if v[largest] < 0 else v)
        return np.array([[float(x) for x in v] for v in done]).reshape(len(done), d)


# ---- sums, fit and rows ------------------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def _by_length(batch: pa.RecordBatch):
    """(length, rows) of a batch with vectors x; empty vectors are left out."""
    dims = np.diff(batch["x"].offsets.to_numpy())
    for dim in np.unique(dims[dims > 0]).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(dims == dim)))


def _products(x: np.ndarray) -> np.ndarray:
    """x' x in exact integers: doubles while all sums stay below 2**53, Python integers beyond."""
    most = max(abs(int(x.max())), abs(int(x.min())), 1)
    if most * most >= 1 << 52:
        wide = x.astype(object)
        return wide.T @ wide
    step = (1 << 52) // (most * most)
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for at in range(0, len(x), step):
        part = x[at : at + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def limbs(value: int):
    """(position, signed digit) to the base 2**LIMB, so that Spark adds up numbers of any size."""
    sign, rest, i = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield i, sign * (rest & ((1 << LIMB) - 1))
        rest, i = rest >> LIMB, i + 1


def scatter(fit_list: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """(n, sums, n * sum(x x') - sums sums') by length, of rows ``x``. Every task sends the digits of
    its exact sums; Spark adds them up by place."""

    def add_up(part):
        sums: dict[int, list] = {}
        for batch in part:
            for dim, own in _by_length(batch):
                x = _matrix(own["x"])
                new = [len(x), x.astype(object).sum(axis=0), _products(x)]
                old = sums.get(dim)
                sums[dim] = new if old is None else [a + b for a, b in zip(old, new)]
        for dim, (n, total, products) in sums.items():
            flat = [n, *total.tolist(), *(products[i, j] for i in range(dim) for j in range(i, dim))]
            places = [(place * LIMBS + i, digit) for place, value in enumerate(flat) for i, digit in limbs(int(value))]
            place, digit = zip(*places)
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * len(places), pa.int32()), "place": place, "digit": digit})
        give_back()

    digits = fit_list.select("x").mapInArrow(add_up, "dim int, place long, digit long")
    added = digits.groupBy("dim", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("total"))
    got: dict[int, dict[int, int]] = {}
    for r in added.collect():
        place, i = divmod(r.place, LIMBS)
        values = got.setdefault(r.dim, {})
        values[place] = values.get(place, 0) + (int(r.total) << (LIMB * i))
    out = {}
    for dim, values in got.items():
        n, sums = values[0], [values.get(1 + i, 0) for i in range(dim)]
        m = [[0] * dim for _ in range(dim)]
        place = dim + 1
        for i in range(dim):
            for j in range(i, dim):
                m[i][j] = m[j][i] = n * values.get(place, 0) - sums[i] * sums[j]
                place += 1
        out[dim] = n, sums, m
    return out


class Fit:
    """What whitening needs for vectors of one length."""

    def __init__(self, spark: SparkSession, n: int, sums: list[int], m: list[list[int]], components: int):
        trace = sum(m[i][i] for i in range(len(m)))
        count = min(components, len(m))
        roots = [Fraction(0)] * count
        if trace:
            roots = largest_roots(characteristic_polynomial(spark, m), count, trace + 1)
        self.n, self.sums = n, sums
        self.vectors = null_vectors(m, roots)
        self.explained = [float(r / trace) if trace else 0.0 for r in roots]
        # A root is n^2 times a variance; its square root is taken in integers first.
        self.deviations = np.array([isqrt(int(r * (1 << 200))) / (1 << 100) / n for r in roots])
        self.identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, in Python integers where the squares' sum might leave 64 bits."""
        most = self.n * int(np.abs(x.astype(np.float64)).max() + 1) + max(abs(s) for s in self.sums)
        kind = object if most * most * x.shape[1] >= 1 << 62 else np.int64
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        turned = (centred / self.n).astype(np.float64) @ self.vectors.T
        return turned / np.where(self.deviations > 0, self.deviations, np.nan)


def fit(spark: SparkSession, fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit by length, with the error of its whitening."""
    fits = {dim: Fit(spark, *sums, components) for dim, sums in scatter(fit_list).items()}

    def values(part):
        for batch in part:
            for dim, own in _by_length(batch):
                w = fits[dim].whitened(fits[dim].centred(_matrix(own["x"])))
                listed = pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], w.ravel())
                yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * len(w), pa.int32()), "w": listed})
        give_back()

    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    entry = [F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs]
    if fits:
        for r in fit_list.select("x").mapInArrow(values, "dim int, w array<double>").groupBy("dim").agg(*entry).collect():
            kept = [k for k, s in enumerate(fits[r.dim].deviations) if s > 0]
            errors = [abs(r[f"c{a}_{b}"] - (a == b)) for a, b in pairs if a in kept and b in kept]
            fits[r.dim].identity_error = max(errors, default=None)
    return fits


def project(rows: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """A row for each component of every row with vec_id and x."""

    def values(part):
        for batch in part:
            for dim, own in _by_length(batch):
                f = fits[dim]
                centred = f.centred(_matrix(own["x"]))
                square = (centred * centred).sum(axis=1)
                deviation = pa.array([v if v < 1 << 63 else None for v in square.tolist()], pa.int64())
                whitened = f.whitened(centred)
                size, count = whitened.shape
                each = pa.array(np.repeat(np.arange(size), count))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": own["vec_id"].take(each),
                    "component": pa.array(np.tile(np.arange(1, count + 1), size), pa.int32()),
                    "n": pa.array(np.full(size * count, f.n), pa.int64()),
                    "deviation": deviation.take(each),
                    "whitened": pa.array(whitened.ravel(), from_pandas=True),  # not a number: NULL
                    "explained": pa.array(np.tile(f.explained, size), pa.float64()),
                    "identity_error": pa.array([f.identity_error] * (size * count), pa.float64()),
                })
        give_back()

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(values, SCHEMA)


def whiten(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for every usable row."""
    rows = table.filter(finite(vector)).select(F.col(id_col).alias("vec_id"), grid(vector).alias("x"))
    fit_list = stage(rows.select("x").distinct(), "fit-list")
    return project(rows, fit(table.sparkSession, fit_list, components))
