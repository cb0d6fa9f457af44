"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers, x = floor(64 * c) + 1000000. The sums and products of all x are added up exactly, task by
task, so that n times the products less the products of the sums is the scatter, a matrix of whole numbers that is
n * n times the covariance. From there on nothing depends on the number of rows:

1. The scatter's characteristic polynomial is found modulo many primes, each by reduction to Hessenberg form, and put
   together by Chinese remaindering. Its coefficients alternate in sign and are bounded by the trace, which says
   how many primes are enough. Primes are rows of a table, so tasks share them.
2. All its roots are real. For such a polynomial the changes of sign in the coefficients of p(x + a) are exactly the
   number of roots above a, so bisection with whole numbers isolates every root, and its multiplicity.
3. Each root is narrowed down until its distance to the others is 2**66 times its own uncertainty, and the
   null space of (scatter - root) is found by inverse iteration with as many decimal places as that needs, starting
   with as many vectors as the root is multiple. Roots are rows of a table as well.

Rows are projected on the components in doubles, from exact differences to the mean.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
# Primes are looked for below this, so that products of two residues fit 62 bits.
PRIMES_BELOW = 1 << 31
# Bits by which a root is narrower than its distance to the next one.
APART_BITS = 66
# Whole numbers of more bits are not exact as doubles, and of as many or more as entries not accepted.
EXACT_BITS, ENTRY_BITS = 53, 62


@dataclass(frozen=True)
class Whitening:
    """What is learnt: rows, sums of x - 1000000 for each dimension, components as rows by falling eigenvalue,
    their eigenvalues, and the share of each in the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector isn't null or empty and has no null or non-finite entry."""
    finite = f"forall(`{vector}`, c -> coalesce(abs(c) < double('Infinity'), false))"
    return rows.where(f"coalesce(size(`{vector}`) > 0 AND {finite}, false)")


def _entries(column: pa.Array, dimensions: int) -> np.ndarray:
    """x - 1000000 of a column of vectors, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != dimensions * len(column):
        raise ValueError("vectors differ in length")
    scaled = np.floor(SCALE * flat)
    if np.abs(scaled).max(initial=0) >= 2.0**ENTRY_BITS:
        raise ValueError(f"an entry is too large: 64 times it has over {ENTRY_BITS} bits")
    return scaled.astype(np.int64).reshape(len(column), dimensions)


def _products(x: np.ndarray) -> np.ndarray:
    """Exact products of all columns, as whole numbers of any size."""
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < 1 << EXACT_BITS:
        floats = x.astype(np.float64)
        return (floats.T @ floats).astype(np.int64).astype(object)
    big = x.astype(object)
    return big.T @ big


def scatter(rows: DataFrame, vector: str, dimensions: int) -> tuple[int, list[int], np.ndarray]:
    """The number of rows, the sums of x - 1000000, and the scatter, n * n times the covariance, all exact."""
    upper = np.triu_indices(dimensions)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dimensions, object), np.zeros((dimensions, dimensions), object)
        for batch in batches:
            x = _entries(batch.column(0), dimensions)
            n += len(x)
            sums = sums + (x.astype(object) if np.abs(x).max(initial=0) > 1 << 40 else x).sum(axis=0).astype(object)
            products = products + _products(x)
        values = [Decimal(int(v)) for v in [n, *sums, *products[upper]]] if n else []
        cells = pa.array(range(len(values)), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(values, pa.decimal128(38, 0))], names=["cell", "value"])

    parts = rows.select(vector).mapInArrow(add, "cell INT, value DECIMAL(38,0)")
    totals = dict(parts.groupBy("cell").agg(F.sum("value")).collect())
    if not totals:
        return 0, [0] * dimensions, np.zeros((dimensions, dimensions), object)
    ordered = [int(totals[cell]) for cell in range(len(totals))]
    n, sums = ordered[0], np.array(ordered[1 : dimensions + 1], object)
    products = np.zeros((dimensions, dimensions), object)
    products[upper] = ordered[dimensions + 1 :]
    products = products + np.triu(products, 1).T
    return n, list(sums), n * products - np.outer(sums, sums)


def primes(count: int) -> list[int]:
    """The largest primes below ``PRIMES_BELOW``."""
    found, at = [], PRIMES_BELOW - 1
    while len(found) < count:
        if _is_prime(at):
            found.append(at)
        at -= 2
    return found


def _is_prime(n: int) -> bool:
    """For odd n below 2**32: strong pseudoprimality to the bases 2, 7 and 61 is enough there."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``matrix`` modulo the prime p that is zero below the first subdiagonal."""
    h = (matrix % p).astype(np.int64)
    for m in range(1, len(h) - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factors = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factors[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factors % p).sum(axis=1)) % p
    return h


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """The coefficients of det(x - matrix) modulo the prime p, from the constant one up."""
    h, size = hessenberg(matrix, p), len(matrix)
    polynomials = np.zeros((size + 1, size + 1), np.int64)
    polynomials[0, 0] = 1
    for k in range(1, size + 1):
        polynomials[k, 1:] = polynomials[k - 1, :-1]
        polynomials[k] = (polynomials[k] - int(h[k - 1, k - 1]) * polynomials[k - 1]) % p
        product = 1
        for i in range(k - 1, 0, -1):
            product = product * int(h[i, i - 1]) % p
            if not product:
                break
            polynomials[k] = (polynomials[k] - product * int(h[i - 1, k - 1]) % p * polynomials[i - 1]) % p
    return polynomials[size].tolist()


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """det(x - matrix) of a matrix of whole numbers with no negative eigenvalue, from the constant coefficient up.

    The sum of all products of k eigenvalues is at most C(d, k) * (trace / d)**k, and not negative. The primes'
    product passes the largest of these; one prime more checks the result.
    """
    size, trace = len(matrix), int(np.trace(matrix))
    most = max(math.comb(size, k) * trace**k // size**k for k in range(size + 1)) + 1
    chosen = primes(most.bit_length() // (PRIMES_BELOW.bit_length() - 2) + 2)
    sent = spark.sparkContext.broadcast(matrix)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo(sent.value, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["prime", "residues"])

    table = spark.createDataFrame([(p,) for p in chosen], "prime BIGINT").repartition(min(16, len(chosen)))
    found = dict(table.mapInArrow(residues, "prime BIGINT, residues ARRAY<BIGINT>").collect())
    *used, check = chosen
    modulus, sums = 1, [0] * (size + 1)
    for p in used:
        inverse = pow(modulus, -1, p)
        for k, residue in enumerate(found[p]):
            # Coefficients are taken without their signs, which alternate from the leading one down.
            value = residue if (size - k) % 2 == 0 else -residue
            sums[k] += modulus * ((value - sums[k]) * inverse % p)
        modulus *= p
    signed = [value if (size - k) % 2 == 0 else -value for k, value in enumerate(sums)]
    if [value % check for value in signed] != found[check]:
        raise ArithmeticError("the matrix has negative eigenvalues")
    return signed


def _degree_of_gcd(a: list[int], b: list[int], p: int) -> int:
    a, b = ([value % p for value in x] for x in (a, b))
    while True:
        for x in (a, b):
            while x and not x[-1]:
                x.pop()
        if not b:
            return len(a) - 1
        if len(a) >= len(b):
            factor = a[-1] * pow(b[-1], -1, p) % p
            for i, value in enumerate(b):
                a[len(a) - len(b) + i] = (a[len(a) - len(b) + i] - factor * value) % p
        else:
            a, b = b, a


def _derivative(polynomial: list[int]) -> list[int]:
    return [k * value for k, value in enumerate(polynomial)][1:]


def _remainder(a: list[int], b: list[int]) -> tuple[list[Fraction], list[Fraction]]:
    """Quotient and remainder of two polynomials."""
    a, quotient = [Fraction(value) for value in a], [Fraction(0)] * max(1, len(a) - len(b) + 1)
    while len(a) >= len(b):
        quotient[len(a) - len(b)] = factor = a[-1] / b[-1]
        for i, value in enumerate(b):
            a[len(a) - len(b) + i] -= factor * value
        a.pop()
    while a and not a[-1]:
        a.pop()
    return quotient, a


def square_free(polynomial: list[int]) -> list[int]:
    """A monic polynomial of whole numbers with each of the roots once."""
    slope = _derivative(polynomial)
    if _degree_of_gcd(polynomial, slope, primes(1)[0]) == 0:
        return polynomial
    a, b = polynomial, slope
    while b:
        _, rest = _remainder(a, b)
        scale = math.lcm(*(x.denominator for x in rest)) if rest else 1
        rest = [int(x * scale) for x in rest]
        common = math.gcd(*rest) if rest else 1
        a, b = b, [x // common for x in rest]
    quotient, _ = _remainder(polynomial, a)
    return [int(x / quotient[-1]) for x in quotient]


def _sign(polynomial: list[int], x: Fraction) -> int:
    """Of the value at a fraction of a power of two."""
    shift, value = x.denominator.bit_length() - 1, 0
    for k, coefficient in enumerate(reversed(polynomial)):
        value = value * x.numerator + (coefficient << (shift * k))
    return (value > 0) - (value < 0)


def roots_above(polynomial: list[int], x: Fraction) -> int:
    """How many of the roots, all real, are over a fraction of a power of two; multiple ones count as often."""
    shift, degree = x.denominator.bit_length() - 1, len(polynomial) - 1
    shifted = [value << (shift * (degree - k)) for k, value in enumerate(polynomial)]
    for start in range(degree):
        for k in range(degree - 1, start - 1, -1):
            shifted[k] += x.numerator * shifted[k + 1]
    signs = [value > 0 for value in shifted if value]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


Interval = tuple[Fraction, Fraction]


def _halved(polynomial: list[int], interval: Interval) -> Interval:
    """The half of the interval (low, high] that has its only root; a root that is met is an interval of its own."""
    low, high = interval
    if low == high or not (above := _sign(polynomial, high)):
        return high, high
    middle = (low + high) / 2
    here = _sign(polynomial, middle)
    return (middle, middle) if not here else (low, middle) if here == above else (middle, high)


def isolated(polynomial: list[int]) -> list[tuple[Interval, int]]:
    """An interval for each distinct root over zero of a polynomial with real roots, none negative, by falling
    root, and the root's multiplicity. Neighbours are farther from each other than either is wide."""
    polynomial = polynomial[next(k for k, value in enumerate(polynomial) if value) :]
    single = square_free(polynomial)
    if len(single) == 1:
        return []
    top = Fraction(1 << (abs(polynomial[-2]).bit_length() + 1))
    open_, found = [(Fraction(0), top, len(single) - 1, 0)], []
    while open_:
        low, high, above_low, above_high = open_.pop()
        if above_low - above_high == 1:
            found.append((low, high))
        elif above_low > above_high:
            middle = (low + high) / 2
            above = roots_above(single, middle)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    found.sort(reverse=True)
    multiplicities = [roots_above(polynomial, low) - roots_above(polynomial, high) for low, high in found]
    for i in range(len(found) - 1):
        while found[i][0] - found[i + 1][1] <= max(high - low for low, high in found[i : i + 2]):
            found[i : i + 2] = [_halved(single, interval) for interval in found[i : i + 2]]
    return list(zip(found, multiplicities, strict=True))


def null_space(matrix: np.ndarray, root: Fraction, size: int, digits: int) -> list[list[float]]:
    """Orthonormal vectors that (matrix - root) takes to nearly nothing, by inverse iteration with so many digits."""
    with decimal.localcontext() as context:
        context.prec = digits
        context.Emin, context.Emax = decimal.MIN_EMIN, decimal.MAX_EMAX
        d = len(matrix)
        near = Decimal(root.numerator) / Decimal(root.denominator)
        lu = np.array([[Decimal(int(value)) for value in row] for row in matrix], object)
        lu[np.arange(d), np.arange(d)] -= near
        least = (abs(near) + 1) * Decimal(10) ** (8 - digits)
        order = np.arange(d)
        for k in range(d):
            pivot = k + int(np.argmax(np.abs(lu[k:, k])))
            if pivot != k:
                lu[[k, pivot]], order[[k, pivot]] = lu[[pivot, k]], order[[pivot, k]]
            if abs(lu[k, k]) < least:
                lu[k, k] = least
            if k + 1 < d:
                lu[k + 1 :, k] = lu[k + 1 :, k] / lu[k, k]
                lu[k + 1 :, k + 1 :] = lu[k + 1 :, k + 1 :] - np.outer(lu[k + 1 :, k], lu[k, k + 1 :])
        # Any vectors will do that are not orthogonal to the null space.
        vectors = [np.array([Decimal((i * i * 37 + j * 101 + i * j * j * 13) % 211 + 1) for i in range(d)], object) for j in range(size)]
        for _ in range(3):
            made: list[np.ndarray] = []
            for vector in vectors:
                solved = vector[order]
                for k in range(1, d):
                    solved[k] -= (lu[k, :k] * solved[:k]).sum()
                for k in range(d - 1, -1, -1):
                    rest = (lu[k, k + 1 :] * solved[k + 1 :]).sum() if k + 1 < d else 0
                    solved[k] = (solved[k] - rest) / lu[k, k]
                for _ in range(2):
                    solved = solved / (solved * solved).sum().sqrt()
                    for other in made:
                        solved = solved - other * (solved * other).sum()
                made.append(solved / (solved * solved).sum().sqrt())
            vectors = made
        out = [[float(value) for value in vector] for vector in vectors]
    return [[-v for v in x] if x[max(range(d), key=lambda i: abs(x[i]))] < 0 else x for x in out]


def eigen(spark: SparkSession, matrix: np.ndarray, most: int) -> tuple[list[Fraction], np.ndarray]:
    """The largest eigenvalues over zero of a scatter, at most so many, and unit eigenvectors as rows."""
    size = len(matrix)
    if not any(int(value) for value in np.diag(matrix)):
        return [], np.zeros((0, size))
    polynomial = characteristic(spark, matrix)
    polynomial = polynomial[next(k for k, value in enumerate(polynomial) if value) :]
    single, places = square_free(polynomial), isolated(polynomial)
    tasks, reached = [], 0
    for at, (interval, multiplicity) in enumerate(places):
        if reached >= most:
            break
        beside = [places[i][0] for i in (at - 1, at + 1) if 0 <= i < len(places)]
        tasks.append((reached, interval, multiplicity, beside))
        reached += multiplicity
    sent = spark.sparkContext.broadcast((matrix, single, tasks))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, single, tasks = sent.value
        for batch in batches:
            rows = []
            for number in batch.column(0).to_pylist():
                first, interval, multiplicity, beside = tasks[number]
                low, high = interval
                apart = min([abs(end - x) for x in (low, high) for pair in beside for end in pair], default=high)
                while low < high and (high - low) * (1 << APART_BITS) > min(apart, high):
                    low, high = _halved(single, (low, high))
                root = (low + high) / 2
                spread = Fraction(int(np.trace(matrix))) / min(apart, root)
                digits = 50 + 2 * APART_BITS // 3 + len(str(int(spread)))
                for i, vector in enumerate(null_space(matrix, root, multiplicity, digits)):
                    rows.append({"component": first + i, "root": f"{root.numerator}/{root.denominator}", "vector": vector})
            yield pa.RecordBatch.from_pylist(rows, schema=SOLVED)

    table = spark.createDataFrame([(i,) for i in range(len(tasks))], "number INT").repartition(len(tasks))
    found = sorted(table.mapInArrow(solve, "component INT, root STRING, vector ARRAY<DOUBLE>").collect())[:most]
    return [Fraction(row.root) for row in found], np.array([row.vector for row in found])


SOLVED = pa.schema([("component", pa.int32()), ("root", pa.string()), ("vector", pa.list_(pa.float64()))])


def fitted(rows: DataFrame, vector: str = "embedding", components: int = 32, most_dimensions: int = 512) -> Whitening:
    """What whitening needs to know of all usable rows: no more than ``components`` components.

    There are as many components as eigenvalues over zero: none if no two vectors differ or there are no usable
    rows, fewer than dimensions if some depend on others. Null and empty vectors and those with null or
    non-finite entries are left out; repeated rows count as often. Vectors of different lengths, more than
    ``most_dimensions`` of them, and entries of 2**56 or more are errors.
    """
    rows = usable(rows, vector)
    shortest, longest = rows.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if shortest != longest:
        raise ValueError(f"vectors have {shortest} to {longest} entries")
    dimensions = longest or 0
    if dimensions > most_dimensions:
        raise ValueError(f"vectors have {dimensions} entries, over {most_dimensions}")
    n, sums, matrix = scatter(rows, vector, dimensions)
    roots, vectors = eigen(rows.sparkSession, matrix, components) if n else ([], np.zeros((0, dimensions)))
    trace = int(np.trace(matrix)) if n else 1
    eigenvalues = np.array([float(root / (n * n)) for root in roots])
    return Whitening(n, sums, vectors, eigenvalues, np.array([float(root / trace) for root in roots]))


def whitened(rows: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The usable rows with deviation and whitened, an entry for each component of the model.

    deviation is the exact sum over dimensions of (n * x - sum)**2; one of 2**63 or more is an error. Columns of these
    names that ``rows`` has are replaced; all others are kept. A model of no rows goes with no usable rows.
    """
    rows = usable(rows.drop(*({"deviation", "whitened"} - {vector})), vector)
    sent = rows.sparkSession.sparkContext.broadcast(model)
    at = rows.columns.index(vector)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        sums, scale = np.array(model.sums, object), np.sqrt(model.eigenvalues)
        fits = all(abs(s) < 1 << ENTRY_BITS for s in model.sums)
        for batch in batches:
            x = _entries(batch.column(at), len(sums))
            from_mean = x.astype(object) * model.n - sums
            if fits and model.n * int(np.abs(x).max(initial=0)) < 1 << ENTRY_BITS:
                from_mean = from_mean.astype(np.int64)
            most = int(np.abs(from_mean).max(initial=0))
            if from_mean.dtype == object or most * most * len(sums) >= 1 << 63:
                deviations = [int(value) for value in (from_mean.astype(object) ** 2).sum(axis=1)]
                from_mean = from_mean.astype(np.float64)
            else:
                deviations = (from_mean * from_mean).sum(axis=1)
            projected = (from_mean / model.n) @ model.components.T / scale
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * projected.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(projected.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(deviations, pa.int64()), lists], names=[*batch.schema.names, "deviation", "whitened"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(project, f"{schema}, deviation BIGINT, whitened ARRAY<DOUBLE>")


def identity_error(rows: DataFrame, components: int, column: str = "whitened") -> float | None:
    """The largest absolute entry of the covariance of whitened rows less the identity; None without rows or components.

    ``rows`` are already centred, each by the exact mean; the mean that rounding leaves is taken off as well.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1, components + 1))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
            total += x.T @ x
        cells = pa.array(range(total.size), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(total.ravel())], names=["cell", "value"])

    if not components:
        return None
    parts = rows.select(column).mapInArrow(add, "cell INT, value DOUBLE")
    totals = dict(parts.groupBy("cell").agg(F.sum("value")).collect())
    total = np.array([totals.get(cell, 0.0) for cell in range((components + 1) ** 2)]).reshape(components + 1, -1)
    n = total[-1, -1]
    if not n:
        return None
    mean = total[-1, :-1] / n
    return float(np.abs(total[:-1, :-1] / n - np.outer(mean, mean) - np.eye(components)).max())
