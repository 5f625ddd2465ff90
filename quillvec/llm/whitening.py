"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

1. Entries become integers, and the tasks that read them add up the integer products of every two dimensions, exactly.
   Only those sums, one for each pair of dimensions, leave a task.
2. The scatter's characteristic polynomial is found modulo many primes, each in a task: the matrix is brought into
   Hessenberg form, whose polynomial is a short recurrence. Chinese remaindering joins the residues into exact integers.
3. All roots are real, so the signs of the shifted polynomial count the roots above any point. Each component halves
   intervals until it has its root alone, and then on by the polynomial's sign until the root is known to ``BITS`` bits.
4. Inverse iteration with the shifted matrix, in decimals of ``DIGITS`` digits, gives the null space of each root.
5. A pass over the vectors measures the covariance of the whitened ones, another gives them out.

What reaches the driver is a matrix of the dimension, never rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Bits of a root that are right, and digits of inverse iteration.
BITS, DIGITS = 160, 110
#: Sums travel in pieces of so many bits, so that sums of pieces fit a long.
LIMB = 40
#: Vectors worked on at a time.
BLOCK = 2048
#: Products of whole numbers below this, a block of them added up, are exact in doubles.
EXACT = 1 << 20


def whitened(vectors: DataFrame, column: str = "embedding", carry: tuple[str, ...] = ("vec_id",),
             components: int = COMPONENTS) -> DataFrame:
    """Each vector on the unit eigenvectors of the covariance of all, divided by the standard deviation there.

    Returns for each vector and component the columns in ``carry``, ``component`` (from 1 by falling eigenvalue), ``n``
    (vectors fitted to), ``deviation`` (squared length of n times the vector less the sum of all), ``whitened``,
    ``explained`` (the eigenvalue's share of all) and ``identity_error`` (the largest difference of the covariance of
    ``whitened`` from the identity).

    Vectors that are NULL or empty, or hold a NULL, NaN or infinite entry or one whose integer needs more than 62 bits, are
    left out, and so are those of another length than most have (of two such lengths the larger counts). A direction
    without variance has no component; equal vectors only, one vector, or none give no rows. Components of equal
    eigenvalues are an orthonormal basis of their space. A deviation beyond a long is NULL. Repeated rows count as
    often as they come; columns not in ``carry`` are left out.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.struct(*carry).alias("row"), F.col(column).alias("vector"))
    row = source.schema["row"].dataType.simpleString()
    schema = (f"row {row}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    dimension = _dimension(source)
    sums = integer_sums(source, dimension)
    n, total, scatter = centred(sums, dimension)
    trace = sum(scatter[i][i] for i in range(dimension))
    if not trace:
        return spark.createDataFrame([], schema).select("row.*", "component", "n", "deviation", "whitened", "explained",
                                                        "identity_error")
    polynomial = characteristic_polynomial(spark, scatter)
    rank = dimension - next(i for i, c in enumerate(polynomial) if c)
    roots, basis = principal_components(spark, scatter, polynomial, min(components, rank))
    # A root is n * n times the eigenvalue of the covariance.
    scale = basis * np.array([n / float(r) ** 0.5 for r in roots])
    explained = np.array([float(r / trace) for r in roots])
    error = _identity_error(source, n, total, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = scale.shape[1]
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("row"))
            for at, entries in _blocks(batch, dimension):
                m = len(at)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(np.repeat(at, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                     np.full(m * k, n), _deviations(entries, n, total).take(pa.array(np.repeat(np.arange(m), k))),
                     (_deviation_floats(entries, n, total) @ scale).ravel(), np.tile(explained, m),
                     np.full(m * k, error)],
                    ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return source.mapInArrow(run, schema).select(
        "row.*", "component", "n", "deviation", "whitened", "explained", "identity_error")


# -- vectors ------------------------------------------------------------------------------------------------------


def _dimension(source: DataFrame) -> int:
    """The most frequent length of vectors without odd entries."""
    whole = F.forall("vector", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    most = source.filter(F.col("vector").isNotNull() & whole & (F.size("vector") > 0)) \
        .groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return most[0].d if most else 1


def _blocks(batch: pa.RecordBatch, dimension: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the rows that count, and their entries floor(SCALE * c) as a matrix."""
    vectors = batch.column(batch.schema.get_field_index("vector"))
    for first in range(0, len(vectors), BLOCK):
        part = vectors.slice(first, BLOCK)
        lengths = part.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(lengths == dimension)
        if not len(at):
            continue
        flat = part.take(pa.array(at)).flatten()
        entries = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dimension)
        with np.errstate(over="ignore", invalid="ignore"):
            entries = np.floor(entries * SCALE)
            good = (np.abs(entries) < 2.0**62).all(axis=1)
        if good.any():
            yield first + at[good], entries[good].astype(np.int64)


def _deviation_floats(entries: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """Entries less their means. The fixed offset of all entries falls out."""
    if int(np.abs(entries).max()) * n < 2**62 and max(map(abs, total)) < 2**62:
        return (entries * n - np.array(total, np.int64)) / n
    whole = entries.astype(object) * n - np.array(total, object)
    return (whole / n).astype(np.float64)


def _deviations(entries: np.ndarray, n: int, total: list[int]) -> pa.Array:
    reach = int(np.abs(entries).max()) * n + max(map(abs, total))
    if reach * reach * entries.shape[1] < 2**63:
        apart = entries * n - np.array(total, np.int64)
        return pa.array((apart * apart).sum(axis=1))
    apart = entries.astype(object) * n - np.array(total, object)
    return pa.array([v if v < 2**63 else None for v in (apart * apart).sum(axis=1)], pa.int64())


# -- sums over all vectors ----------------------------------------------------------------------------------------


def integer_sums(source: DataFrame, dimension: int) -> dict[tuple[int, int], int]:
    """Exact sums of products of every two of (1, entries), by pairs of places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((dimension + 1, dimension + 1), object)
        for batch in batches:
            for _, entries in _blocks(batch, dimension):
                with_one = np.column_stack([np.ones(len(entries), np.int64), entries])
                if np.abs(entries).max() < EXACT:
                    small = with_one.astype(np.float64)
                    sums += (small.T @ small).astype(np.int64).astype(object)
                else:
                    large = with_one.astype(object)
                    sums += large.T @ large
        rows = [(i, j, k, limb) for i in range(dimension + 1) for j in range(i, dimension + 1)
                for k, limb in enumerate(_limbs(int(sums[i, j])))]
        if rows:
            i, j, k, limb = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(k, pa.int32()),
                                              pa.array(limb, pa.int64())], ["i", "j", "limb", "part"])

    parts = source.mapInArrow(run, "i int, j int, limb int, part long").groupBy("i", "j", "limb").agg(
        F.sum("part").alias("part"))
    sums: dict[tuple[int, int], int] = {}
    for r in parts.collect():  # one row for each pair of dimensions and limb
        sums[r.i, r.j] = sums.get((r.i, r.j), 0) + (r.part << LIMB * r.limb)
    return sums


def _limbs(value: int) -> list[int]:
    """Digits to the base 2**LIMB; the last one carries the sign. Zero has none."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value] if value or out else []


def centred(sums: dict[tuple[int, int], int], dimension: int) -> tuple[int, list[int], list[list[int]]]:
    """``(n, sums of entries, n * n times the covariance)``, all exact."""
    n = sums.get((0, 0), 0)
    total = [sums.get((0, i + 1), 0) for i in range(dimension)]
    scatter = [[n * sums.get((min(i, j) + 1, max(i, j) + 1), 0) - total[i] * total[j] for j in range(dimension)]
               for i in range(dimension)]
    return n, total, scatter


def _identity_error(source: DataFrame, n: int, total: list[int], scale: np.ndarray) -> float:
    dimension, k = scale.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k + 1, k + 1))
        for batch in batches:
            for _, entries in _blocks(batch, dimension):
                white = np.column_stack([np.ones(len(entries)), _deviation_floats(entries, n, total) @ scale])
                sums += white.T @ white
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([i.astype(np.int32), j.astype(np.int32), sums[i, j]], ["i", "j", "part"])

    # Decimals add up to the same in any order.
    rows = source.mapInArrow(run, "i int, j int, part double").groupBy("i", "j").agg(
        F.sum(F.col("part").cast("decimal(38,18)")).cast("double").alias("s")).collect()
    found = {(r.i, r.j): r.s for r in rows}
    mean = [found[0, i + 1] / n for i in range(k)]
    return max(abs(found[i + 1, j + 1] / n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k))


# -- characteristic polynomial ------------------------------------------------------------------------------------


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than ``bits`` bits."""
    found, have, p = [], 0, 2**31 + 1
    while have <= bits:
        p -= 2
        if _is_prime(p):
            found.append(p)
            have += p.bit_length() - 1
    return found


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test, which has no false answers below 2**31 with these bases."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo ``p``, from the constant on, by way of Hessenberg form."""
    a = matrix % p
    d = len(a)
    for c in range(d - 2):
        rows = np.flatnonzero(a[c + 1:, c])
        if not len(rows):
            continue
        r = c + 1 + int(rows[0])
        a[[c + 1, r]] = a[[r, c + 1]]
        a[:, [c + 1, r]] = a[:, [r, c + 1]]
        factor = a[c + 2:, c] * pow(int(a[c + 1, c]), -1, p) % p
        a[c + 2:] = (a[c + 2:] - factor[:, None] * a[c + 1] % p) % p
        a[:, c + 1] = (a[:, c + 1] + (a[:, c + 2:] * factor % p).sum(axis=1)) % p
    # Row k holds the polynomial of the first k rows and columns.
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(d):
        weights, chain = np.zeros(k + 1, np.int64), 1
        weights[k] = a[k, k]
        for i in range(k - 1, -1, -1):
            chain = chain * int(a[i + 1, i]) % p
            weights[i] = int(a[i, k]) * chain % p
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - (weights[:, None] * minors[:k + 1] % p).sum(axis=0)) % p
    return minors[d]


def characteristic_polynomial(spark, scatter: list[list[int]]) -> list[int]:
    """Exact coefficients, from the constant on, of the scatter's characteristic polynomial."""
    d = len(scatter)
    trace = sum(scatter[i][i] for i in range(d))
    # The sum of all coefficients' sizes is the product of (1 + root), at most the mean's power.
    moduli = primes(d * (2 + trace // d).bit_length() + 1)
    sent = spark.sparkContext.broadcast((scatter, moduli))  # as large as the square of the dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, moduli = sent.value
        matrix = np.array(matrix, object)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                residues = polynomial_modulo((matrix % moduli[i]).astype(np.int64), moduli[i])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([residues.tolist()])],
                                                 ["i", "residues"])

    tasks = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(moduli), 1, tasks).mapInArrow(run, "i long, residues array<long>").collect()
    whole = 1
    for p in moduli:
        whole *= p
    out = [0] * (d + 1)
    for r in rows:
        p = moduli[r.i]
        others = whole // p
        part = others * pow(others, -1, p)
        for k, residue in enumerate(r.residues):
            out[k] += residue * part
    # Signs alternate, as no root is negative.
    return [c % whole if (d - k) % 2 == 0 else -(-c % whole) for k, c in enumerate(out)]


# -- roots and components -----------------------------------------------------------------------------------------


def roots_above(polynomial: list[int], c: int, shift: int) -> int:
    """How many roots lie above c / 2**shift. Exact, as all roots are real: the signs of the shifted polynomial change
    once for each."""
    d = len(polynomial) - 1
    a = [x << shift * (d - i) for i, x in enumerate(polynomial)]
    if c:
        for i in range(d):
            for j in range(d - 1, i - 1, -1):
                a[j] += c * a[j + 1]
    signs = [x > 0 for x in a if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _sign(polynomial: list[int], c: int, shift: int) -> int:
    d, value = len(polynomial) - 1, 0
    for i in range(d, -1, -1):
        value = value * c + (polynomial[i] << shift * (d - i))
    return (value > 0) - (value < 0)


def root(polynomial: list[int], k: int, top: int) -> tuple[Fraction, int, int]:
    """The ``k``-th largest root, which is positive and at most ``top``, to ``BITS`` bits, and the first and last number
    of the roots that are equal to it as far as those bits tell."""
    lo, hi, shift = 0, top + 1, 0
    below, above = None, 0  # roots above lo and above hi
    below = roots_above(polynomial, 0, 0)
    while hi - lo > lo >> BITS or not lo:
        if hi - lo == 1:
            lo, hi, shift = 2 * lo, 2 * hi, shift + 1
        mid = (lo + hi) // 2
        if below - above == 1:
            sign = _sign(polynomial, mid, shift)
            if sign == 0:
                return Fraction(mid, 1 << shift), k, k
            lo, hi = (mid, hi) if sign == (-1) ** k else (lo, mid)
            continue
        count = roots_above(polynomial, mid, shift)
        if count >= k:
            lo, below = mid, count
        else:
            hi, above = mid, count
    return Fraction(lo + hi, 2 << shift), above + 1, below


def null_space(scatter: list[list[int]], value: Fraction, size: int) -> np.ndarray:
    """Orthonormal columns that span the space of an eigenvalue of that multiplicity, by inverse iteration."""
    d = len(scatter)
    with localcontext() as context:
        context.prec = DIGITS
        shifted = np.array([[Decimal(x) for x in r] for r in scatter], object)
        centre = Decimal(value.numerator) / Decimal(value.denominator)
        shifted[np.arange(d), np.arange(d)] -= centre
        rng = random.Random(11)
        space = np.array([[Decimal(rng.randint(-1000, 1000)) for _ in range(size)] for _ in range(d)], object)
        lower, order = _factors(shifted, centre * Decimal(10) ** (20 - DIGITS))
        for _ in range(6):
            space = _orthonormal(_solved(shifted, lower, order, space))
        out = space.astype(np.float64)
    peak = out[np.abs(out).argmax(axis=0), np.arange(size)]
    return out * np.where(peak < 0, -1.0, 1.0)


def _factors(a: np.ndarray, least: Decimal) -> tuple[np.ndarray, list[int]]:
    """Gauss elimination in place with row exchanges; a pivot that vanishes is given a tiny size."""
    d, order = len(a), []
    lower = np.full((d, d), Decimal(0), object)
    for c in range(d):
        r = c + int(np.abs(a[c:, c]).argmax())
        order.append(r)
        a[[c, r]] = a[[r, c]]
        lower[[c, r]] = lower[[r, c]]
        if abs(a[c, c]) < least:
            a[c, c] = least
        factor = a[c + 1:, c] / a[c, c]
        lower[c + 1:, c] = factor
        a[c + 1:, c:] -= factor[:, None] * a[c, c:]
    return lower, order


def _solved(upper: np.ndarray, lower: np.ndarray, order: list[int], right: np.ndarray) -> np.ndarray:
    x, d = right.copy(), len(upper)
    for c, r in enumerate(order):
        x[[c, r]] = x[[r, c]]
    for c in range(d):
        x[c + 1:] -= lower[c + 1:, c, None] * x[c]
    for c in range(d - 1, -1, -1):
        x[c] = x[c] / upper[c, c]
        x[:c] -= upper[:c, c, None] * x[c]
    return x


def _orthonormal(space: np.ndarray) -> np.ndarray:
    for c in range(space.shape[1]):
        for _ in range(2):
            for e in range(c):
                space[:, c] -= space[:, e] * (space[:, e] * space[:, c]).sum()
            space[:, c] /= (space[:, c] * space[:, c]).sum().sqrt()
    return space


def principal_components(spark, scatter: list[list[int]], polynomial: list[int], count: int):
    """The ``count`` largest roots, as fractions, and their unit eigenvectors as columns; a task each."""
    top = sum(scatter[i][i] for i in range(len(scatter)))
    sent = spark.sparkContext.broadcast((scatter, polynomial))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter, polynomial = sent.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                value, first, last = root(polynomial, i + 1, top)
                vector = null_space(scatter, value, last - first + 1)[:, i + 1 - first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([str(value)]), pa.array([vector.tolist()])],
                    ["i", "value", "vector"])

    rows = spark.range(0, count, 1, count).mapInArrow(run, "i long, value string, vector array<double>").collect()
    rows = sorted(rows, key=lambda r: r.i)
    return [Fraction(r.value) for r in rows], np.array([r.vector for r in rows]).T
