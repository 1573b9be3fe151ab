"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Entries are turned into whole numbers, so counts, sums and products of the vectors add up exactly, and so does the scatter matrix
n * sum(x x') - S S', which is n * n times the covariance. Its characteristic polynomial is computed modulo enough primes by reduction
to Hessenberg form, one task for some primes, and put together by Chinese remaindering. All its roots are real and none
is negative, so Descartes' rule counts them exactly: the largest are isolated by counting and refined by signs to about 60 digits. Each
component comes from the null space of the scatter less its root, by inverse iteration at 100 digits, and is rounded to doubles last.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinlake.llm.common import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMBS, LIMB = 5, 40  # a sum of products is at most 2 * 63 bits and the bits of the number of rows
DIGIT = 20  # bits: products of two and 4,096 of them added stay exact in a double
ROWS = 4_096
REFINED = 200  # bits of a root
CLUSTER = 100  # roots that agree in so many bits are taken as one
DIGITS = 100


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c))
    return F.coalesce(finite, F.lit(False))


def whole(vectors: np.ndarray) -> np.ndarray:
    """Entries as whole numbers, without the constant that covariances do not see."""
    scaled = np.floor(SCALE * vectors.astype(np.float64))
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        raise OverflowError("an entry of a vector is too large for a long")
    return scaled.astype(np.int64)


def products(x: np.ndarray) -> np.ndarray:
    """x' x as exact Python integers."""
    largest = int(np.abs(x).max(initial=0))
    if largest * largest * len(x) < 1 << 53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    digits, rest = [], x
    while len(digits) * DIGIT < max(1, largest.bit_length()):
        digits.append((rest & ((1 << DIGIT) - 1)).astype(np.float64))
        rest = rest >> DIGIT
    digits.append(rest.astype(np.float64))  # 0, or -1 for negative numbers
    out = np.zeros((x.shape[1],) * 2, dtype=object)
    for a, one in enumerate(digits):
        for b, other in enumerate(digits):
            out += (one.T @ other).astype(np.int64).astype(object) << (DIGIT * (a + b))
    return out


def _limbs(value: int) -> list[int]:
    low = [(value >> (LIMB * place)) & ((1 << LIMB) - 1) for place in range(LIMBS - 1)]
    return [*low, value >> (LIMB * (LIMBS - 1))]


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length, some at a time."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for some in range(0, len(places), ROWS):
            part = places[some : some + ROWS]
            flat = vectors.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(len(part), length)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: dict[int, int] = defaultdict(int)
    sums: dict[int, np.ndarray] = {}
    squares: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, part in _by_length(batch["vector"]):
            x, length = whole(part), part.shape[1]
            count[length] += len(x)
            total = np.array([int(high) << 32 for high in (x >> 32).sum(axis=0)], dtype=object)
            total = total + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            sums[length] = sums.get(length, 0) + total
            squares[length] = squares.get(length, 0) + products(x)
    rows = [(length, -1, -1, _limbs(n)) for length, n in count.items()]
    rows += [(length, -1, j, _limbs(int(one))) for length, many in sums.items() for j, one in enumerate(many)]
    rows += [(d, i, j, _limbs(int(many[i, j]))) for d, many in squares.items() for i in range(d) for j in range(i + 1)]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["d", "i", "j", "limbs"])


@dataclass
class Scatter:
    """Number of vectors, their sums and the exact scatter matrix, all of whole numbers."""

    n: int
    sums: list[int]
    matrix: list[list[int]]


def scatters(vectors: DataFrame) -> dict[int, Scatter]:
    """The scatter of the vectors of each length; at most (d + 2) * d rows of sums come to the driver for length d."""
    parts = vectors.mapInArrow(_add_up, "d int, i int, j int, limbs array<long>")
    limbs = [F.sum(F.col("limbs")[place]).alias(f"limb{place}") for place in range(LIMBS)]
    found: dict[int, dict] = defaultdict(dict)
    for row in parts.groupBy("d", "i", "j").agg(*limbs).collect():
        found[row.d][row.i, row.j] = sum(row[f"limb{place}"] << (LIMB * place) for place in range(LIMBS))
    out = {}
    for d, values in sorted(found.items()):
        n, sums = values[-1, -1], [values[-1, j] for j in range(d)]
        out[d] = Scatter(n, sums, [[n * values[max(i, j), min(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)])
    return out


def _is_prime(number: int) -> bool:
    """Miller and Rabin's test, certain below 3 * 10^9 with these bases."""
    odd, twos = number - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        power = pow(base, odd, number)
        if power in (1, number - 1):
            continue
        for _ in range(twos - 1):
            power = power * power % number
            if power == number - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes below 2^31 whose product is above ``bound``."""
    out, product, number = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(number):
            out.append(number)
            product *= number
        number -= 2
    return out


def polynomial_modulo(matrix: list[list[int]], prime: int) -> list[int]:
    """Coefficients of det(xI - A) modulo a prime below 2^31, the constant one first."""
    a = np.array([[value % prime for value in row] for row in matrix], dtype=np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factors = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, prime) % prime
        a[k + 2 :] = (a[k + 2 :] - factors[:, None] * a[k + 1] % prime) % prime
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factors % prime).sum(axis=1)) % prime
    # Polynomials of the leading blocks, by the last column of each.
    blocks = np.zeros((d + 1, d + 1), dtype=np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros(d + 1, dtype=np.int64)
        now[1:] = blocks[k - 1, :-1]
        now = (now - blocks[k - 1] * a[k - 1, k - 1]) % prime
        below = 1
        for i in range(k - 2, -1, -1):
            below = below * int(a[i + 1, i]) % prime
            if not below:
                break
            now = (now - blocks[i] * (below * int(a[i, k - 1]) % prime)) % prime
        blocks[k] = now
    return blocks[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(xI - A) of a positive semidefinite matrix, the constant one first."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The symmetric means of nonnegative roots are at most powers of their mean.
    bound = max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_for(2 * bound)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [polynomial_modulo(matrix, prime) for prime in batch["prime"].tolist()]
            yield pd.DataFrame({"prime": batch["prime"], "coefficients": found})

    # A row per prime: d * d numbers altogether grow with the width of the vectors, not with their number.
    given = spark.createDataFrame(pd.DataFrame({"prime": primes})).repartition(spark.sparkContext.defaultParallelism)
    rows = given.mapInPandas(reduce, "prime long, coefficients array<long>").collect()
    product = 1
    for prime in primes:
        product *= prime
    out = [0] * (d + 1)
    for row in rows:
        rest = product // row.prime
        unit = rest * pow(rest, -1, row.prime)
        for place, value in enumerate(row.coefficients):
            out[place] += value * unit
    out = [value % product for value in out]
    return [value - product if 2 * value > product else value for value in out]


def roots_above(polynomial: list[int], numerator: int, bits: int) -> int:
    """How many roots exceed numerator / 2**bits, for a polynomial with real roots only: sign changes after a shift."""
    d = len(polynomial) - 1
    shifted = [value << (bits * (d - place)) for place, value in enumerate(polynomial)]
    for begin in range(d):
        for place in range(d - 1, begin - 1, -1):
            shifted[place] += numerator * shifted[place + 1]
    signs = [value > 0 for value in shifted if value]
    return sum(one != other for one, other in zip(signs, signs[1:], strict=False))


def _sign(polynomial: list[int], numerator: int, bits: int) -> int:
    d, value = len(polynomial) - 1, 0
    for place in range(d, -1, -1):
        value = value * numerator + (polynomial[place] << (bits * (d - place)))
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], most: int) -> list[tuple[int, int, int]]:
    """``(numerator, bits, cluster)`` of the largest positive roots, falling; equal clusters mark roots that were not told apart."""
    d = len(polynomial) - 1
    positive = d - next(place for place, value in enumerate(polynomial) if value)
    high = -polynomial[d - 1] + 1  # above the sum of the roots
    out: list[tuple[int, int, int]] = []
    counts: dict[tuple[int, int], int] = {}

    def above(numerator: int, bits: int) -> int:
        while bits and numerator % 2 == 0:
            numerator, bits = numerator // 2, bits - 1
        if (numerator, bits) not in counts:
            counts[numerator, bits] = roots_above(polynomial, numerator, bits)
        return counts[numerator, bits]

    for number in range(1, min(most, positive) + 1):
        low, top, bits = 0, high, 0  # the root lies above low and not above top
        while True:
            inside = above(low, bits) - above(top, bits)
            if inside == 1 and low > 0:
                break
            if low >> CLUSTER:
                break
            if top - low == 1:
                low, top, bits = 2 * low, 2 * top, bits + 1
            middle = (low + top) // 2
            if above(middle, bits) >= number:
                low = middle
            else:
                top = middle
        inside = above(low, bits) - above(top, bits)
        if inside == 1:
            # The sign changes once in between, so signs are enough from here.
            if _sign(polynomial, top, bits) == 0:
                out.append((top, bits, number))
                continue
            at_top = _sign(polynomial, top, bits)
            while not low >> REFINED or top - low > 1:
                if top - low == 1:
                    low, top, bits = 2 * low, 2 * top, bits + 1
                middle = (low + top) // 2
                sign = _sign(polynomial, middle, bits)
                if sign == 0:
                    low, top = middle, middle
                    break
                low, top = (low, middle) if sign == at_top else (middle, top)
            out.append((top, bits, number))
        else:
            out.append((top, bits, above(top, bits) + 1))  # named by the first root among them
    return out


def _factor(a: list[list[Decimal]], tiny: Decimal) -> list[int]:
    """LU factors in place with row exchanges; pivots of zero become ``tiny``."""
    d, order = len(a), list(range(len(a)))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[pivot] = a[pivot], a[k]
        order[k], order[pivot] = order[pivot], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        top = a[k]
        for i in range(k + 1, d):
            row = a[i]
            if row[k]:
                factor = row[k] / top[k]
                row[k] = factor
                for j in range(k + 1, d):
                    row[j] -= factor * top[j]
    return order


def _solve(a: list[list[Decimal]], order: list[int], right: list[Decimal]) -> list[Decimal]:
    d = len(a)
    x = [right[i] for i in order]
    for i in range(d):
        x[i] -= sum((a[i][j] * x[j] for j in range(i)), Decimal(0))
    for i in range(d - 1, -1, -1):
        x[i] = (x[i] - sum((a[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / a[i][i]
    return x


def _unit(vector: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for _ in range(2):
        for other in others:
            along = sum((a * b for a, b in zip(vector, other, strict=True)), Decimal(0))
            vector = [a - along * b for a, b in zip(vector, other, strict=True)]
    size = sum((a * a for a in vector), Decimal(0)).sqrt()
    return [a / size for a in vector]


def components(matrix: list[list[int]], roots: list[tuple[int, int, int]]) -> list[list[Decimal]]:
    """Unit eigenvectors, one for each root; those of roots that were not told apart are made orthogonal."""
    out, d = [], len(matrix)
    with localcontext(Context(prec=DIGITS, Emax=10**9, Emin=-(10**9))):
        clusters: dict[int, list[list[Decimal]]] = defaultdict(list)
        factors: dict[int, tuple] = {}
        for number, (numerator, bits, cluster) in enumerate(roots):
            if cluster not in factors:
                root = Decimal(numerator) / Decimal(1 << bits)
                a = [[Decimal(value) - (root if i == j else 0) for j, value in enumerate(row)] for i, row in enumerate(matrix)]
                factors[cluster] = (a, _factor(a, root.scaleb(-DIGITS + 5)))
            vector = [Decimal((place * 7919 + number * 104_729 + 12_345) % 1009 - 504) + Decimal("0.5") for place in range(d)]
            for _ in range(3):
                vector = _unit(_solve(*factors[cluster], vector), clusters[cluster])
            clusters[cluster].append(vector)
            out.append(vector)
    return out


@dataclass
class Whitener:
    """What scoring needs: counts, sums, components over the roots of their scatter, shares of the trace."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float]


def fit(spark: SparkSession, scatter: Scatter, most: int = COMPONENTS) -> Whitener:
    """The components of falling eigenvalue; those of eigenvalue zero cannot be whitened and are left out."""
    d = len(scatter.sums)
    trace = sum(scatter.matrix[i][i] for i in range(d))
    if not trace:
        return Whitener(scatter.n, scatter.sums, np.zeros((d, 0)), [])
    roots = largest_roots(characteristic_polynomial(spark, scatter.matrix), most)
    vectors = components(scatter.matrix, roots)
    with localcontext(Context(prec=DIGITS, Emax=10**9, Emin=-(10**9))):
        values = [Decimal(numerator) / Decimal(1 << bits) for numerator, bits, _ in roots]
        weights = [[float(entry / value.sqrt()) for entry in vector] for vector, value in zip(vectors, values, strict=True)]
        explained = [float(value / trace) for value in values]
    return Whitener(scatter.n, scatter.sums, np.array(weights).T, explained)


def _apply(x: np.ndarray, model: Whitener) -> tuple[list[int], np.ndarray]:
    """Deviations and whitened values of whole-number vectors."""
    d = x.shape[1]
    largest = int(np.abs(x).max(initial=0)) * model.n + max(map(abs, model.sums), default=0)
    if largest * largest * max(1, d) < 1 << 63:
        away = x * model.n - np.array(model.sums, dtype=np.int64)
        deviations = (away * away).sum(axis=1).tolist()
    else:
        away = x.astype(object) * model.n - np.array(model.sums, dtype=object)
        deviations = [int(value) for value in (away * away).sum(axis=1)]
        if max(deviations, default=0) >= 1 << 63:
            raise OverflowError("a deviation is too large for a long")
    return deviations, away.astype(np.float64) @ model.weights


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each usable vector and component.

    Vectors that are NULL or hold NULL or non-finite entries are dropped. Vectors of each length are fitted and whitened among
    themselves, with n and identity_error of that length. Components with eigenvalue zero, as of a single or of equal vectors, cannot be
    whitened and have no rows; nor have vectors without entries. Equal eigenvalues give orthogonal components, the same in every run.
    Repeated rows and NULL ids keep their rows. Entries or deviations beyond a long raise OverflowError. Columns other than vec_id and
    embedding are not read.
    """
    session = embeddings.sparkSession
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter(usable(F.col("vector")))
    found = scatters(rows.select("vector"))
    models = {d: fit(session, scatter, most) for d, scatter in found.items() if d}

    @F.pandas_udf("deviation long, whitened array<double>")
    def score(vectors: pd.Series) -> pd.DataFrame:
        deviations, whitened = [0] * len(vectors), [[]] * len(vectors)
        for places, part in _by_length(pa.array(vectors, pa.list_(pa.float64()))):
            if part.shape[1] in models:
                some, values = _apply(whole(part), models[part.shape[1]])
                for place, deviation, value in zip(places.tolist(), some, values.tolist(), strict=True):
                    deviations[place], whitened[place] = deviation, value
        return pd.DataFrame({"deviation": deviations, "whitened": whitened})

    scored = rows.select("vec_id", F.size("vector").alias("d"), score("vector").alias("found"))
    scored = stored(scored.select("vec_id", "d", "found.deviation", "found.whitened"), "whitened")
    facts = []
    for d, model in models.items():
        k = len(model.explained)
        if k:
            error = identity_error(scored.filter(F.col("d") == d).select("whitened"), k)
            facts += [(d, place + 1, model.n, share, error) for place, share in enumerate(model.explained)]
    kinds = "d int, component int, n long, explained double, identity_error double"
    # At most eight rows for each length of vectors.
    facts = session.createDataFrame(facts, kinds)
    each = scored.select("vec_id", "d", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    each = each.withColumn("component", (F.col("place") + 1).cast("int")).drop("place")
    joined = each.join(facts, ["d", "component"])
    return joined.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest entry of the covariance of the first ``k`` whitened values less the identity, centred before multiplying."""
    value = [F.col("whitened")[place] for place in range(k)]
    means = rows.agg(*[F.avg(one).alias(f"m{place}") for place, one in enumerate(value)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    entries = [F.avg((value[i] - means[i]) * (value[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]
    found = rows.agg(*entries).first()
    return max(abs(entry - (i == j)) for entry, (i, j) in zip(found, pairs, strict=True))
