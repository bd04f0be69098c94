"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Spark adds up the scatter of the distinct cell vectors in exact integers. Its characteristic polynomial comes from
Hessenberg reductions modulo primes, put together by Chinese remaindering; its roots are isolated by counting sign
changes, exact for a polynomial whose roots are all real, and the components are null-space vectors found by inverse
iteration. What the driver handles is one dimension x dimension matrix, however many rows there are.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiltx.llm.common import carried, ship, uncarried
from vigiltx.sources.shared import materialize

#: Cells are floor(SCALE * x) + SHIFT.
SCALE = 64
SHIFT = 1_000_000
#: Cells are taken up to here, so that they fit a long with room to spare.
LARGEST = float(1 << 61)
#: Bits of a limb; 2 ** 12 products of two limbs still add up exactly in a double.
LIMB = 20
BLOCK = 1 << 12
#: Bits of the largest root on the grid that roots are found on, and decimal digits of inverse iteration.
GRID = 160
DIGITS = 90


@dataclass(frozen=True)
class Scatter:
    """``n`` distinct vectors of cells less SHIFT: their ``sums`` and n x scatter about the mean, ``n2cov``, exactly."""

    n: int
    sums: list[int]
    n2cov: list[list[int]]


@dataclass(frozen=True)
class Whitening:
    """``vectors``: one unit component a row, by falling ``variance``."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float


def cells(vector: Column) -> Column:
    """The cells less SHIFT as longs; null for a vector that takes no part."""
    x = vector.cast("array<double>")
    scaled = F.transform(x, lambda v: F.floor(v * float(SCALE)))
    usable = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < LARGEST / SCALE)) & (F.size(x) > 0)
    return F.when(usable, scaled)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles l with y = sum of l[k] << (LIMB * k), each small enough for exact products."""
    out = []
    while np.abs(y).max(initial=0) >= 1 << LIMB:
        out.append((y & ((1 << LIMB) - 1)).astype(float))
        y = y >> LIMB
    return [*out, y.astype(float)]


def products(y: np.ndarray) -> np.ndarray:
    """y.T @ y in Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), BLOCK):
        block = y[at : at + BLOCK]
        parts = _limbs(block)
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _frames(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    for batch in batches:
        if len(batch):
            yield np.stack(batch["x"].to_numpy()).astype(np.int64)


def scatter(distinct: DataFrame, width: int) -> Scatter:
    """Of rows ``x``, all of ``width`` cells and none twice.

    Each task sends one row for each pair of dimensions, whose parts Spark adds up in decimals.
    """
    part = 1 << 60

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, np.zeros((width + 1, width), object)
        for y in _frames(batches):
            n += len(y)
            total[:width] += products(y)
            total[width] += np.array([sum(map(int, column)) for column in y.T], object)
        if n:
            i, j = np.nonzero(np.arange(width + 1)[:, None] >= np.arange(width)[None, :])
            flat = [int(v) for v in total[i, j]]
            rows = {"i": i, "j": j, "low": [v % part for v in flat], "mid": [(v // part) % part for v in flat], "high": [v // part**2 for v in flat]}
            yield pd.DataFrame(rows | {"n": n})

    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "mid", "high", "n")]
    rows = distinct.select("x").mapInPandas(added, "i int, j int, low long, mid long, high long, n long")
    got = rows.groupBy("i", "j").agg(*sums).collect()
    found = {(r.i, r.j): int(r.low) + int(r.mid) * part + int(r.high) * part**2 for r in got}
    n = int(got[0].n)
    sums = [found[width, j] for j in range(width)]
    full = [[n * found[max(i, j), min(i, j)] - sums[i] * sums[j] for j in range(width)] for i in range(width)]
    return Scatter(n, sums, full)


def primes(below: int) -> Iterator[int]:
    """Primes in falling order, by the Miller-Rabin test with bases that decide every number below 2 ** 32."""

    def is_prime(p: int) -> bool:
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for base in (2, 7, 61):
            x = pow(base, d, p)
            if x in (1, p - 1):
                continue
            if not any((x := x * x % p) == p - 1 for _ in range(s - 1)):
                return False
        return True

    yield from (p for p in range(below | 1, 1 << 20, -2) if is_prime(p))


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients modulo p, lowest first, of det(t - matrix), through a similar Hessenberg matrix."""
    h, d = matrix.copy() % p, len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    # p_k = (t - h_kk) p_(k-1) - sum over i of h_(k-i,k) x the subdiagonal between x p_(k-i-1)
    rows = np.zeros((d + 1, d + 1), np.int64)
    rows[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = rows[k, :-1]
        new = (new - h[k, k] * rows[k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            new = (new - (int(h[i, k]) * chain % p) * rows[i] % p) % p
        rows[k + 1] = new
    return [int(c) for c in rows[d]]


def _remaindered(parts: Iterator[tuple[int, list[int]]], bits: int) -> list[int]:
    """The integers, below 2 ** bits in size, that have these remainders."""
    value, product = None, 1
    for p, rest in parts:
        if value is None:
            value = [0] * len(rest)
        inverse = pow(product, -1, p)
        value = [v + product * ((r - v) * inverse % p) for v, r in zip(value, rest, strict=True)]
        product *= p
        if product.bit_length() > bits + 2:
            break
    return [v - product if 2 * v > product else v for v in value]


def characteristic(matrix: list[list[int]]) -> list[int]:
    """Coefficients, lowest first, of det(t - matrix) of a positive semidefinite integer matrix.

    Its k-th symmetric function of the roots is at most C(d, k) (trace / d) ** k, which bounds the primes needed.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bits = d * (max(trace // d, 1).bit_length() + 1) + d + 1
    whole = np.array(matrix, object)
    return _remaindered(((p, polynomial_modulo((whole % p).astype(np.int64), p)) for p in primes((1 << 31) - 1)), bits)


def _trimmed(p: list[int]) -> list[int]:
    while len(p) > 1 and not p[-1]:
        p = p[:-1]
    return p


def _gcd_modulo(a: list[int], b: list[int], p: int) -> list[int]:
    a, b = _trimmed([x % p for x in a]), _trimmed([x % p for x in b])
    while b != [0]:
        inverse = pow(b[-1], -1, p)
        while len(a) >= len(b) and a != [0]:
            factor, at = a[-1] * inverse % p, len(a) - len(b)
            a = _trimmed([(x - factor * b[i - at]) % p if i >= at else x for i, x in enumerate(a)][:-1] or [0])
        a, b = b, a
    inverse = pow(a[-1], -1, p)
    return [x * inverse % p for x in a]


def _divided(a: list[int], b: list[int]) -> tuple[list[int], bool]:
    """a / b for monic b, and whether it leaves no remainder."""
    rest, out = list(a), [0] * max(len(a) - len(b) + 1, 1)
    for at in range(len(a) - len(b), -1, -1):
        out[at] = factor = rest[at + len(b) - 1]
        if factor:
            for i, x in enumerate(b):
                rest[at + i] -= factor * x
    return out, not any(rest)


def _derivative(p: list[int]) -> list[int]:
    return [k * c for k, c in enumerate(p)][1:]


def repeated_part(p: list[int]) -> list[int]:
    """The monic greatest common divisor of a monic polynomial and its derivative.

    Found modulo primes; the degree modulo a prime is never too low, and an exact division proves the result.
    """
    slope = _derivative(p)
    best: list[tuple[int, list[int]]] = []
    for prime in primes((1 << 31) - 1):
        g = _gcd_modulo(p, slope, prime)
        if len(g) == 1:
            return [1]
        if best and len(g) > len(best[0][1]):
            continue
        if best and len(g) < len(best[0][1]):
            best = []
        best.append((prime, g))
        if len(best) & (len(best) - 1) == 0:
            found = _remaindered(iter(best), 1 << 40)
            if _divided(p, found)[1] and _divided(slope, found)[1]:
                return found
    raise ArithmeticError("no common divisor")


def _value(p: list[int], at: int) -> int:
    out = 0
    for c in reversed(p):
        out = out * at + c
    return out


def _above(p: list[int], at: int) -> int:
    """How many roots lie above: the sign changes of the coefficients about ``at``, as all roots are real."""
    p = list(p)
    for i in range(len(p) - 1):
        for k in range(len(p) - 2, i - 1, -1):
            p[k] += at * p[k + 1]
    signs = [c > 0 for c in p if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def top_roots(p: list[int], wanted: int) -> list[tuple[int, int]]:
    """(root, multiplicity), largest first, until ``wanted`` positive roots are there; a root is the grid point below it.

    ``p`` is monic with real roots that are not negative, given on a grid on which distinct ones differ by a point or more.
    """
    # levels[m]: the square-free polynomial of the roots that are there more than m times
    levels, rest = [], p
    while len(rest) > 1:
        again = repeated_part(rest)
        levels.append(_divided(rest, again)[0])
        rest = again
    if not levels:
        return []
    free = levels[0]
    highest = 1
    while _above(free, highest):
        highest *= 2
    found: list[tuple[int, int]] = []

    def isolate(low: int, high: int, over: int, under: int) -> None:
        """Roots in (low, high], of which ``over`` lie above high and ``under`` above low; the upper half first."""
        if under == over or sum(m for _, m in found) >= wanted:
            return
        if under - over == 1 or high - low == 1:
            if under - over > 1:
                raise FloatingPointError("roots closer than the grid")
            found.append((low, 1) if high - low == 1 else (refine(low, high), 1))
            place = found[-1][0]
            times = sum(_above(level, place) - _above(level, place + 1) for level in levels)
            found[-1] = (place, times)
            return
        middle = (low + high) // 2
        between = _above(free, middle)
        isolate(middle, high, over, between)
        isolate(low, middle, between, under)

    def refine(low: int, high: int) -> int:
        """The grid point below the one root in (low, high], by its change of sign."""
        sign = _value(free, high)
        if sign == 0:
            return high - 1
        while high - low > 1:
            middle = (low + high) // 2
            value = _value(free, middle)
            if value == 0:
                return middle - 1
            if (value > 0) == (sign > 0):
                high = middle
            else:
                low = middle
        return low

    isolate(0, highest, 0, _above(free, 0))
    return found


def null_space(matrix: list[list[int]], root: Decimal, size: int, draw: np.random.Generator) -> list[np.ndarray]:
    """``size`` orthonormal vectors that ``matrix`` multiplies by ``root``, by inverse iteration in long decimals."""
    d = len(matrix)
    a = np.array([[Decimal(x) for x in row] for row in matrix], object)
    for i in range(d):
        a[i, i] -= root
    tiny = max(abs(x) for x in a.ravel()) * Decimal(10) ** (5 - DIGITS) or Decimal(1)
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
    found: list[np.ndarray] = []
    while len(found) < size:
        v = np.array([Decimal(int(x)) for x in draw.integers(1, 1000, d)], object)
        for _ in range(3):
            v = v[order]
            for k in range(d):
                v[k + 1 :] -= a[k + 1 :, k] * v[k]
            for k in range(d - 1, -1, -1):
                v[k] /= a[k, k]
                v[:k] -= a[:k, k] * v[k]
            for _ in range(2):
                for other in found:
                    v = v - other * (v @ other)
            v = v / (v @ v).sqrt()
        found.append(v)
    return found


def solve(moments: Scatter, components: int) -> Whitening:
    """The components of positive variance, at most ``components``, with everything a row needs."""
    a, n = moments.n2cov, moments.n
    d, trace = len(a), sum(a[i][i] for i in range(len(a)))
    if trace == 0:
        return Whitening(n, moments.sums, np.zeros((0, d)), np.zeros(0), np.zeros(0), 0.0)
    exact = characteristic(a)
    bits = max(GRID - trace.bit_length(), 0)
    while True:
        try:
            # t -> t * 2 ** bits, so that roots lie on an integer grid
            roots = top_roots([c << (bits * (d - k)) for k, c in enumerate(exact)], components)
            break
        except FloatingPointError:
            bits += GRID
    with decimal.localcontext() as context:
        context.prec = DIGITS + bits // 3
        draw = np.random.default_rng(5)
        vectors, values = [], []
        for place, times in roots:
            root = (2 * Decimal(place) + 1) / Decimal(2 ** (bits + 1))
            vectors += null_space(a, root, times, draw)
            values += [root] * times
        vectors, values = vectors[:components], values[:components]
        rounded = np.array([[float(x) for x in v] for v in vectors]).reshape(len(vectors), d)
        rounded *= np.where(rounded[np.arange(len(rounded)), np.abs(rounded).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
        variance = np.array([float(v / n**2) for v in values])
        # The covariance of what is returned: from the rounded components, the matrix being exact.
        v = np.array([[Decimal(float(x)) / (Decimal(float(e)) * n**2).sqrt() for x in row] for row, e in zip(rounded, variance, strict=True)], object)
        covariance = v @ np.array([[Decimal(x) for x in row] for row in a], object) @ v.T
        error = max((abs(covariance[i, j] - (i == j)) for i in range(len(v)) for j in range(len(v))), default=Decimal(0))
        explained = np.array([float(x / trace) for x in values])
    return Whitening(n, moments.sums, rounded, variance, explained, float(error))


def fit(vectors: DataFrame, components: int) -> Whitening | None:
    """Of rows ``x`` of cells; None where there are none.

    Cells of equal vectors count once. Rows need the commonest number of dimensions, see ``whiten``.
    """
    width = commonest_size(vectors)
    if width is None:
        return None
    distinct = materialize(vectors.where(F.size("x") == width).select("x").distinct(), "cells")
    return solve(scatter(distinct, width), components)


def commonest_size(vectors: DataFrame) -> int | None:
    sizes = vectors.where("x is not null").groupBy(F.size("x").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return None if first is None else first["size"]


ADDED = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def whiten(df: DataFrame, vector: str = "embedding", *, components: int = 16) -> DataFrame:
    """One row for each row of ``df`` and component, numbered from 1 by falling variance, with ``ADDED`` columns.

    A vector that is null, empty, or holds a null, a non-finite entry or one beyond 2 ** 55 takes no part; nor do vectors
    whose number of dimensions is not the commonest one (the larger of two as common). Equal cell vectors count once in
    the fit, and every row gets its values. A component needs a positive variance: if all vectors are equal there is none
    and the result is empty; fewer dimensions or a lower rank than ``components`` give fewer. Components of equal variance
    are some orthonormal basis, the same for all rows. ``deviation`` is a decimal(38,0). Input columns named as an output
    are replaced.
    """
    ship(df.sparkSession)
    taken = carried(df, cells(F.col(vector)).alias("x")).where("x is not null")
    model = fit(taken.select("x"), components)
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.vectors):
        none = [F.lit(None).cast(t.split()[1]) for t in schema.split(", ")]
        return uncarried(taken.where("false"), df.columns, *(c.alias(a) for c, a in zip(none, ADDED, strict=True)), added=ADDED)
    n, sums = model.n, np.array(model.sums, object)
    width = len(sums)
    axes = model.vectors / np.sqrt(model.variance)[:, None]
    fits = max(map(abs, model.sums)) < 1 << 61

    @F.pandas_udf("struct<deviation: string, whitened: array<double>>")
    def projected(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                yield pd.DataFrame({"deviation": [], "whitened": []})
                continue
            y = np.stack(batch.to_numpy()).astype(np.int64)
            largest = int(np.abs(y).max(initial=0)) * n + max(map(abs, model.sums))
            small = fits and largest**2 * width < 1 << 62
            away = y * n - sums.astype(np.int64) if small else y.astype(object) * n - sums
            deviation = (away * away).sum(axis=1)
            centred = away.astype(float) / n
            out = np.zeros((len(y), len(axes)))
            for j in range(width):  # one dimension after the other, so that batches of any size give the same bits
                out += centred[:, j, None] * axes[None, :, j]
            yield pd.DataFrame({"deviation": [str(v) for v in deviation], "whitened": list(out)})

    rows = taken.where(F.size("x") == width).select("_row", projected("x").alias("p"))
    rows = rows.select("_row", F.col("p.deviation").alias("_deviation"), F.posexplode("p.whitened").alias("_place", "_whitened"))
    share = F.array(*map(F.lit, map(float, model.explained)))
    values = (
        (F.col("_place") + 1).cast("int"), F.lit(n).cast("long"), F.col("_deviation").cast("decimal(38,0)"), F.col("_whitened"),
        F.element_at(share, F.col("_place") + 1), F.lit(model.identity_error),
    )
    return uncarried(rows, df.columns, *(v.alias(a) for v, a in zip(values, ADDED, strict=True)), added=ADDED)

