"""Eigenvalues and eigenvectors of an integer symmetric matrix, by its exact characteristic polynomial.

Modulo each of enough primes the matrix is reduced to Hessenberg form and its polynomial read off; Chinese remaindering gives the
integer coefficients. All roots are real, so the sign changes of the polynomial shifted to `a` count the roots above `a` exactly
(with multiplicity), and bisection isolates them to any precision. A component is a vector of the null space at its root: inverse
iteration in long decimals, orthogonal to the components found before, so that multiple roots give as many vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal, localcontext
from math import comb, isqrt

import numpy as np

#: Relative width, in bits, to which roots are isolated: roots nearer to each other count as one multiple root.
ROOT_BITS = 192
#: Decimal digits of the null-space iteration.
DIGITS = 90


def primes_below(limit: int, bits: int) -> list[int]:
    """The largest primes below `limit` whose product has more than so many bits."""
    small = [p for p in range(2, isqrt(limit) + 1) if all(p % q for q in range(2, isqrt(p) + 1))]
    step = np.array(small)
    out, n, product = [], limit - 1, 1
    while product.bit_length() <= bits:
        if (n % step).all():
            out.append(n)
            product *= n
        n -= 1
    return out


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits that hold twice any coefficient of a positive semidefinite matrix: the k-th is at most comb(d, k) * (trace / d) ** k."""
    d, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    return max((comb(d, k) * (trace // d + 1) ** k).bit_length() for k in range(d + 1)) + 2


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, highest first, of the characteristic polynomial modulo a prime below 2**31; entries are residues."""
    h = matrix.astype(np.int64) % p
    d = len(h)
    for j in range(d - 2):  # below the first subdiagonal, column j becomes zero
        rows = np.flatnonzero(h[j + 1 :, j])
        if not len(rows):
            continue
        k = j + 1 + int(rows[0])
        if k != j + 1:
            h[[j + 1, k]] = h[[k, j + 1]]
            h[:, [j + 1, k]] = h[:, [k, j + 1]]
        factor = h[j + 2 :, j] * pow(int(h[j + 1, j]), -1, p) % p
        h[j + 2 :] = (h[j + 2 :] - factor[:, None] * h[j + 1] % p) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2 :] * factor % p).sum(axis=1)) % p
    # polynomials of the leading blocks, lowest power first
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        poly = np.roll(polys[k - 1], 1)
        poly = (poly - h[k - 1, k - 1] * polys[k - 1]) % p
        path = 1
        for i in range(k - 1, 0, -1):
            path = path * int(h[i, i - 1]) % p
            if not path:
                break
            poly = (poly - path * int(h[i - 1, k - 1]) % p * polys[i - 1]) % p
        polys[k] = poly
    return polys[d, ::-1].tolist()


def by_remainders(parts: Iterable[tuple[int, list[int]]]) -> list[int]:
    """Integers, negative ones too, from their residues modulo several primes."""
    value, modulus = None, 1
    for p, residues in parts:
        if value is None:
            value = [0] * len(residues)
        inverse = pow(modulus % p, -1, p)
        value = [v + modulus * ((r - v) * inverse % p) for v, r in zip(value, residues, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value or []]


class Roots:
    """Counts and signs of a monic integer polynomial with real roots only, at dyadic points."""

    def __init__(self, coefficients: list[int]) -> None:
        self.coefficients = coefficients  # highest first

    def above(self, a: int, shift: int = 0) -> int:
        """Roots greater than a / 2**shift, with multiplicity: sign changes of the polynomial shifted there."""
        c = [x << (shift * i) for i, x in enumerate(self.coefficients)]  # roots times 2**shift
        for end in range(len(c), 1, -1):
            for i in range(1, end):
                c[i] += a * c[i - 1]
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def sign(self, a: int, shift: int) -> int:
        value, scale = 0, 0
        for c in self.coefficients:
            value = value * a + (c << scale)
            scale += shift
        return (value > 0) - (value < 0)

    def largest(self, count: int, bits: int = ROOT_BITS) -> Iterator[tuple[Decimal, int]]:
        """The positive roots, largest first, each with its multiplicity, until `count` are named."""
        total = self.above(0)
        top = 1
        while self.above(top):
            top *= 2
        todo, found = [(0, top, 0, total, 0)], 0  # roots in (low, high] / 2**shift, those above low, those above high
        while todo and found < count:
            low, high, shift, many, few = todo.pop()
            if many == few:
                continue
            if many - few == 1:
                yield self._narrowed(low, high, shift, bits), 1
                found += 1
                continue
            if low and high - low << bits <= low:
                yield self._decimal(low + high, shift + 1), many - few
                found += many - few
                continue
            if high - low == 1:
                low, high, shift = 2 * low, 2 * high, shift + 1
            middle = (low + high) // 2
            between = self.above(middle, shift)
            todo += [(low, middle, shift, many, between), (middle, high, shift, between, few)]

    def _narrowed(self, low: int, high: int, shift: int, bits: int) -> Decimal:
        """One simple root in (low, high] / 2**shift."""
        at_high = self.sign(high, shift)
        if not at_high:
            return self._decimal(high, shift)
        while not low or high - low << bits > low:
            if high - low == 1:
                low, high, shift = 2 * low, 2 * high, shift + 1
            middle = (low + high) // 2
            at = self.sign(middle, shift)
            if not at:
                return self._decimal(middle, shift)
            low, high = (low, middle) if at == at_high else (middle, high)
        return self._decimal(low + high, shift + 1)

    @staticmethod
    def _decimal(value: int, shift: int) -> Decimal:
        with localcontext() as c:
            c.prec = 2 * DIGITS
            return Decimal(value) / (1 << shift)


def _eliminated(rows: np.ndarray, tiny: Decimal) -> tuple[np.ndarray, list[int]]:
    """LU by rows with pivoting, in place; a vanishing pivot becomes a tiny one, as inverse iteration wants."""
    d, order = len(rows), list(range(len(rows)))
    for j in range(d):
        k = max(range(j, d), key=lambda i: abs(rows[i, j]))
        if k != j:
            rows[[j, k]] = rows[[k, j]]
            order[j], order[k] = order[k], order[j]
        if abs(rows[j, j]) < tiny:
            rows[j, j] = tiny
        if j + 1 < d:
            factor = rows[j + 1 :, j] / rows[j, j]
            rows[j + 1 :, j] = factor
            rows[j + 1 :, j + 1 :] -= factor[:, None] * rows[j, j + 1 :]
    return rows, order


def _solved(lu: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    x = b[order].copy()
    for i in range(1, len(x)):
        x[i] -= lu[i, :i].dot(x[:i])
    for i in range(len(x) - 1, -1, -1):
        x[i] = (x[i] - (lu[i, i + 1 :].dot(x[i + 1 :]) if i + 1 < len(x) else 0)) / lu[i, i]
    return x


def components(matrix: list[list[int]], coefficients: list[int], count: int) -> tuple[list[Decimal], np.ndarray]:
    """The largest positive eigenvalues, falling, and their unit vectors as rows of doubles."""
    with localcontext() as c:
        c.prec = DIGITS
        a = np.array([[Decimal(x) for x in row] for row in matrix], object)
        size = max((abs(x) for row in matrix for x in row), default=0)
        values: list[Decimal] = []
        vectors: list[np.ndarray] = []
        rng = np.random.default_rng(12)
        for root, many in Roots(coefficients).largest(count):
            shifted = a.copy()
            shifted[np.diag_indices(len(a))] -= root
            lu, order = _eliminated(shifted, Decimal(size).scaleb(-DIGITS + 5))
            for _ in range(min(many, count - len(vectors))):
                x = np.array([Decimal(int(v)) for v in rng.integers(-999, 1000, len(a))], object)
                for _ in range(3):
                    for v in vectors:  # twice is enough: of a multiple root, what other starts have found
                        x = x - v * v.dot(x)
                    x = _solved(lu, order, x)
                    x = x / max(map(abs, x))
                for v in vectors:
                    x = x - v * v.dot(x)
                x = x / x.dot(x).sqrt()
                lead = x[max(range(len(x)), key=lambda i: abs(x[i]))]
                vectors.append(x if lead > 0 else -x)
                values.append(root)
        return values, np.array([[float(v) for v in x] for x in vectors]).reshape(-1, len(a))
