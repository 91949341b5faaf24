"""Exact characteristic polynomials of integer matrices, their real roots and eigenvectors, for matrices small enough to send.

A matrix has d * d whole numbers, so everything here is bounded by the dimension of the vectors and never by their number.
"""

from __future__ import annotations

import random
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np

Matrix = list[list[int]]


def is_prime(n: int) -> bool:
    """By Miller and Rabin; these bases decide every n below 2**32."""
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


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, the largest first, whose product is larger than ``bound``."""
    out, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bound(matrix: Matrix) -> int:
    """No coefficient of a positive semidefinite matrix's polynomial is larger: the k-th is at most C(d, k) * (trace / d)**k."""
    d = len(matrix)
    return (2 + sum(matrix[i][i] for i in range(d)) // d) ** d


def polynomial_mod(matrix: Matrix, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo the prime ``p`` (below 2**31), x**0 first, by reduction to Hessenberg form."""
    d = len(matrix)
    h = np.array([[a % p for a in row] for row in matrix], dtype=np.int64)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not below.size:
            continue
        r = k + 1 + int(below[0])
        if r != k + 1:
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        m = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :, k:] = (h[k + 2 :, k:] - m[:, None] * h[None, k + 1, k:] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * m % p).sum(axis=1)) % p
    leading = np.zeros((d + 1, d + 1), dtype=np.int64)  # row k: the polynomial of the leading k rows and columns
    leading[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = leading[k - 1, :-1]
        new -= h[k - 1, k - 1] * leading[k - 1] % p
        along, factors = 1, []
        for i in range(1, k):
            along = along * int(h[k - i, k - i - 1]) % p
            factors.append(int(h[k - 1 - i, k - 1]) * along % p)
        if factors:
            new -= (np.array(factors, dtype=np.int64)[:, None] * leading[k - 2 :: -1][: k - 1] % p).sum(axis=0)
        leading[k] = new % p
    return leading[d].tolist()


def combined(residues: dict[int, list[int]]) -> list[int]:
    """The whole numbers of least size with these residues by prime (Chinese remainders)."""
    values, modulus = None, 1
    for p, found in sorted(residues.items()):
        if values is None:
            values = list(found)
        else:
            inverse = pow(modulus, -1, p)
            values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, found, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values or []]


def _above(q: list[int], a: int) -> int:
    """How many roots of ``q`` are larger than ``a``: the sign changes of q(y + a), exact where all roots are real."""
    b = list(q)
    for i in range(len(b) - 1):
        for j in range(len(b) - 2, i - 1, -1):
            b[j] += a * b[j + 1]
    signs = [c > 0 for c in b if c]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _value(q: list[int], a: int) -> int:
    out = 0
    for c in reversed(q):
        out = out * a + c
    return out


def largest_roots(coefficients: list[int], most: int, bits: int = 100) -> list[tuple[Fraction, int]]:
    """The ``most`` largest positive roots of a polynomial with real, non-negative roots, falling, as (root, multiplicity).

    Intervals are halved until each holds one root or is narrower than ``bits`` bits of its end; roots closer than that
    count as one with their joint multiplicity, so the last entry may reach beyond ``most``.
    """
    q = list(coefficients)
    while len(q) > 1 and q[0] == 0:
        q = q[1:]
    positive = len(q) - 1
    most, scale = min(most, positive), bits
    while most:
        found = _isolated([c << (scale * (positive - i)) for i, c in enumerate(q)], most, bits, (1 - q[-2]) << scale)
        if found is not None:
            return [(Fraction(y, 1 << scale), m) for y, m in found]
        scale *= 2
    return []


def _isolated(q: list[int], most: int, bits: int, top: int) -> list[tuple[int, int]] | None:
    """As ``largest_roots``, for roots in whole steps; None where the steps are too wide for a root."""
    out, seen, stack = [], 0, [(0, top, len(q) - 1, 0)]
    while stack and seen < most:
        low, high, above_low, above_high = stack.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if high - low <= high >> bits:
            out.append((high, inside))
            seen += inside
            continue
        if high - low <= 1:
            return None
        middle = (low + high) // 2
        if inside == 1:
            end = _value(q, high)
            at = _value(q, middle)
            if end == 0 or at == 0:
                out.append((high if end == 0 else middle, 1))
                seen += 1
            elif (at > 0) == (end > 0):
                stack.append((low, middle, above_low, above_high))
            else:
                stack.append((middle, high, above_low, above_high))
            continue
        split = _above(q, middle)
        stack += [(low, middle, above_low, split), (middle, high, split, above_high)]
    return out


def null_space(matrix: Matrix, root: Fraction, multiplicity: int, digits: int = 80) -> list[list[float]]:
    """Unit vectors that span the eigenspace of ``root``, by inverse iteration with ``digits`` decimal digits."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = digits
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        lu, order = _factored([[Decimal(a) - (shift if i == j else 0) for j, a in enumerate(row)] for i, row in enumerate(matrix)], digits)
        draw = random.Random(d)
        block = _orthonormal([[Decimal(draw.randrange(1, 1000)) for _ in range(d)] for _ in range(multiplicity)])
        for _ in range(60):
            new = _orthonormal([_solved(lu, order, v) for v in block])
            moved = max(_outside(v, block) for v in new)
            block = new
            if moved < Decimal(10) ** -44:
                break
        return [[float(x) for x in v] for v in block]


def _factored(a: list[list[Decimal]], digits: int) -> tuple[list[list[Decimal]], list[int]]:
    """LU with row pivots; a pivot of zero becomes one of the size of rounding."""
    d, order = len(a), list(range(len(a)))
    least = max((abs(x) for row in a for x in row), default=Decimal(1)) * Decimal(10) ** -digits or Decimal(1)
    for k in range(d):
        r = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[r] = a[r], a[k]
        order[k], order[r] = order[r], order[k]
        if abs(a[k][k]) < least:
            a[k][k] = least
        pivot, rest = a[k][k], a[k][k + 1 :]
        for i in range(k + 1, d):
            if a[i][k]:
                f = a[i][k] / pivot
                a[i][k] = f
                a[i][k + 1 :] = [x - f * y for x, y in zip(a[i][k + 1 :], rest, strict=True)]
    return a, order


def _solved(lu: list[list[Decimal]], order: list[int], b: list[Decimal]) -> list[Decimal]:
    d, x = len(lu), [b[i] for i in order]
    for i in range(d):
        x[i] -= sum(map(Decimal.__mul__, lu[i][:i], x[:i]))
    for i in reversed(range(d)):
        x[i] = (x[i] - sum(map(Decimal.__mul__, lu[i][i + 1 :], x[i + 1 :]))) / lu[i][i]
    return x


def _dot(a: list[Decimal], b: list[Decimal]) -> Decimal:
    return sum(map(Decimal.__mul__, a, b), Decimal(0))


def _orthonormal(block: list[list[Decimal]]) -> list[list[Decimal]]:
    out: list[list[Decimal]] = []
    for v in block:
        for _ in range(2):
            for u in out:
                f = _dot(u, v)
                v = [x - f * y for x, y in zip(v, u, strict=True)]
        size = _dot(v, v).sqrt()
        out.append([x / size for x in v])
    return out


def _outside(v: list[Decimal], block: list[list[Decimal]]) -> Decimal:
    """The length of the part of ``v`` that the block doesn't span."""
    for u in block:
        f = _dot(u, v)
        v = [x - f * y for x, y in zip(v, u, strict=True)]
    return _dot(v, v).sqrt()
