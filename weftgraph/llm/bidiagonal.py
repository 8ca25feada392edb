"""Singular values and right singular vectors of a small square matrix, by way of a bidiagonal one.

Householder reflections make the matrix bidiagonal. Its squared singular values come from the differential
quotient-difference algorithm with shifts (dqds), which keeps small ones accurate to a relative error, and the
vectors from twisted factorisations: the factors of the shifted product from the top and from the bottom meet
where the pivot is least, and the vector runs from there both ways without a system being solved. Vectors of
values that nearly agree are made orthogonal, by inverse iteration with the same factors where that leaves nothing.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
#: Values whose difference is a smaller share of them have their vectors made orthogonal.
CLOSE = 1e-4
BESIDE = 1e-13


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, above the diagonal, right): matrix = left @ bidiagonal @ right.T for some orthogonal left."""
    a = matrix.astype(float).copy()
    d = len(a)
    right = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """Unit normal of the reflection that takes x to its first axis."""
        most = np.abs(x).max(initial=0)
        if len(x) < 2 or most == 0 or not np.abs(x[1:]).max() > 0:
            return None
        v = x / most
        v[0] += math.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for i in range(d):
        v = reflector(a[i:, i].copy())
        if v is not None:
            a[i:, i:] -= 2 * np.outer(v, v @ a[i:, i:])
        if i + 1 < d:
            v = reflector(a[i, i + 1 :].copy())
            if v is not None:
                a[i:, i + 1 :] -= 2 * np.outer(a[i:, i + 1 :] @ v, v)
                right[:, i + 1 :] -= 2 * np.outer(right[:, i + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One step of dqds; none if the shift is above the least value."""
    new_q, new_e = [], []
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        upper = d + e[i]
        t = q[i + 1] / upper if upper > 0 else 0.0
        new_q.append(upper)
        new_e.append(e[i] * t)
        d = d * t - shift
    return None if d < 0 else ([*new_q, d], new_e)


def _shift(q: list[float], e: list[float]) -> float:
    """A guess just below the least value: of the last two by two, or a bound that is certain."""
    above = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    last = q[-1] + e[-1]
    cross = q[-2] * e[-1]
    half = (above + last) / 2
    root = math.sqrt(max((above - last) ** 2 / 4 + cross, 0.0))
    guess = (above * last - cross) / (half + root) if half + root > 0 else 0.0
    a, b = [math.sqrt(x) for x in q], [0.0, *(math.sqrt(x) for x in e), 0.0]
    certain = min(x - (l + r) / 2 for x, l, r in zip(a, b[:-1], b[1:]))
    return max(guess * (1 - 1e-3) - e[-1], max(certain, 0.0) ** 2 * (1 - 1e-12), 0.0)


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> list[float]:
    """Squared singular values of a bidiagonal matrix, the greatest first."""
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    out, total = [], 0.0
    while q:
        if len(q) == 1:
            out.append(total + q.pop())
            break
        if e[-1] <= EPS * 1e-2 * (total + q[-1]) or e[-1] < 1e-300:
            out.append(total + q.pop())
            e.pop()
            continue
        if 1.5 * q[0] < q[-1]:
            q.reverse()
            e.reverse()
        shift = _shift(q, e)
        made = _transform(q, e, shift)
        while made is None:
            shift = shift / 4 if shift > EPS * (total + q[-1]) else 0.0
            made = _transform(q, e, shift)
        q, e = made
        total += shift
    return sorted(out, reverse=True)


class Twisted:
    """Factors of the product (bidiagonal.T @ bidiagonal) less a value, from both ends to the twist."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float, tiny: float):
        d = [max(abs(x), tiny) ** 2 for x in diagonal.tolist()]
        low = [math.copysign(b, a * b) / max(abs(a), tiny) if a else b / tiny for a, b in zip(diagonal.tolist(), above.tolist())]
        n = len(d)
        self.down, self.up = [0.0] * n, [0.0] * n
        self.lower, self.upper = [0.0] * max(n - 1, 0), [0.0] * max(n - 1, 0)
        safe = lambda x: x if x else tiny * tiny
        s, tops = -value, []
        for i in range(n):
            tops.append(s)
            self.down[i] = safe(s + d[i])
            if i < n - 1:
                self.lower[i] = d[i] * low[i] / self.down[i]
                s = self.lower[i] * low[i] * s - value
        p, ends = d[n - 1] - value, [0.0] * n
        ends[n - 1] = p
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = safe(d[i] * low[i] * low[i] + p)
            t = d[i] / self.up[i + 1]
            self.upper[i] = low[i] * t
            p = p * t - value
            ends[i] = p
        gammas = [a + b + value for a, b in zip(tops, ends)]
        self.twist = min(range(n), key=lambda i: abs(gammas[i]))
        self.gamma = safe(gammas[self.twist])

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.down))
        k = self.twist
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(k, len(z) - 1):
            z[i + 1] = -self.upper[i] * z[i]
        return z

    def solve(self, right: np.ndarray) -> np.ndarray:
        w, k = right.astype(float).copy(), self.twist
        for i in range(1, k + 1):
            w[i] -= self.lower[i - 1] * w[i - 1]
        for i in range(len(w) - 2, k - 1, -1):
            w[i] -= self.upper[i] * w[i + 1]
        for i in range(len(w)):
            w[i] /= self.down[i] if i < k else self.up[i] if i > k else self.gamma
        for i in range(k - 1, -1, -1):
            w[i] -= self.lower[i] * w[i + 1]
        for i in range(k, len(w) - 1):
            w[i + 1] -= self.upper[i] * w[i]
        return w


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def _apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for y in others:
            x = x - (x @ y) * y
    return x


def _block_pairs(diagonal: np.ndarray, above: np.ndarray, most: int, tiny: float) -> list[tuple[float, np.ndarray]]:
    """The greatest values and their vectors, of a block without zeros above its diagonal."""
    pairs: list[tuple[float, np.ndarray]] = []
    random = np.random.default_rng(0)
    for value in squared_values(diagonal, above)[:most]:
        close = [z for other, z in pairs if other - value <= CLOSE * other]
        factors = Twisted(diagonal, above, value, tiny)
        z = _unit(factors.vector())
        if close:
            z = _apart(z, close)
            if np.linalg.norm(z) < 0.5:
                z = _apart(random.standard_normal(len(z)), close)
            # A little beside the value, so that the vectors found before don't drown the new one.
            factors = Twisted(diagonal, above, value * (1 + BESIDE), tiny)
            for _ in range(4):
                z = _unit(_apart(factors.solve(_unit(_apart(z, close))), close))
        pairs.append((value, _unit(z)))
    return pairs


def singular_pairs(matrix: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """(squared singular value, right singular vector) of the greatest ``most`` values, the greatest first.
    Values that are zero but for rounding are left out. A vector's greatest component is positive."""
    if not np.abs(matrix).max(initial=0) > 0:
        return []
    scale = float(np.abs(matrix).max())
    diagonal, above, right = bidiagonalise(matrix / scale)
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(above).max(initial=0))
    tiny = norm * EPS * EPS
    # What lies above the diagonal and is no more than rounding cuts the matrix into blocks.
    beside = np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    ends = [*(np.flatnonzero(np.abs(above) <= np.maximum(norm, d * beside) * EPS) + 1).tolist(), d]
    pairs, begin = [], 0
    for end in ends:
        for value, z in _block_pairs(diagonal[begin:end], above[begin : end - 1], most, tiny):
            whole = right[:, begin:end] @ z
            pairs.append((value, whole * (1 if whole[np.abs(whole).argmax()] > 0 else -1)))
        begin = end
    pairs.sort(key=lambda pair: -pair[0])
    least = (d * EPS * norm) ** 2
    return [(value * scale * scale, z) for value, z in pairs[:most] if value > least]
