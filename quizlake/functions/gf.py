"""Arithmetic over the prime field of 2**31 - 1, vectorised: products of two elements fit into 64 bits."""

from __future__ import annotations

import numpy as np

P = 2**31 - 1
#: The last POINTS elements are kept for sample points, so no row hash is ever a root at one.
POINTS = 1 << 16


def inverse(a: int) -> int:
    return pow(int(a), P - 2, P)


def evaluations(elements: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The characteristic polynomial prod (z - e) of a multiset, at each point."""
    terms = (points[None, :] - elements[:, None]) % P
    while len(terms) > 1:
        odd = terms[-1:] if len(terms) % 2 else None
        half = terms[0 : len(terms) - len(terms) % 2]
        terms = half[0::2] * half[1::2] % P
        if odd is not None:
            terms = np.concatenate([terms, odd])
    return terms[0] if len(terms) else np.ones(len(points), dtype=np.int64)


def value(poly: np.ndarray, at: np.ndarray) -> np.ndarray:
    """poly: coefficients, the lowest first."""
    out = np.zeros(len(at), dtype=np.int64)
    for c in poly[::-1]:
        out = (out * at + int(c)) % P
    return out


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """One solution of a x = b, free variables 0; None if there is none."""
    m = np.concatenate([a, b[:, None]], axis=1) % P
    rows, cols = a.shape
    pivots, r = [], 0
    for c in range(cols):
        nz = np.nonzero(m[r:, c])[0]
        if not len(nz):
            continue
        k = r + nz[0]
        if k != r:
            m[[r, k]] = m[[k, r]]
        m[r] = m[r] * inverse(m[r, c]) % P
        f = m[:, c].copy()
        f[r] = 0
        hit = np.nonzero(f)[0]
        m[hit] = (m[hit] - f[hit, None] * m[r][None, :]) % P
        pivots.append(c)
        r += 1
        if r == rows:
            break
    if r < rows and m[r:, cols].any():
        return None
    x = np.zeros(cols, dtype=np.int64)
    for i, c in enumerate(pivots):
        x[c] = m[i, cols]
    return x


def _trim(p: np.ndarray) -> np.ndarray:
    nz = np.nonzero(p)[0]
    return p[: nz[-1] + 1] if len(nz) else p[:0]


def _divide(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, inv, n = a.copy(), inverse(b[-1]), len(b)
    q = np.zeros(max(len(a) - n + 1, 0), dtype=np.int64)
    for i in range(len(a) - n, -1, -1):
        q[i] = a[i + n - 1] * inv % P
        a[i : i + n] = (a[i : i + n] - q[i] * b) % P
    return q, _trim(a)


def reduced(num: np.ndarray, den: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """num / den without their common factor."""
    a, b = _trim(num), _trim(den)
    while len(b):
        a, b = b, _divide(a, b)[1]
    if len(a) <= 1:
        return _trim(num), _trim(den)
    a = a * inverse(a[-1]) % P
    return _divide(_trim(num), a)[0], _divide(_trim(den), a)[0]


def rational(f: np.ndarray, z: np.ndarray, delta: int, check: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Monic num and den with num / den = f at the points z and deg num - deg den = delta; the last ``check`` points verify.

    None if the difference is larger than the points allow.
    """
    bound = len(z) - check
    if abs(delta) > bound:
        return None
    total = bound - (bound - abs(delta)) % 2
    d1, d2 = (total + delta) // 2, (total - delta) // 2
    n = d1 + d2
    zz, ff = z[:n], f[:n]
    powers = np.ones((len(z), max(d1, d2) + 1), dtype=np.int64)
    for i in range(1, powers.shape[1]):
        powers[:, i] = powers[:, i - 1] * z % P
    a = np.concatenate([powers[:n, :d1], (P - ff[:, None]) * powers[:n, :d2] % P], axis=1)
    b = (ff * powers[:n, d2] - powers[:n, d1]) % P
    x = solve(a, b) if n else np.zeros(0, dtype=np.int64)
    if x is None:
        return None
    one = np.ones(1, dtype=np.int64)
    num, den = reduced(np.concatenate([x[:d1], one]), np.concatenate([x[d1:], one]))
    if len(num) - len(den) != delta:
        return None
    return (num, den) if (value(num, z) == f * value(den, z) % P).all() else None
