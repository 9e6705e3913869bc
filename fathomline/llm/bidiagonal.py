"""Leading right singular vectors of a small matrix: Householder, dqds, twisted factorisations.

The matrix has the size of the embedding's dimension, whatever the number of rows, so this
part needs no cluster.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
SMALL = (10 * EPS) ** 2
# Singular values squared closer than this (relative) form a cluster whose vectors are kept orthogonal to each other.
CLOSE = 1e-5


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector of the reflection that maps ``x`` onto its first axis."""
    size = np.linalg.norm(x)
    if size == 0:
        return None
    u = x / size
    u[0] += math.copysign(1.0, u[0])
    return u / np.linalg.norm(u)


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v): diagonal, superdiagonal and right vectors, so that ``matrix @ v`` equals a rotated bidiagonal matrix."""
    m = np.array(matrix, float)
    d = len(m)
    v = np.eye(d)
    for k in range(d):
        u = _reflector(m[k:, k].copy())
        if u is not None:
            m[k:, k:] -= 2 * np.outer(u, u @ m[k:, k:])
        u = _reflector(m[k, k + 1:].copy()) if k < d - 2 else None
        if u is not None:
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ u, u)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _sweep(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float]:
    """One dqds transform with shift ``tau``; the last number is the smallest pivot, negative if the shift was too large."""
    d = lowest = q[0] - tau
    new_q, new_e = [], []
    for k, off in enumerate(e):
        pivot = d + off
        if d < 0 or pivot <= 0:
            return q, e, min(d, -EPS)
        ratio = q[k + 1] / pivot
        new_q.append(pivot)
        new_e.append(off * ratio)
        d = d * ratio - tau
        lowest = min(lowest, d)
    new_q.append(d)
    return new_q, new_e, lowest


def _shift(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the trailing two by two matrix: near the smallest one, from above."""
    x = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    y, z2 = q[-1] + e[-1], q[-2] * e[-1]
    half = (x - y) / 2
    return max(0.0, y - z2 / (half + math.copysign(math.hypot(half, math.sqrt(z2)), half)) if half >= 0 else (x + y) / 2 - math.hypot(half, math.sqrt(z2)))


def squared_values(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues, falling, of a qd array (squared diagonal and superdiagonal) by dqds with deflation."""
    found, waiting = [], [(list(q), list(e), 0.0)]
    while waiting:
        q, e, total = waiting.pop()
        if q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        for _ in range(60 * len(q) + 100):
            while e and e[-1] <= SMALL * (total + q[-1]):
                found.append(total + q.pop())
                e.pop()
            if not e:
                found.append(total + q[0])
                break
            gap = next((k for k, off in enumerate(e) if off <= SMALL * total or off == 0), None)
            if gap is not None:
                waiting += [(q[:gap + 1], e[:gap], total), (q[gap + 1:], e[gap + 1:], total)]
                break
            tau = _shift(q, e)
            for attempt in (tau, tau * (1 - 1e-3), tau / 4, 0.0):
                new_q, new_e, lowest = _sweep(q, e, attempt)
                if lowest >= 0:
                    q, e, total = new_q, new_e, total + attempt
                    break
            else:  # a pivot of zero without a shift: the smallest value is zero
                found.append(total)
                q, e = q[:-1], e[:-1]
        else:
            raise ArithmeticError("dqds did not converge")
    return sorted(found, reverse=True)


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of the bidiagonal's Gram matrix at ``value``, orthogonal to ``others`` (vectors of its cluster)."""
    d = len(a)
    a2, b2, ab = a * a, b * b, a[:-1] * b
    floor = max(value, float(a2.max(initial=0.0))) * EPS**2 or EPS**2
    s, p = np.empty(d), np.empty(d)
    down, up = np.empty(d - 1), np.empty(d - 1)
    pivots = np.empty(d)
    s[0] = -value
    for k in range(d - 1):  # stationary: from the top
        pivots[k] = s[k] + a2[k] if abs(s[k] + a2[k]) > floor else -floor
        down[k] = ab[k] / pivots[k]
        s[k + 1] = b2[k] * s[k] / pivots[k] - value
    pivots[d - 1] = s[d - 1] + a2[d - 1] if abs(s[d - 1] + a2[d - 1]) > floor else -floor
    p[d - 1] = a2[d - 1] - value
    for k in range(d - 2, -1, -1):  # progressive: from the bottom
        pivot = b2[k] + p[k + 1] if abs(b2[k] + p[k + 1]) > floor else -floor
        up[k] = ab[k] / pivot
        p[k] = p[k + 1] * a2[k] / pivot - value
    z = np.zeros(d)
    twist = int(np.argmin(np.abs(s + p + value)))
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(twist, d - 1):
        z[k + 1] = -up[k] * z[k]
    z /= np.linalg.norm(z)
    if others:
        basis = np.array(others)
        left = z - basis.T @ (basis @ z)
        if np.linalg.norm(left) < 0.5:  # the vector of a neighbour again: inverse iteration beside the known ones
            left = np.cos(np.arange(1.0, d + 1))
            for _ in range(4):
                left -= basis.T @ (basis @ left)
                for k in range(d - 1):
                    left[k + 1] -= down[k] * left[k]
                left /= pivots
                for k in range(d - 2, -1, -1):
                    left[k] -= down[k] * left[k + 1]
                left /= np.abs(left).max() or 1.0
                left -= basis.T @ (basis @ left)
                left /= np.linalg.norm(left) or 1.0
        z = left - basis.T @ (basis @ left)
        z /= np.linalg.norm(z)
    return z


def leading_vectors(matrix: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest squared singular values of a square matrix, falling, and their right vectors as rows.

    Values at the level of rounding are left out, so a matrix of low rank gives fewer than ``limit``.
    The largest entry of a vector is positive.
    """
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    a, b, v = bidiagonalised(matrix / scale)
    b[np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]) + EPS * np.abs(a).max())] = 0.0
    edges = [0, *(np.flatnonzero(b == 0) + 1).tolist(), len(a)]
    blocks = list(zip(edges, edges[1:]))
    values = sorted(((x, at) for at, (i, j) in enumerate(blocks) for x in squared_values((a[i:j] ** 2).tolist(), (b[i:j - 1] ** 2).tolist())), key=lambda t: (-t[0], t[1]))
    least = (8 * len(a) * EPS) ** 2 * values[0][0]
    made, near = [], {}
    for value, at in [t for t in values[:limit] if t[0] > least]:
        i, j = blocks[at]
        cluster = near.setdefault(at, [])
        if cluster and cluster[-1][0] - value > CLOSE * cluster[-1][0]:
            cluster.clear()
        z = twisted_vector(a[i:j], b[i:j - 1], value, [z for _, z in cluster])
        cluster.append((value, z))
        vector = v[:, i:j] @ z
        made.append(vector * math.copysign(1.0, vector[np.argmax(np.abs(vector))]) / np.linalg.norm(vector))
    kept = np.array([value for value, _ in values[:limit] if value > least])
    return kept * scale * scale, np.array(made)
