"""Eigenpairs of a symmetric matrix by spectral divide-and-conquer.

The orthogonal polar factor U of ``A - shift * I`` is the matrix sign, so
``(U + I) / 2`` projects on the eigenvectors above the shift. U comes from the
dynamically weighted Halley iteration (QDWH; Nakatsukasa and Higham, 2013), which
needs QR and Cholesky-like solves only. A basis of the projector's range and its
complement split the matrix in two invariant subspaces, and each is split on
until it holds one component.

The matrix is one of moments: its order is a vector's length, whatever the
number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
ROUNDS = 30
SEED = 13


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix other than zero."""
    eye = np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = EPS  # a lower bound of the smallest singular value; where it is too low, a round more is done
    for _ in range(ROUNDS):
        l2 = low * low
        d = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:  # badly conditioned: through QR
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:len(a)] @ q[len(a):].T
        else:
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        x = (x + x.T) / 2
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < 1e-12 * np.sqrt(len(a)):
            break
    return x


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None
    where the matrix is a multiple of the identity, as far as doubles tell."""
    n, mean = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 4 * n * EPS * scale:
        return None
    best = None
    # the mean of the eigenvalues lies between the outer two; a shift that meets an eigenvalue is moved
    for shift in (float(np.median(np.diag(a))), mean, *(mean + spread / n * f for f in (0.1, -0.1, 0.23, -0.23, 0.01, -0.01))):
        u = polar(a - shift * np.eye(n))
        above = round((np.trace(u) + n) / 2)
        if not 0 < above < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-6:
            continue
        project = (u + np.eye(n)) / 2
        basis = np.random.default_rng(SEED).standard_normal((n, above))
        for _ in range(3):  # subspace iteration on the projector
            q, _ = np.linalg.qr(project @ basis, mode="complete")
            basis = q[:, :above]
        upper, lower = q[:, :above], q[:, above:]
        rest = np.linalg.norm(lower.T @ a @ upper)
        if best is None or rest < best[0]:
            best = rest, upper, lower
        if rest <= 10 * n * EPS * scale:
            break
    return None if best is None else best[1:]


def leading(a: np.ndarray, want: int, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues, falling, and their unit eigenvectors as
    columns. Subspaces that hold none of them are not split on."""
    a = (a + a.T) / 2
    want = min(want, len(a))
    scale = np.linalg.norm(a) if scale is None else scale
    halves = split(a, scale) if len(a) > 1 else None
    if halves is None:
        return np.diag(a)[:want].copy(), np.eye(len(a))[:, :want]
    values, vectors = [], []
    for basis in halves:
        if want > 0:
            e, v = leading(basis.T @ a @ basis, want, scale)
            values.append(e)
            vectors.append(basis @ v)
            want -= len(e)
    e, v = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]
