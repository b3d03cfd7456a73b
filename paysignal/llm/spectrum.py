"""The spectrum of a growing set of vectors, kept up to date by rank-one changes.

A state holds the number of vectors, their mean, and the eigenvalues (rising) and eigenvectors of their scatter
matrix, the sum of the outer products of the centred vectors. A new vector x changes the scatter by
n / (n + 1) (x - mean)(x - mean)'. After a change of diag(d) by rho z z', eigenvalues are the roots of
the secular equation 1 + rho sum z_i^2 / (d_i - t) = 0, one between every two neighbouring d. Entries with
negligible z, and all but one of a cluster of equal d (a reflection turns z into a single entry of the
cluster), are deflated: their eigenvalues stay. Vectors follow from a z that is recomputed from the roots, which
keeps them orthogonal however close the roots lie.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EPS = np.finfo(np.float64).eps
_STEPS = 80


@dataclass
class Spectrum:
    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(size: int) -> Spectrum:
        return Spectrum(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), away)
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """The vectors of another state: a rank-one change per direction of its scatter, and one for the means."""
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, value, vector)
        away, n = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / n, away)
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def to_bytes(self) -> bytes:
        return np.concatenate((self.mean, self.values, self.vectors.ravel())).astype("<f8").tobytes()

    @staticmethod
    def from_bytes(n: int, size: int, raw: bytes) -> Spectrum:
        flat = np.frombuffer(raw, dtype="<f8").astype(np.float64)
        return Spectrum(n, flat[:size], flat[size : 2 * size], flat[2 * size :].reshape(size, size))


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of V diag(values) V' + rho x x', rho > 0."""
    z = vectors.T @ x
    length = np.linalg.norm(z)
    if not length or not rho:
        return values, vectors
    z, rho = z / length, rho * length * length
    small = 8 * _EPS * max(float(np.abs(values).max()), rho)
    values, z, vectors = _deflated(values, z, vectors, small)
    live = np.flatnonzero(rho * np.abs(z) > small)
    if not len(live):
        return values, vectors
    d, zl = values[live], z[live]
    base, shift = secular_roots(d, zl, rho)
    # distances d_i - t_j without cancellation: t_j is kept as the pole base_j plus a shift
    gap = (d[:, None] - d[base][None, :]) - shift[None, :]
    turned = _eigenvectors(d, zl, gap)
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[live] = d[base] + shift
    new_vectors[:, live] = vectors[:, live] @ turned
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


def _deflated(values: np.ndarray, z: np.ndarray, vectors: np.ndarray, small: float):
    """Clusters of equal values: a reflection of their eigenvectors leaves one entry of z."""
    close = np.diff(values) <= small
    if not close.any():
        return values, z, vectors
    values, z, vectors = values.copy(), z.copy(), vectors.copy()
    limits = np.concatenate(([0], np.flatnonzero(~close) + 1, [len(values)]))
    for lo, hi in zip(limits[:-1], limits[1:], strict=True):
        part = z[lo:hi]
        size = np.linalg.norm(part)
        if hi - lo < 2 or size == 0:
            continue
        values[lo:hi] = values[lo:hi].mean()
        mirror = part.copy()
        sign = 1.0 if part[-1] >= 0 else -1.0
        mirror[-1] += sign * size
        mirror /= np.linalg.norm(mirror)
        vectors[:, lo:hi] -= 2.0 * np.outer(vectors[:, lo:hi] @ mirror, mirror)
        z[lo:hi] = 0.0
        z[hi - 1] = -sign * size
    return values, z, vectors


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """For rising distinct poles d, every root as (index of its nearest pole, distance from it).

    All roots are sought at once. A step fits c + a / (p - t) + b / (q - t) to the equation at the two poles around a root
    and is taken where it stays within the bracket, which the sign of the equation narrows; else the bracket is halved.
    """
    n = len(d)
    weights = rho * z * z
    upper = np.append(d[1:], d[-1] + weights.sum())
    at = np.arange(n)
    middle = (upper - d) / 2
    value = 1.0 + (weights[None, :] / ((d[None, :] - d[:, None]) - middle[:, None])).sum(axis=1)
    # the equation rises from minus to plus infinity: a negative middle puts the root in the upper half
    right = (value < 0) & (at < n - 1)
    base = np.where(right, at + 1, at)
    poles = d[None, :] - d[base][:, None]  # poles as seen from the base
    low = np.where(right, -middle, np.where(value < 0, middle, 0.0))
    high = np.where(right, 0.0, np.where(value < 0, upper - d, middle))
    left_pole = poles[at, at]
    right_pole = np.where(at < n - 1, poles[at, np.minimum(at + 1, n - 1)], np.inf)
    lower = (at[None, :] <= at[:, None]).astype(np.float64)
    free = np.isinf(right_pole)
    t = (low + high) / 2
    open_ = np.ones(n, dtype=bool)
    for _ in range(_STEPS):
        apart = poles - t[:, None]
        term = weights[None, :] / apart
        below = np.einsum("ij,ij->i", term, lower)  # all negative; the other terms are positive
        every = term.sum(axis=1)
        f, size = 1.0 + every, 1.0 + every - 2.0 * below
        low = np.where(f < 0, np.maximum(low, t), low)
        high = np.where(f > 0, np.minimum(high, t), high)
        open_ &= (np.abs(f) > 4 * _EPS * size) & (high - low > 2 * _EPS * np.maximum(np.abs(high), np.abs(low)))
        if not open_.any():
            break
        np.divide(term, apart, out=term)
        psi = np.einsum("ij,ij->i", term, lower)
        phi = np.where(free, 0.0, term.sum(axis=1) - psi)
        p, q = left_pole - t, np.where(free, 1.0, right_pole - t)
        a, b = psi * p * p, phi * q * q
        c = f - psi * p - phi * q
        # c (p - s)(q - s) + a (q - s) + b (p - s) = 0 for the step s
        lin = c * (p + q) + a + b
        const = c * p * q + a * q + b * p
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(lin * lin - 4 * c * const, 0.0))
            steps = np.where(lin <= 0, (lin - root) / (2 * c), 2 * const / (lin + root))
            last = p + a / c  # without a right pole: c + a / (p - s) = 0
            steps = np.where(free, last, steps)
            new = t + steps
        fine = np.isfinite(new) & (new > low) & (new < high)
        t = np.where(open_, np.where(fine, new, (low + high) / 2), t)
    return base, t


def _eigenvectors(d: np.ndarray, z: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of diag(d) + rho z z' as columns; ``gap[i, j]`` is d_i - t_j."""
    between = d[:, None] - d[None, :]
    np.fill_diagonal(between, 1.0)
    # |z_i|^2 up to a factor: the product over j of (t_j - d_i) / (d_j - d_i), paired to stay within range
    ratio = gap / np.where(between == 0, 1.0, between)
    np.fill_diagonal(ratio, 1.0)
    size = np.exp(0.5 * (np.log(np.abs(ratio)).sum(axis=1) + np.log(np.abs(np.diagonal(gap)))))
    turned = np.copysign(size, z)[:, None] / gap
    return turned / np.linalg.norm(turned, axis=0)
