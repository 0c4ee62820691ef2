"""The largest eigenpairs of a symmetric matrix that is only known by its products with a few vectors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Settings:
    """Ritz pairs improved at once, largest search space and what a restart leaves of it, inner steps and their wanted gain, rounds, seed.

    ``tolerance`` times the square root of the dimension is the residual, relative to the largest value, at which a pair is locked.
    If no pair was locked for ``patience`` rounds, residuals of ``floor`` or less count as the rounding of the products.
    """

    block: int = 16
    space: int = 48
    left: int = 32
    inner: int = 4
    gain: float = 0.02
    rounds: int = 2000
    tolerance: float = 2e-15
    patience: int = 12
    floor: float = 1e-12
    seed: int = 7


def orthonormal(vectors: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns orthogonal to ``against`` and each other; those that are nearly dependent are left out."""
    out = np.empty((vectors.shape[0], 0))
    for column in vectors.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for basis in (*against, out):
                column = column - basis @ (basis.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            out = np.column_stack([out, column])
    return out


def minres(product: Product, right: np.ndarray, steps: int, gain: float) -> np.ndarray:
    """Approximate solutions of a symmetric system for each column of ``right``: minimal residuals, one product a step.

    Columns are solved independently of each other; they only share the products.
    """
    solution = np.zeros_like(right)
    first = np.linalg.norm(right, axis=0)
    beta, before = first.copy(), np.zeros_like(first)
    r1, r2 = np.zeros_like(right), right.copy()
    w, w2 = np.zeros_like(right), np.zeros_like(right)
    left, dbar, epsilon = first.copy(), np.zeros_like(first), np.zeros_like(first)
    cosine, sine = -np.ones_like(first), np.zeros_like(first)
    alive = first > 0
    for step in range(steps):
        v = np.where(alive, r2 / np.where(alive, beta, 1), 0)
        y = product(v)
        if step:
            y = y - np.where(alive, beta / np.where(before > 0, before, 1), 0) * r1
        alpha = (v * y).sum(axis=0)
        y = y - np.where(alive, alpha / np.where(alive, beta, 1), 0) * r2
        r1, r2 = r2, np.where(alive, y, 0)
        before, beta = beta, np.linalg.norm(r2, axis=0)
        older = epsilon
        delta, bar = cosine * dbar + sine * alpha, sine * dbar - cosine * alpha
        epsilon, dbar = sine * beta, -cosine * beta
        gamma = np.hypot(bar, beta)
        alive &= gamma > 1e-300
        safe = np.where(alive, gamma, 1)
        cosine, sine = bar / safe, beta / safe
        w, w2 = np.where(alive, (v - older * w2 - delta * w) / safe, 0), np.where(alive, w, 0)
        solution = solution + np.where(alive, cosine * left, 0) * w
        left = np.where(alive, sine * left, left)
        alive &= (left > gain * first) & (beta > 1e-300)
        if not alive.any():
            break
    return solution


def largest(product: Product, dim: int, wanted: int, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest values, falling, and their unit vectors as columns, each to double precision.

    Rayleigh-Ritz in a search space; converged pairs are locked and projected out; for the best of the others
    ``(I - QQ')(A - theta I)(I - QQ') t = -r`` is solved by inner MINRES, with Q the locked and the present vectors, and t
    widens the space. It ends when nothing outside the locked pairs can reach the smallest wanted one.
    """
    wanted = min(wanted, dim)
    s = settings
    rng = np.random.default_rng(s.seed)
    locked, values = np.empty((dim, 0)), np.empty(0)
    basis = orthonormal(rng.standard_normal((dim, min(dim, 2 * s.block))))
    image = product(basis)
    scale, idle = 0.0, 0
    for _ in range(s.rounds):
        if basis.shape[1]:
            small = basis.T @ image
            theta, turn = np.linalg.eigh((small + small.T) / 2)
            theta, turn = theta[::-1], turn[:, ::-1]
            basis, image = basis @ turn, image @ turn
            scale = max(scale, theta[0])
            residual = image - basis * theta
            residual -= locked @ (locked.T @ residual)
            size = np.linalg.norm(residual, axis=0)
        if len(values) + basis.shape[1] >= dim:
            done = np.ones(basis.shape[1], bool)  # the whole space: Rayleigh-Ritz is exact
        else:
            done = size <= (s.floor if idle > s.patience else s.tolerance * np.sqrt(dim)) * scale
            done[s.block :] = False
        idle = 0 if done.any() else idle + 1
        if done.any():
            locked = np.column_stack([locked, basis[:, done]])
            values = np.concatenate([values, theta[done]])
            basis, image, theta, residual, size = (x[..., ~done] for x in (basis, image, theta, residual, size))
        if len(values) >= wanted:
            least = np.sort(values)[::-1][wanted - 1]
            if len(values) >= dim or (len(theta) and theta[0] + size[0] < least):
                break
        if basis.shape[1] > s.space - s.block:
            basis, image, theta, residual, size = (x[..., : s.left] for x in (basis, image, theta, residual, size))
        lead = min(s.block, basis.shape[1])
        if lead:
            outer = np.column_stack([locked, basis[:, :lead]])

            def projected(x, outer=outer):
                return x - outer @ (outer.T @ x)

            def shifted(x, at=theta[:lead]):
                x = projected(x)
                return projected(product(x) - x * at)

            more = projected(minres(shifted, -projected(residual[:, :lead]), s.inner, s.gain))
        else:
            more = rng.standard_normal((dim, s.block))
        more = orthonormal(more, locked, basis)
        if not more.shape[1]:
            more = orthonormal(rng.standard_normal((dim, 1)), locked, basis)
        basis, image = np.column_stack([basis, more]), np.column_stack([image, product(more)])
    else:
        raise RuntimeError("eigenpairs did not converge")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], locked[:, order]
