"""Finer ratio grids from coarse ones. A grid has one number per bin of a component, so this is array work within a task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def _linear_axis(grid: np.ndarray, n: int, axis: int) -> np.ndarray:
    size = grid.shape[axis]
    at = np.clip((np.arange(size * n) + 0.5) / n - 0.5, 0, size - 1)
    low = np.floor(at).astype(int)
    high = np.minimum(low + 1, size - 1)
    part = (at - low).reshape([-1 if i == axis else 1 for i in range(grid.ndim)])
    return np.take(grid, low, axis) * (1 - part) + np.take(grid, high, axis) * part


def _cubic_axis(grid: np.ndarray, n: int, axis: int, pad: int = 12) -> np.ndarray:
    """Cubic B-spline through the values: edge padding, recursive prefilter, then evaluation at the finer places."""
    x = np.moveaxis(np.pad(grid, [(pad, pad) if i == axis else (0, 0) for i in range(grid.ndim)], mode="edge"), axis, 0).astype(float)
    pole = np.sqrt(3) - 2
    c = x * 6.0
    for i in range(1, len(c)):
        c[i] += pole * c[i - 1]
    c[-1] = pole / (pole * pole - 1) * (c[-1] + pole * c[-2])
    for i in range(len(c) - 2, -1, -1):
        c[i] = pole * (c[i + 1] - c[i])
    size = grid.shape[axis]
    at = np.clip((np.arange(size * n) + 0.5) / n - 0.5, 0, size - 1) + pad
    low = np.floor(at).astype(int)
    t = (at - low).reshape([-1] + [1] * (grid.ndim - 1))
    weights = ((1 - t) ** 3 / 6, (3 * t**3 - 6 * t**2 + 4) / 6, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6, t**3 / 6)
    out = sum(w * c[np.clip(low + k - 1, 0, len(c) - 1)] for k, w in enumerate(weights))
    return np.moveaxis(out, 0, axis)


def upscale(grid: np.ndarray, n: int, order: int = 3) -> np.ndarray:
    """The grid with every bin cut into ``n`` along every axis; negative results become 0."""
    if order not in (1, 3):
        raise ValueError("order must be 1 or 3")
    out = np.asarray(grid, float)
    for axis in range(out.ndim):
        out = (_linear_axis if order == 1 else _cubic_axis)(out, n, axis)
    return np.maximum(out, 0)


def upscale_regions(grid: np.ndarray, sizes: Sequence[Sequence[int]], n: int, order: int = 3) -> np.ndarray:
    """Upscales every block of bins on its own: ``sizes`` has the lengths of the blocks of each axis."""
    grid = np.asarray(grid, float)
    if [sum(s) for s in sizes] != list(grid.shape):
        raise ValueError("blocks do not make up the grid")
    out = np.zeros([x * n for x in grid.shape])
    starts = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]
    for where in np.ndindex(*[len(s) for s in sizes]):
        cut = tuple(slice(starts[a][i], starts[a][i + 1]) for a, i in enumerate(where))
        out[tuple(slice(c.start * n, c.stop * n) for c in cut)] = upscale(grid[cut], n, order)
    return out
