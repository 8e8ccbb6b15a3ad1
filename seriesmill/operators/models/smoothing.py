"""Exponential smoothing (M7-M9): level, level + trend, level + trend + season.

A fit is a point of up to three numbers from 0 to 1: the level weight, the trend weight as
a share of it, and the season weight as a share of what the level leaves. For a point,
one-step errors are linear in the counts and in the starting state, so the best start is
a least squares solution.

Every length is fitted by one rule. First a grid of points: each is one matrix from counts
to errors, shared by all series of a length. Then each series goes on from its own best
point, along one number after another, by steps that are halved each time round.
"""

from __future__ import annotations

from functools import lru_cache, partial
from itertools import product

import numpy as np

from ...config import SEASON

LEVELS = tuple(i / 20 for i in range(21))
SHARES = tuple(i / 4 for i in range(5))
STEPS = (1 / 20, 1 / 4, 1 / 4)
HALVINGS = 6
#: A step must lower the sum of squares by this share, so that rounding moves nothing.
_BETTER = 1e-7

# Points per group in the matrix work, and series per group; bound memory for long series.
_LANES = 32
_SERIES = 512


def form(n: int, season: int = SEASON) -> tuple[int, int] | None:
    """Trend flag and season length of the smoothing that ``n`` months allow."""
    if n >= 2 * season:
        return 1, season
    if n >= season:
        return 1, 0
    if n >= 4:
        return 0, 0
    return None


def grid(trended: int, season: int) -> np.ndarray:
    """Points of the grid in ascending order; a share of nothing is 0."""
    shares = SHARES if trended else (0.0,)
    waves = SHARES if season else (0.0,)
    points = {(a, t if a else 0.0, s if a < 1 else 0.0) for a, t, s in product(LEVELS, shares, waves)}
    return np.array(sorted(points))


def weights_of(points: np.ndarray) -> np.ndarray:
    """Weights of level, trend and season: 0 <= trend <= level, 0 <= season <= 1 - level."""
    a, t, s = points.T
    return np.stack((a, a * t, (1 - a) * s), axis=1)


def lane_maps(weights: np.ndarray, n: int, trended: int, season: int) -> tuple[np.ndarray, np.ndarray]:
    """Per point: counts -> errors (n x n) and counts -> next value (n)."""
    a, b, g = (weights[:, k, None] for k in range(3))
    starts = 1 + trended + season
    unit = np.eye(starts + n)
    count = len(weights)
    level = np.tile(unit[0], (count, 1))
    trend = np.tile(unit[1] * trended, (count, 1))
    seasons = [np.tile(unit[1 + trended + k], (count, 1)) for k in range(season)]
    errors = np.empty((count, n, starts + n))
    for t in range(n):
        flat = level + trend
        wave = seasons[t % season] if season else 0.0
        seen = unit[starts + t]
        errors[:, t] = seen - flat - wave
        new_level = a * (seen - wave) + (1 - a) * flat
        if season:
            seasons[t % season] = g * (seen - flat) + (1 - g) * wave
        if trended:
            trend = b * (new_level - level) + (1 - b) * trend
        level = new_level
    ahead = level + trend + (seasons[n % season] if season else 0.0)
    by_start, by_count = -errors[:, :, :starts], errors[:, :, starts:]
    best_start = np.linalg.pinv(by_start, rcond=1e-10) @ by_count
    after = by_count - by_start @ best_start
    following = ahead[:, starts:] + (ahead[:, None, :starts] @ best_start)[:, 0]
    return after, following


@lru_cache(maxsize=64)
def _maps(n: int, trended: int, season: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """``lane_maps`` of one group of grid points, kept by a worker from batch to batch."""
    return lane_maps(weights_of(grid(trended, season)[part : part + _LANES]), n, trended, season)


def fit_points(block: np.ndarray, points: np.ndarray, trended: int, season: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of squares and next value of each series (rows) at its own point, from its best start."""
    total, n = block.shape
    a, b, g = (w[:, None] for w in weights_of(points).T)
    starts = 1 + trended + season
    # Responses to each part of the starting state and, last, to the counts.
    level, trend, seasons = np.zeros((total, starts + 1)), np.zeros((total, starts + 1)), np.zeros((season, total, starts + 1))
    level[:, 0] = 1.0
    trend[:, 1] = float(trended)
    for k in range(season):
        seasons[k, :, 1 + trended + k] = 1.0
    errors = np.empty((total, n, starts + 1))
    for t in range(n):
        flat = level + trend
        wave = seasons[t % season] if season else 0.0
        error = -flat - wave
        error[:, -1] += block[:, t]
        errors[:, t] = error
        new_level = flat + a * error
        if season:
            seasons[t % season] = wave + g * error
        if trended:
            trend = b * (new_level - level) + (1 - b) * trend
        level = new_level
    ahead = level + trend + (seasons[n % season] if season else 0.0)
    by_start = errors[:, :, :starts]
    square = by_start.transpose(0, 2, 1) @ by_start
    right = by_start.transpose(0, 2, 1) @ errors[:, :, starts:]
    # Starts that nothing tells apart take the smallest values.
    square += 1e-10 * (np.trace(square, axis1=1, axis2=2) / starts + 1e-30)[:, None, None] * np.eye(starts)
    best = -np.linalg.solve(square, right)
    left = (errors[:, :, starts:] + by_start @ best)[:, :, 0]
    following = ahead[:, starts] + np.einsum("ij,ij->i", ahead[:, :starts], best[:, :, 0])
    return np.square(left).sum(axis=1), following


def _on_grid(block: np.ndarray, trended: int, season: int) -> np.ndarray:
    """The grid point with the smallest sum of squares; equal ones up to rounding go to the first."""
    points = grid(trended, season)
    squares = np.empty((len(points), len(block)))
    for lo in range(0, len(points), _LANES):
        after, _ = _maps(block.shape[1], trended, season, lo)
        squares[lo : lo + _LANES] = np.square(after @ block.T).sum(axis=1)
    limit = squares.min(axis=0) * (1 + 1e-9) + 1e-9
    return points[np.argmax(squares <= limit, axis=0)]


def _refined(block: np.ndarray, points: np.ndarray, trended: int, season: int, halvings: int) -> np.ndarray:
    best, following = fit_points(block, points, trended, season)
    axes = [0] + [1] * trended + [2] * bool(season)
    for k in range(1, halvings + 1):
        for axis in axes:
            tries = []
            for side in (-1, 1):
                moved = points.copy()
                moved[:, axis] = np.clip(moved[:, axis] + side * STEPS[axis] / 2**k, 0.0, 1.0)
                tries.append((moved, *fit_points(block, moved, trended, season)))
            (low, low_score, low_next), (high, high_score, high_next) = tries
            up = high_score < low_score * (1 - _BETTER) - 1e-9
            score = np.where(up, high_score, low_score)
            better = score < best * (1 - _BETTER) - 1e-9
            points = np.where(better[:, None], np.where(up[:, None], high, low), points)
            following = np.where(better, np.where(up, high_next, low_next), following)
            best = np.where(better, score, best)
    return following


def smooth(block: np.ndarray, season: int = SEASON, halvings: int = HALVINGS) -> np.ndarray | None:
    """Next value of each series (rows) by the smoothing its length allows."""
    total, n = block.shape
    chosen = form(n, season)
    if chosen is None:
        return None
    out = np.empty(total)
    for s in range(0, total, _SERIES):
        part = block[s : s + _SERIES]
        out[s : s + _SERIES] = _refined(part, _on_grid(part, *chosen), *chosen, halvings)
    return out


def smoother(season: int = SEASON, halvings: int = HALVINGS):
    """``smooth`` with another season length or fineness, as a kernel."""
    return partial(smooth, season=season, halvings=halvings)
