"""ARIMA(p,d,q)(P,D,Q)[s] by conditional least squares.

Values and errors before the differenced series count as zero. Plain and seasonal
polynomials are multiplied out, so one recursion over lags serves any orders. What is
searched are partial autocorrelations: each is free between -1 and 1, and any of them
together make a stationary (for errors: invertible) polynomial. They are searched on a
grid that is halved around the best point; all series and grid points of a step are
evaluated together.
"""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np

from ...config import ARIMA_ORDER, SEASON, SEASONAL_ORDER

_BOUND = 0.99
_HALVINGS = 6
_CELLS = 2_000_000

Lags = dict[int, np.ndarray]


def _from_partial(partials: np.ndarray) -> np.ndarray:
    """Coefficients of the autoregression with these partial autocorrelations (last axis)."""
    done = partials[..., :0]
    for k in range(partials.shape[-1]):
        new = partials[..., k : k + 1]
        done = np.concatenate((done - new * done[..., ::-1], new), axis=-1)
    return done


def _times(plain: np.ndarray, seasonal: np.ndarray, season: int) -> Lags:
    """Lags and coefficients of (1 + sum plain_i B^i)(1 + sum seasonal_j B^js), without the 1."""
    out: Lags = {}
    for i in range(plain.shape[-1] + 1):
        for j in range(seasonal.shape[-1] + 1):
            if i or j:
                value = np.ones(plain.shape[:-1])
                value = value * plain[..., i - 1] if i else value
                value = value * seasonal[..., j - 1] if j else value
                lag = i + j * season
                out[lag] = out[lag] + value if lag in out else value
    return out


def polynomials(coef: np.ndarray, season: int, order: tuple[int, int], seasonal: tuple[int, int]) -> tuple[Lags, Lags]:
    """What values and errors each lag adds to the next value.

    ``coef`` holds partial autocorrelations on its last axis: plain and error terms, then seasonal ones.
    """
    cuts = np.cumsum([*order, *seasonal])
    ar, ma, sar, sma = (coef[..., a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True))
    by_value = {k: -v for k, v in _times(-_from_partial(ar), -_from_partial(sar), season).items()}
    return by_value, _times(-_from_partial(-ma), -_from_partial(-sma), season)


def _orders(season: int, order: tuple[int, int] | None, seasonal: tuple[int, int] | None) -> tuple[tuple[int, int], tuple[int, int]]:
    return order or (1, 1), (seasonal or (1, 1)) if season else (0, 0)


def _errors(
    w: np.ndarray, coef: np.ndarray, season: int, order: tuple[int, int] | None = None, seasonal: tuple[int, int] | None = None
) -> np.ndarray:
    """One-step errors, months first: (months, series, candidates); ``coef`` is (series, candidates, terms)."""
    by_value, by_error = polynomials(coef, season, *_orders(season, order, seasonal))
    out = np.zeros((w.shape[1],) + coef.shape[:2])
    for t in range(w.shape[1]):
        e = np.broadcast_to(w[:, t, None], coef.shape[:2])
        for lag, value in by_value.items():
            if t >= lag:
                e = e - value * w[:, t - lag, None]
        for lag, value in by_error.items():
            if t >= lag:
                e = e - value * out[t - lag]
        out[t] = e
    return out


def _ahead(w: np.ndarray, e: np.ndarray, by_value: Lags, by_error: Lags) -> np.ndarray:
    """Next differenced value; ``w`` and ``e`` are (series, months)."""
    out = np.zeros(len(w))
    for terms, x in ((by_value, w), (by_error, e)):
        for lag, value in terms.items():
            if x.shape[1] >= lag:
                out = out + value[:, 0] * x[:, -lag]
    return out


def _differences(d: int, seasonal_d: int, season: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^s)^D by lag, from lag 0."""
    out = np.ones(1)
    for _ in range(d):
        out = np.convolve(out, [1, -1])
    for _ in range(seasonal_d):
        out = np.convolve(out, [1] + [0] * (season - 1) + [-1])
    return out


def _search(terms: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Grid, offsets of a halved step and the grid's step. The more terms, the fewer marks for each."""
    marks = np.linspace(-0.9, 0.9, 19) if terms <= 2 else np.linspace(-0.8, 0.8, 5) if terms <= 4 else np.linspace(-0.6, 0.6, 3)
    grid = np.array(list(product(marks, repeat=terms)))
    if terms <= 4:
        offsets = np.array(list(product((-1.0, 0.0, 1.0), repeat=terms)))
    else:
        offsets = np.vstack((np.zeros(terms), np.eye(terms), -np.eye(terms)))
    return grid, offsets, float(marks[1] - marks[0])


def fit_forecast(
    block: np.ndarray,
    season: int,
    order: tuple[int, int, int] = ARIMA_ORDER,
    seasonal_order: tuple[int, int, int] = SEASONAL_ORDER,
) -> np.ndarray:
    """Next value of each series (rows of ``block``); without ``season`` there are no seasonal terms."""
    p, d, q = order
    sp, sd, sq = seasonal_order if season else (0, 0, 0)
    poly = _differences(d, sd, season)
    reach = len(poly) - 1
    months = block.shape[1] - reach
    w = sum(c * block[:, reach - k : block.shape[1] - k] for k, c in enumerate(poly) if c)
    terms = p + q + sp + sq
    grid, offsets, first_step = _search(terms) if terms else (np.zeros((1, 0)), np.zeros((1, 0)), 0.0)
    shape = dict(order=(p, q), seasonal=(sp, sq))
    out = np.empty(len(block))
    chunk = max(1, _CELLS // (len(grid) * months))
    for lo in range(0, len(block), chunk):
        part = w[lo : lo + chunk]
        pick = np.arange(len(part))
        trial = np.broadcast_to(grid, (len(part),) + grid.shape)
        step = first_step
        for _ in range(_HALVINGS + 1 if terms else 1):
            score = np.square(_errors(part, trial, season, **shape)).sum(axis=0)
            low = score.min(axis=1, keepdims=True)
            best = trial[pick, np.argmax(score <= low * (1 + 1e-9) + 1e-9, axis=1)]
            step /= 2
            trial = np.clip(best[:, None, :] + offsets * step, -_BOUND, _BOUND)
        e = _errors(part, best[:, None, :], season, **shape)[:, :, 0].T
        out[lo : lo + chunk] = _ahead(part, e, *polynomials(best[:, None, :], season, **shape))
    for k in range(1, reach + 1):
        if poly[k]:
            out -= poly[k] * block[:, -k]
    return out


def sarima(
    block: np.ndarray,
    season: int = SEASON,
    order: tuple[int, int, int] = ARIMA_ORDER,
    seasonal_order: tuple[int, int, int] = SEASONAL_ORDER,
) -> np.ndarray | None:
    """Seasonal model from two seasons of rows, plain from 6, none below or where differencing leaves too little."""
    n = block.shape[1]
    if n >= 2 * season and n > order[1] + season * seasonal_order[1] + 1:
        return fit_forecast(block, season, order, seasonal_order)
    if n >= max(6, order[1] + 2):
        return fit_forecast(block, 0, order, seasonal_order)
    return None


def sarima_kernel(
    season: int = SEASON, order: tuple[int, int, int] = ARIMA_ORDER, seasonal_order: tuple[int, int, int] = SEASONAL_ORDER
):
    """``sarima`` with other orders, as a kernel. At most three terms of a kind."""
    if min(*order, *seasonal_order) < 0 or max(*order, *seasonal_order) > 3 or season < 2:
        raise ValueError(f"orders are 0 to 3 and a season has two months at least, not {order} {seasonal_order} {season}")
    return partial(sarima, season=season, order=tuple(order), seasonal_order=tuple(seasonal_order))
