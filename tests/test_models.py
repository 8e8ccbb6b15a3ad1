import datetime as dt
from itertools import product

import numpy as np
import pytest

from seriesmill.operators import features
from seriesmill.operators.models import arima, base, bayes, naive, registry, ridge, smoothing, trees
from seriesmill.operators.models.kernels import apply_kernel, series_prefixes

D = dt.date
LENGTHS = (1, 2, 3, 4, 5, 6, 7, 11, 12, 13, 15, 16, 23, 24, 36)


def counts_of(n, seed=0):
    rng = np.random.default_rng(n * 101 + seed)
    season = 8 * np.sin(np.arange(n) * np.pi / 6)
    return np.round(20 + 0.4 * np.arange(n) + season + rng.normal(0, 3, n)).clip(0)


@pytest.fixture(scope="module")
def lengths(make_series):
    return make_series({f"n{n:02d}": (D(2018, 3, 1), counts_of(n)) for n in LENGTHS}).repartition(3)


def predictions(df):
    return {r.category: r.predicted for r in df.collect()}


def mean3(y):
    return float(np.mean(y[-3:])) if len(y) >= 3 else float(y[-1])


def months(first, n):
    index = first.year * 12 + first.month - 1 + np.arange(n + 1)
    return index % 12 + 1, index // 12


def ridge_by_hand(y, first):
    """Penalised least squares on the feature table the length allows."""
    n = len(y)
    if n < 6:
        return mean3(y)
    num, year = months(first, n)
    avg3 = np.array([np.mean(y[i - 3 : i]) if i >= 3 else np.nan for i in range(n + 1)])
    lag = lambda k: np.array([y[i - k] if i >= k else np.nan for i in range(n + 1)])
    table = np.column_stack([num, year, lag(1), avg3, lag(12)])
    table[n, 4] = y[n - 13] if n >= 13 else np.nan
    for used in ([0, 1, 2, 3, 4] if n >= 13 else [0, 1, 2, 3], [0, 1]):
        x = table[:n, used]
        keep = ~np.isnan(x).any(axis=1)
        if used == [0, 1] or keep.sum() >= 4:
            break
    x, t = x[keep], np.asarray(y)[keep]
    center = x.mean(axis=0)
    w = np.linalg.solve((x - center).T @ (x - center) + np.eye(len(used)), (x - center).T @ (t - t.mean()))
    return float(t.mean() + (table[n, used] - center) @ w)


def test_ridge_every_length(lengths):
    got = predictions(ridge.ridge(features.series_state(lengths)))
    for n in LENGTHS:
        assert got[f"n{n:02d}"] == pytest.approx(ridge_by_hand(counts_of(n), D(2018, 3, 1)), rel=1e-9), n


def test_ridge_survives_large_levels(make_series):
    y = 1e7 + counts_of(40)
    got = predictions(ridge.ridge(features.series_state(make_series({"a": (D(2018, 3, 1), y)}))))
    assert got["a"] == pytest.approx(ridge_by_hand(y, D(2018, 3, 1)), rel=1e-12)


def test_ridge_folds_equal_refits(lengths, make_series):
    state = features.series_state(lengths)
    folds = base.last_folds(lengths, 3)
    for r in ridge.ridge(state, folds).collect():
        n = int(r.category[1:])
        known = (r.fold.year - 2018) * 12 + r.fold.month - 3
        assert known < n
        assert r.predicted == pytest.approx(ridge_by_hand(counts_of(n)[:known], D(2018, 3, 1)), rel=1e-9)
        assert r.actual == counts_of(n)[known]


def test_ridge_next_month_anchor(make_series):
    state = features.series_state(make_series({"a": (D(2018, 3, 1), counts_of(36))}))
    assert predictions(ridge.ridge(state))["a"] != predictions(ridge.ridge(state, lag12_anchor="next_month"))["a"]


def test_seasonal_naive_branches(make_series):
    year = list(range(1, 13))
    series = make_series({
        "year_ago": (D(2019, 1, 1), year),
        "short": (D(2020, 1, 1), [4, 5]),
        "zero_live": (D(2019, 1, 1), [0] + year[1:]),
        "zero_dead": (D(2019, 1, 1), [0, 5, 5, 5, 5, 5, 5, 5, 5, 0, 0, 0]),
        "zero_short": (D(2020, 1, 1), [4, 0]),
    })
    got = predictions(naive.seasonal_naive(features.series_state(series)))
    assert got == {"year_ago": 1.0, "short": 5.0, "zero_live": 11.0, "zero_dead": 0.0, "zero_short": 0.0}


def smooth_by_hand(y, halvings=smoothing.HALVINGS):
    """Every grid point by plain recursion, its best start by least squares, then the halved steps."""
    trended, season = smoothing.form(len(y))

    def fit(point):
        a, b, g = point[0], point[0] * point[1], (1 - point[0]) * point[2]

        def errors(start):
            level, trend = start[0], start[1] if trended else 0.0
            waves = list(start[1 + trended :])
            out = []
            for t, v in enumerate(list(y) + [0.0]):
                wave = waves[t % season] if season else 0.0
                out.append(v - level - trend - wave)
                if t == len(y):
                    return np.array(out[:-1]), level + trend + wave
                new = a * (v - wave) + (1 - a) * (level + trend)
                if season:
                    waves[t % season] = g * (v - level - trend) + (1 - g) * wave
                trend = b * (new - level) + (1 - b) * trend if trended else 0.0
                level = new

        size = 1 + trended + season
        zero, _ = errors(np.zeros(size))
        slopes = np.column_stack([errors(e)[0] - zero for e in np.eye(size)])
        start = np.linalg.lstsq(slopes, -zero, rcond=1e-10)[0]
        e, ahead = errors(start)
        return float(e @ e), ahead

    best = None
    for point in smoothing.grid(trended, season):
        score, ahead = fit(point)
        if best is None or score < best[0] * (1 - 1e-9) - 1e-9:
            best = (score, ahead, list(point))
    for k in range(1, halvings + 1):
        for axis in [0] + [1] * trended + [2] * bool(season):
            moved = []
            for side in (-1, 1):
                point = list(best[2])
                point[axis] = min(1.0, max(0.0, point[axis] + side * smoothing.STEPS[axis] / 2**k))
                moved.append((*fit(point), point))
            found = moved[1] if moved[1][0] < moved[0][0] * (1 - 1e-7) - 1e-9 else moved[0]
            if found[0] < best[0] * (1 - 1e-7) - 1e-9:
                best = found
    return best[1]


@pytest.mark.parametrize("n", [4, 11, 12, 23, 26, 40])
def test_smoothing_matches_recursion(n):
    y = counts_of(n)
    assert smoothing.smooth(y[None, :])[0] == pytest.approx(smooth_by_hand(y), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("n", [8, 20, 60])
def test_refined_points_are_close_to_the_best_there_is(n, monkeypatch):
    """Against many random points: the fit is within a thousandth of the best of them."""
    y, (trended, season) = counts_of(n, 3), smoothing.form(n)
    rng = np.random.default_rng(n)
    points = np.column_stack((rng.random(3000), rng.random(3000) * trended, rng.random(3000) * bool(season)))
    best = smoothing.fit_points(np.repeat(y[None, :], 3000, axis=0), points, trended, season)[0].min()
    start = smoothing._on_grid(y[None, :], trended, season)
    coarse = smoothing.fit_points(y[None, :], start, trended, season)[0][0]
    steps, scores, real = [], [], smoothing.fit_points
    monkeypatch.setattr(smoothing, "fit_points", lambda *a: scores.append(real(*a)) or scores[-1])
    for halvings in (0, 2, 6):
        scores.clear()
        smoothing.smooth(y[None, :], halvings=halvings)
        steps.append(min(s[0][0] for s in scores))
    assert steps[0] == coarse and steps[2] <= steps[1] <= steps[0]
    assert steps[2] <= best * 1.001 + 1e-9


def test_other_season_lengths():
    week = np.tile([9.0, 1, 4, 7, 2, 8, 3], 4)
    assert smoothing.smooth(week[None, :], season=7)[0] == pytest.approx(9.0)
    assert smoothing.form(13, 7) == (1, 0) and smoothing.form(14, 7) == (1, 7) and smoothing.form(5, 7) == (0, 0)


def test_smoothing_exact_cases():
    assert smoothing.smooth(np.full((2, 8), 5.0)) == pytest.approx([5.0, 5.0])
    line = 3.0 + 2.0 * np.arange(15)
    assert smoothing.smooth(line[None, :])[0] == pytest.approx(33.0)
    cycle = np.tile([9.0, 1, 4, 7, 2, 8, 3, 6, 5, 12, 11, 10], 3)
    assert smoothing.smooth(cycle[None, :])[0] == pytest.approx(9.0)
    assert smoothing.smooth(np.ones((1, 3))) is None


def arima_errors(w, ar, ma):
    e = []
    for t, v in enumerate(w):
        e.append(v - ar * (w[t - 1] if t else 0) - ma * (e[t - 1] if t else 0))
    return np.array(e)


def test_arima_beats_every_grid_point():
    y = counts_of(20)
    w = np.diff(y)
    coarse = min(np.sum(arima_errors(w, a, m) ** 2) for a, m in product(np.linspace(-0.9, 0.9, 37), repeat=2))
    coef = np.array([[[0.3, -0.2]]])
    assert arima._errors(w[None, :], coef, 0)[:, 0, 0] == pytest.approx(arima_errors(w, 0.3, -0.2))
    ahead = arima.sarima(y[None, :])[0] - y[-1]
    fine = [(np.sum(arima_errors(w, a, m) ** 2), a * w[-1] + m * arima_errors(w, a, m)[-1])
            for a, m in product(np.linspace(-0.99, 0.99, 199), repeat=2)]
    best = min(fine)
    assert best[0] <= coarse + 1e-9
    assert ahead == pytest.approx(best[1], abs=0.3)


def test_arima_recovers_a_known_process():
    rng = np.random.default_rng(3)
    w = np.zeros(400)
    for t in range(1, 400):
        w[t] = 0.7 * w[t - 1] + rng.normal()
    y = np.concatenate([[0.0], np.cumsum(w)])
    assert arima.sarima(y[None, :23])[0] == pytest.approx(y[22] + 0.7 * w[21], abs=1.5)
    assert arima.fit_forecast(y[None, :], 0)[0] == pytest.approx(y[-1] + 0.7 * w[-1], abs=0.4)


def test_sarima_repeats_a_pure_cycle():
    cycle = np.tile([9.0, 1, 4, 7, 2, 8, 3, 6, 5, 12, 11, 10], 4)
    assert arima.sarima(cycle[None, :])[0] == pytest.approx(9.0)
    assert arima.sarima(np.ones((1, 5))) is None


def test_seasonal_errors_follow_the_polynomials():
    rng = np.random.default_rng(5)
    w = rng.normal(size=30)
    ar, ma, sar, sma = 0.4, -0.3, 0.2, 0.5
    phi = np.convolve([1, -ar], [1] + [0] * 11 + [-sar])
    theta = np.convolve([1, ma], [1] + [0] * 11 + [sma])
    e = np.zeros(30)
    for t in range(30):
        e[t] = sum(phi[k] * w[t - k] for k in range(14) if t >= k)
        e[t] -= sum(theta[k] * e[t - k] for k in range(1, 14) if t >= k)
    got = arima._errors(w[None, :], np.array([[[ar, ma, sar, sma]]]), 12)[:, 0, 0]
    assert got == pytest.approx(e)


def test_kernel_runner_lengths_status_and_failures(lengths):
    def moody(block):
        n = block.shape[1]
        if n < 4:
            return None
        if n == 5:
            raise ArithmeticError
        out = block[:, -1] * 10
        return np.where(n == 6, np.nan, out)

    got = {r.category: r for r in apply_kernel(series_prefixes(lengths), moody).collect()}
    assert len(got) == len(LENGTHS)
    for n in LENGTHS:
        y, r = counts_of(n), got[f"n{n:02d}"]
        want = {"short": n < 4, "error": n in (5, 6), "model": n == 4 or n > 6}
        assert want[r.status]
        assert r.predicted == pytest.approx(y[-1] * 10 if r.status == "model" else mean3(y))
        assert (r.month.year - 2018) * 12 + r.month.month - 3 == n


def test_kernel_folds_see_only_the_past(lengths):
    folds = base.last_folds(lengths, 4)
    for r in apply_kernel(series_prefixes(lengths, folds), lambda b: b.sum(axis=1)).collect():
        n = int(r.category[1:])
        known = (r.fold.year - 2018) * 12 + r.fold.month - 3
        assert r.predicted == counts_of(n)[:known].sum() and r.actual == counts_of(n)[known]


def bayes_by_hand(series):
    """Gaussian naive Bayes on the calendar features, straight from the definition."""
    table = {}
    for name, (first, y) in series.items():
        num, year = months(first, len(y))
        for i in range(len(y)):
            lag1 = y[i - 1] if i else np.nan
            avg = [np.mean(y[i - k : i]) if i >= k else np.nan for k in (3, 6)]
            table[name, i] = [num[i], year[i], lag1, *avg, y[i - 12] if i >= 12 else np.nan]
    keys = [k for k, v in table.items() if not np.isnan(v[4])]
    x = np.array([table[k] for k in keys], dtype=float)
    t = np.array([series[n][1][i] for n, i in keys], dtype=float)
    fill = np.nanmean(x[:, 5]) if (~np.isnan(x[:, 5])).any() else 0.0
    x[:, 5] = np.where(np.isnan(x[:, 5]), fill, x[:, 5])
    positive = t[t > 0]
    lo, hi = 5.0, 20.0
    if len(positive) >= 20:
        lo, hi = np.quantile(positive, [0.33, 0.66])
        lo = max(lo, 1.0)
        hi = max(hi, lo + 1)
    label = np.where(t <= 0, 0, np.where(t <= lo, 1, np.where(t <= hi, 2, 3)))
    eps = 1e-9 * x.var(axis=0).max()
    out = {}
    for name, (first, y) in series.items():
        last = np.array(table[name, len(y) - 1], dtype=float)
        if len(t) < 20:
            out[name] = mean3(y)
        elif np.isnan(last[4]):
            out[name] = float(np.mean(y[-3:])) or float(y[-1])
        else:
            last[5] = fill if np.isnan(last[5]) else last[5]
            scores = {}
            for c in np.unique(label):
                v = x[label == c].var(axis=0) + eps
                m = x[label == c].mean(axis=0)
                scores[c] = np.log(np.mean(label == c)) - 0.5 * np.sum(np.log(2 * np.pi * v) + (last - m) ** 2 / v)
            out[name] = float(np.median(t[label == max(scores, key=scores.get)]))
    return out


@pytest.mark.parametrize("total", [26, 200])
def test_naive_bayes_by_hand(make_series, total):
    rng = np.random.default_rng(total)
    series = {f"s{i}": (D(2019, 1 + i, 1), rng.poisson(3 + 4 * i, n).astype(float))
              for i, n in enumerate([5, 12, min(total // 4, 40), total // 2 if total < 100 else 60])}
    got = predictions(bayes.naive_bayes(features.series_state(make_series(series))))
    assert got == pytest.approx(bayes_by_hand(series))


def test_naive_bayes_below_row_minimum(make_series):
    series = {"a": (D(2020, 1, 1), [1.0, 2, 3, 4, 5, 6, 7, 8]), "b": (D(2020, 1, 1), [4.0])}
    got = predictions(bayes.naive_bayes(features.series_state(make_series(series))))
    assert got == {"a": 7.0, "b": 4.0}


def test_trees_learn_and_repeat(make_series):
    series = {f"s{i}": (D(2015, 1, 1), counts_of(60, i) + 40 * (i % 2)) for i in range(6)}
    frame = make_series(series | {"new": (D(2020, 1, 1), [3.0, 4.0, 5.0])})
    state = features.series_state(frame)
    for model, size in ((trees.random_forest, {"trees": 10}), (trees.gradient_boost, {"rounds": 10})):
        first = predictions(model(state, **size))
        assert first == predictions(model(state, **size))
        assert first["new"] == pytest.approx(4.0)
        errors = [abs(first[f"s{i}"] - counts_of(60, i)[-1] - 40 * (i % 2)) for i in range(6)]
        assert np.mean(errors) < 12


def test_trees_are_the_same_on_any_number_of_tasks(make_series, monkeypatch):
    series = {f"s{i}": (D(2015, 1, 1), counts_of(30 + i, i) + 40 * (i % 2)) for i in range(12)}
    frame = make_series(series)
    state, folds = features.series_state(frame), base.last_folds(frame, 3)
    data = trees.training_table(state, folds)
    assert (np.diff(data.rows) > 0).all() and len(data.months) == 3
    for spec in (trees._forest(5), trees._boosting(5)):
        monkeypatch.setattr(trees, "ONE_TASK", 1_000_000)
        means, one = trees.fit(data, spec)
        monkeypatch.setattr(trees, "ONE_TASK", 0)
        monkeypatch.setattr(trees, "ROUNDS_STORED", 2)
        monkeypatch.setattr(trees, "TREES_AT_ONCE", 3)
        again, several = trees.fit(data, spec)
        assert (means == again).all() and len(one) == len(several) == 5
        for a, b in zip(one, several, strict=True):
            for part in ("feature", "cut", "left", "value", "gain"):
                assert (getattr(a, part) == getattr(b, part)).all()


def test_folds_of_trees_see_only_the_past(make_series):
    rows = {f"s{i}": counts_of(40, i) + 30 * i for i in range(4)}
    frame = make_series({k: (D(2016, 1, 1), v) for k, v in rows.items()})
    folds = base.last_folds(frame, 3)
    other = make_series({k: (D(2016, 1, 1), np.concatenate((v[:38], 1e6 + v[38:]))) for k, v in rows.items()})
    for model, size in ((trees.random_forest, {"trees": 4}), (trees.gradient_boost, {"rounds": 4})):
        a = {(r.category, r.fold): r.predicted for r in model(features.series_state(frame), folds, **size).collect()}
        b = {(r.category, r.fold): r.predicted for r in model(features.series_state(other), folds, **size).collect()}
        assert len(a) == 12
        assert {k: v for k, v in a.items() if k[1] < D(2019, 4, 1)} == {k: v for k, v in b.items() if k[1] < D(2019, 4, 1)}
        assert a != b


def test_inputs_of_the_month_to_come(make_series):
    """The row appended by hand has the features that ``next_month`` works out."""
    y = counts_of(30)
    known = features.series_state(make_series({"a": (D(2018, 3, 1), y)})).where("n = size")
    longer = features.series_state(make_series({"a": (D(2018, 3, 1), np.append(y, 7.0))})).where("n = size").first()
    got = features.anchor_features(known, "next_month").first()
    for name in (*features.CALENDAR, *features.CYCLIC):
        assert got[name] == pytest.approx(longer[name])
    last = features.anchor_features(known).first()
    assert (last.lag1, last.month_num) == (y[28], 8.0) and got.lag1 == y[29]
    with pytest.raises(ValueError, match="anchor"):
        features.anchor_features(known, "tomorrow")


def test_options_reach_the_models(make_series):
    series = make_series({f"s{i}": (D(2015, 1, 1), counts_of(60, i) * (i != 2)) for i in range(4)} | {"new": (D(2019, 11, 1), [3.0, 0.0])})
    names = ["naive", "regression", "naive_bayes", "random_forest", "gradient_boost", "holt", "sarima"]
    small = dict(forest_trees=3, boost_rounds=3)

    def run(**more):
        return {(r.model, r.category): (r.predicted, r.status) for r in registry.run_models(series, names, **small, **more).collect()}

    plain = run()
    anchored = run(anchor="next_month")
    for model in ("regression", "naive_bayes", "random_forest", "gradient_boost"):
        assert any(plain[model, f"s{i}"] != anchored[model, f"s{i}"] for i in range(4)) or model == "naive_bayes"
        assert plain[model, "new"][1] == "short" and plain[model, "s1"][1] == "model"
    assert plain["naive", "s1"] == anchored["naive", "s1"]
    other = run(season=6, arima_order=(0, 1, 1), seasonal_order=(0, 1, 1))
    assert other["sarima", "s1"] != plain["sarima", "s1"] and other["holt", "s1"] != plain["holt", "s1"]
    assert {m for (m, c), v in plain.items() if c == "new" and v[1] == "short"} == {*names} - {"naive"}
    with pytest.raises(ValueError, match="orders"):
        run(arima_order=(4, 1, 1))


def test_trees_without_enough_rows(make_series):
    state = features.series_state(make_series({"a": (D(2020, 1, 1), [1.0, 2, 3, 4, 5, 6, 9])}))
    assert predictions(trees.random_forest(state, trees=2)) == {"a": pytest.approx(20 / 3)}


def test_feature_importance_sums_to_one(make_series):
    series = {f"s{i}": (D(2015, 1, 1), counts_of(40, i)) for i in range(3)}
    rows = trees.feature_importance(features.series_state(make_series(series)), 5, 3).collect()
    for model in ("random_forest", "gradient_boost"):
        assert sum(r.importance for r in rows if r.model == model) == pytest.approx(1.0)


def test_registry(lengths):
    registry.register_model("double", lambda block: block[:, -1] * 2)
    out = registry.run_models(lengths, ["double", "naive", "double"])
    assert {r.model for r in out.select("model").distinct().collect()} == {"double", "naive"}
    assert out.count() == 2 * len(LENGTHS)
    with pytest.raises(ValueError, match="unknown models"):
        registry.run_models(lengths, ["nothing"])
    with pytest.raises(ValueError):
        registry.register_model("naive", lambda block: block[:, -1])


def test_all_seven_models_together(make_series):
    series = make_series({f"s{i}": (D(2018, 1, 1), counts_of(30, i)) for i in range(3)})
    names = ["naive", "regression", "naive_bayes", "holt", "sarima", "random_forest", "gradient_boost"]
    out = registry.run_models(series, names, forest_trees=3, boost_rounds=2).collect()
    assert len(out) == 21 and all(np.isfinite(r.predicted) for r in out)
    assert {r.month for r in out} == {D(2020, 7, 1)}
