"""SQL of searches that go on from the best point found so far, a stage of tables a step."""

from __future__ import annotations

SERIES = (
    "sq AS MATERIALIZED (SELECT category, month, count, row_number() OVER (PARTITION BY category ORDER BY month) AS t, "
    "count(*) OVER (PARTITION BY category) AS n FROM g)"
)


def _smoothed(name: str, points: str) -> str:
    """Sum of squares and next value for ``points(category, n, trended, side, a, sh)``.

    The responses to the counts and to the two start values run side by side; the best
    start is the two-by-two (or one-by-one) least squares solution.
    """
    return f"""{name}r AS (
  SELECT *, a * sh AS b, 0::BIGINT AS t, 0.0::DOUBLE AS ly, 1.0::DOUBLE AS l1, 0.0::DOUBLE AS l2,
    0.0::DOUBLE AS ty, 0.0::DOUBLE AS t1, CAST(trended AS DOUBLE) AS t2,
    0.0::DOUBLE AS s11, 0.0::DOUBLE AS s12, 0.0::DOUBLE AS s22, 0.0::DOUBLE AS c1, 0.0::DOUBLE AS c2, 0.0::DOUBLE AS ss
  FROM ({points})
  UNION ALL
  SELECT category, n, trended, side, a, sh, b, t, nly, nl1, nl2,
    trended * (b * (nly - ly) + (1 - b) * ty), trended * (b * (nl1 - l1) + (1 - b) * t1),
    trended * (b * (nl2 - l2) + (1 - b) * t2),
    s11 + p1 * p1, s12 + p1 * p2, s22 + p2 * p2, c1 + p1 * u, c2 + p2 * u, ss + u * u
  FROM (SELECT r.* EXCLUDE (t), s.t, r.l1 + r.t1 AS p1, r.l2 + r.t2 AS p2, s.count - r.ly - r.ty AS u,
          r.a * s.count + (1 - r.a) * (r.ly + r.ty) AS nly, (1 - r.a) * (r.l1 + r.t1) AS nl1,
          (1 - r.a) * (r.l2 + r.t2) AS nl2
        FROM {name}r r JOIN sq s ON s.category = r.category AND s.t = r.t + 1)),
{name}v AS (SELECT *, CASE WHEN trended = 1 THEN (c1 * s22 - c2 * s12) / (s11 * s22 - s12 * s12) ELSE c1 / s11 END AS v1,
  CASE WHEN trended = 1 THEN (c2 * s11 - c1 * s12) / (s11 * s22 - s12 * s12) ELSE 0.0 END AS v2 FROM {name}r WHERE t = n),
{name}s AS MATERIALIZED (SELECT category, n, trended, side, a, sh, ss - v1 * c1 - v2 * c2 AS sse, ly + ty + v1 * (l1 + t1) + v2 * (l2 + t2) AS predicted FROM {name}v)"""


def smoothing(out_name: str = "bs", halvings: int = 6) -> list[str]:
    """``bs(category, predicted)``: the grid, then steps along level and trend share that are halved each time."""
    out = [
        """ln AS (SELECT 0 AS trended, i / 20.0::DOUBLE AS a, 0.0::DOUBLE AS sh FROM range(21) r(i)
  UNION ALL SELECT DISTINCT 1, i / 20.0::DOUBLE, CASE WHEN i = 0 THEN 0.0 ELSE j / 4.0 END::DOUBLE FROM range(21) r(i), range(5) s(j))""",
        _smoothed("p0", "SELECT category, n, ln.trended, 0 AS side, a, sh FROM sq JOIN ln ON ln.trended = (n >= 12)::INTEGER WHERE sq.t = 1 AND n >= 4 AND n < 24"),
        """b0 AS MATERIALIZED (SELECT category, n, trended, a, sh, sse, predicted FROM (SELECT *, min(sse) OVER (PARTITION BY category) AS low FROM p0s)
  WHERE sse <= low * (1 + 1e-9) + 1e-9 QUALIFY row_number() OVER (PARTITION BY category ORDER BY a, sh) = 1)""",
    ]
    last, number = "b0", 0
    for k in range(1, halvings + 1):
        for axis, step in (("a", 1 / 20), ("sh", 1 / 4)):
            number += 1
            p, b = f"p{number}", f"b{number}"
            moved = f"greatest(0.0, least(1.0, {axis} + side * {step!r}::DOUBLE / {2**k}))"
            columns = f"{moved} AS a, sh" if axis == "a" else f"a, {moved} AS sh"
            only = "" if axis == "a" else " WHERE trended = 1"
            out.append(_smoothed(p, f"SELECT category, n, trended, side, {columns} FROM {last}, (VALUES (-1), (1)) v(side){only}"))
            out.append(f"""{p}c AS (SELECT lo.category, CASE WHEN hi.sse < lo.sse * (1 - 1e-7) - 1e-9 THEN hi ELSE lo END AS w
  FROM {p}s lo JOIN {p}s hi ON hi.category = lo.category AND lo.side = -1 AND hi.side = 1),
{b} AS MATERIALIZED (SELECT l.category, l.n, l.trended, CASE WHEN up THEN w.a ELSE l.a END AS a, CASE WHEN up THEN w.sh ELSE l.sh END AS sh,
  CASE WHEN up THEN w.sse ELSE l.sse END AS sse, CASE WHEN up THEN w.predicted ELSE l.predicted END AS predicted
  FROM (SELECT l.*, w, coalesce(w.sse < l.sse * (1 - 1e-7) - 1e-9, FALSE) AS up FROM {last} l LEFT JOIN {p}c c ON c.category = l.category) l)""")
            last = b
    out.append(f"{out_name} AS (SELECT category, predicted FROM {last})")
    return out


def _conditional(name: str, points: str) -> str:
    """Sum of squares of the one-step errors and the next value for ``points(category, n, i, ar, ma)``, of first differences."""
    return f"""{name}r AS (
  SELECT *, 1::BIGINT AS t, 0.0::DOUBLE AS w, 0.0::DOUBLE AS e, 0.0::DOUBLE AS sse FROM ({points})
  UNION ALL
  SELECT category, n, i, ar, ma, t, x, x - ar * w - ma * e, sse + (x - ar * w - ma * e) * (x - ar * w - ma * e)
  FROM (SELECT r.* EXCLUDE (t), s.t, s.step AS x FROM {name}r r JOIN df s ON s.category = r.category AND s.t = r.t + 1)),
{name}s AS (SELECT category, n, i, ar, ma, sse, ar * w + ma * e AS ahead, min(sse) OVER (PARTITION BY category) AS low FROM {name}r WHERE t = n),
{name}b AS MATERIALIZED (SELECT category, n, ar, ma, ahead FROM {name}s WHERE sse <= low * (1 + 1e-9) + 1e-9
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY i) = 1)"""


def arima(out_name: str = "bs", halvings: int = 6) -> list[str]:
    """``bs(category, predicted)`` of ARIMA(1,1,1): 19 x 19 points, then the nine around the best at half the step."""
    out = [
        "df AS MATERIALIZED (SELECT category, t, n, count - lag(count) OVER (PARTITION BY category ORDER BY t) AS step FROM sq WHERE n >= 6 AND n < 24)",
        "mk AS (SELECT x * 19 + y AS i, (x - 9) / 10.0::DOUBLE AS ar, (y - 9) / 10.0::DOUBLE AS ma FROM range(19) a(x), range(19) b(y))",
        _conditional("a0", "SELECT category, n, mk.i, mk.ar, mk.ma FROM df, mk WHERE t = 1"),
        "of AS (SELECT x * 3 + y AS i, x - 1 AS dx, y - 1 AS dy FROM range(3) a(x), range(3) b(y))",
    ]
    for k in range(1, halvings + 1):
        step = f"0.1::DOUBLE / {2**k}"
        out.append(
            _conditional(
                f"a{k}",
                f"SELECT category, n, of.i, greatest(-0.99, least(0.99, ar + dx * {step})) AS ar, greatest(-0.99, least(0.99, ma + dy * {step})) AS ma FROM a{k - 1}b, of",
            )
        )
    out.append(f"{out_name} AS (SELECT b.category, sq.count + ahead AS predicted FROM a{halvings}b b JOIN sq ON sq.category = b.category AND sq.t = b.n)")
    return out


def one_split(features: tuple[str, ...], bins: int = 64, min_leaf: int = 10, rate: float = 0.05) -> list[str]:
    """``sp(f, c, s, below, above)``: the split of training rows ``tn`` that leaves the least squares, and ``mu(m, n)``.

    Cuts are the 1/64 quantiles of a feature; missing values go to the side where they fit better.
    """
    probs = ", ".join(f"{k}/{bins}::DOUBLE" for k in range(1, bins))
    long = " UNION ALL ".join(f"SELECT {k} AS f, {name} AS x, count - m AS r FROM tn, mu" for k, name in enumerate(features))
    return [
        "mu AS MATERIALIZED (SELECT avg(count) AS m, count(*) AS n FROM tn)",
        f"lo AS MATERIALIZED ({long})",
        f"cu AS MATERIALIZED (SELECT DISTINCT f, unnest(quantile_disc(x, [{probs}])) AS c FROM lo WHERE x IS NOT NULL GROUP BY f)",
        """ca AS (SELECT f, c, s, count(*) FILTER (l) AS nl, sum(r) FILTER (l) AS sl, count(*) FILTER (NOT l) AS nr, sum(r) FILTER (NOT l) AS sr
  FROM (SELECT lo.f, c, s, r, coalesce(x <= c, s = 1) AS l FROM lo JOIN cu ON cu.f = lo.f, (VALUES (0), (1)) v(s)) GROUP BY f, c, s)""",
        f"""sp AS MATERIALIZED (SELECT f, c, s, sl / nl * {rate} AS below, sr / nr * {rate} AS above FROM ca WHERE nl >= {min_leaf} AND nr >= {min_leaf}
  ORDER BY round(sl * sl / nl + sr * sr / nr, 4) DESC, f, c, s LIMIT 1)""",
    ]
