"""SQL that computes the same tables as the registered queries, for DuckDB.

Written from the definitions, not from the Spark plans: calendars by series and
join, folds by comparison, ridge by elimination over sums, smoothing by recursion.
"""

from __future__ import annotations

from . import staged

FINAL = "DATE '9999-12-01'"
LABELS = (
    "CASE model WHEN 'naive' THEN 'Seasonal Naive' WHEN 'regression' THEN 'Ridge Regression' "
    "WHEN 'naive_bayes' THEN 'Naive Bayes' END"
)

ORACLES: dict[str, str] = {}


def day(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


def num(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def big(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


def q(name: str, *ctes: str, select: str, recursive: bool = False) -> None:
    head = "WITH RECURSIVE " if recursive else "WITH "
    ORACLES[name] = (head + ",\n".join(ctes) + "\n" if ctes else "") + select


# Bindings.


def rolled(source: str, category: str, day_column: str, count: str, name: str = "m", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT CAST({category} AS VARCHAR) AS category, CAST(date_trunc('month', {day_column}) AS DATE) AS month,
         CAST(sum({count}) AS DOUBLE) AS count
  FROM {source} WHERE {where} GROUP BY 1, 2)"""


BRAND_ROLLED = rolled("lineitem JOIN part ON l_partkey = p_partkey", "p_brand", "l_shipdate", "l_quantity")
TYPE_ROLLED = rolled("lineitem JOIN part ON l_partkey = p_partkey", "p_type", "l_shipdate", "l_quantity")
CUSTOMER_ROLLED = rolled("orders", "o_custkey", "o_orderdate", "1")
PART_ROLLED = rolled("lineitem", "l_partkey", "l_shipdate", "l_quantity")
CYCLE_ROLLED = rolled(
    "orders",
    "CAST(o_custkey AS VARCHAR) || '-' || CAST((year(o_orderdate) * 12 + month(o_orderdate) - 1) // 18 AS VARCHAR)",
    "o_orderdate",
    "1",
)
FILLED = """g AS (
  SELECT s.category, s.month, coalesce(m.count, 0.0) AS count
  FROM (SELECT category, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
        FROM m GROUP BY category) s
  LEFT JOIN m ON m.category = s.category AND m.month = s.month)"""

BRAND = (BRAND_ROLLED, FILLED)
TYPE = (TYPE_ROLLED, FILLED)
CUSTOMER = (CUSTOMER_ROLLED, FILLED)
PART = (PART_ROLLED, FILLED)
CYCLE = (CYCLE_ROLLED, FILLED)

_W = "PARTITION BY category ORDER BY month"
STATE = f"""st AS (
  SELECT category, month, count,
    row_number() OVER ({_W}) AS n,
    count(*) OVER (PARTITION BY category) AS size,
    CAST(month + INTERVAL 1 MONTH AS DATE) AS next_month,
    CAST(month(month) AS DOUBLE) AS month_num, CAST(year(month) AS DOUBLE) AS year,
    lag(count, 1) OVER ({_W}) AS lag1, lag(count, 2) OVER ({_W}) AS lag2,
    lag(count, 3) OVER ({_W}) AS lag3, lag(count, 12) OVER ({_W}) AS lag12,
    CASE WHEN row_number() OVER ({_W}) > 3
      THEN avg(count) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS avg3,
    CASE WHEN row_number() OVER ({_W}) > 6
      THEN avg(count) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS avg6,
    avg(count) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS tail3
  FROM g)"""


# Models. ``s`` keeps the names of the real forecast and the backtest apart.


def folds(s: str, months: int | None) -> str:
    """Training rows and the last one of each series per fold; ``act`` is the value to hit."""
    table = f"SELECT {FINAL} AS fold" if months is None else (
        f"SELECT DISTINCT month AS fold FROM g ORDER BY fold DESC LIMIT {months}"
    )
    return f"""fo{s} AS ({table}),
tr{s} AS (SELECT st.*, fold FROM st JOIN fo{s} ON month < fold),
an{s} AS (
  SELECT t.*, a.count AS act, CASE WHEN n >= 3 THEN tail3 ELSE t.count END AS fallback
  FROM (SELECT * FROM tr{s} QUALIFY row_number() OVER (PARTITION BY fold, category ORDER BY month DESC) = 1) t
  LEFT JOIN g a ON a.category = t.category AND a.month = t.fold)"""


def naive(s: str) -> str:
    return f"""naive{s} AS (
  SELECT fold, category, next_month AS month, act,
    CASE WHEN base = 0 AND n >= 3 AND tail3 > 0 THEN tail3 ELSE base END AS predicted
  FROM (SELECT an.*, coalesce(p.count, an.count) AS base
        FROM an{s} an LEFT JOIN g p
          ON p.category = an.category AND p.month = CAST(an.next_month - INTERVAL 12 MONTH AS DATE)))"""


def ridge(s: str) -> str:
    idx = range(1, 6)
    pairs = [(i, j) for i in idx for j in idx if i <= j]
    lags = "(a.n >= 16 OR a.n BETWEEN 7 AND 12)"
    parts = [
        f"""rx{s} AS (
  SELECT t.fold, t.category, t.count AS y, t.month_num AS x1, t.year AS x2,
    CASE WHEN {lags} THEN t.lag1 ELSE 0 END AS x3, CASE WHEN {lags} THEN t.avg3 ELSE 0 END AS x4,
    CASE WHEN a.n >= 16 THEN t.lag12 ELSE 0 END AS x5
  FROM tr{s} t JOIN an{s} a ON a.fold = t.fold AND a.category = t.category
  WHERE a.n >= 6 AND CASE WHEN a.n >= 16 THEN t.lag12 IS NOT NULL AND t.avg3 IS NOT NULL
                          WHEN a.n BETWEEN 7 AND 12 THEN t.avg3 IS NOT NULL ELSE TRUE END)""",
        f"rm{s} AS (SELECT fold, category, avg(y) AS my, "
        + ", ".join(f"avg(x{i}) AS m{i}" for i in idx)
        + f" FROM rx{s} GROUP BY fold, category)",
        f"r0{s} AS (SELECT r.fold, r.category, "
        + ", ".join(
            f"sum((x{i} - m{i}) * (x{j} - m{j})){' + 1.0' if i == j else ''} AS a{i}{j}" for i, j in pairs
        )
        + ", "
        + ", ".join(f"sum((x{i} - m{i}) * (y - my)) AS b{i}" for i in idx)
        + f" FROM rx{s} r JOIN rm{s} u ON u.fold = r.fold AND u.category = r.category GROUP BY r.fold, r.category)",
    ]
    for k in range(1, 5):
        cells = []
        for i, j in pairs:
            cells.append(f"a{i}{j}" if i <= k else f"a{i}{j} - a{k}{i} * a{k}{j} / a{k}{k} AS a{i}{j}")
        for i in idx:
            cells.append(f"b{i}" if i <= k else f"b{i} - a{k}{i} * b{k} / a{k}{k} AS b{i}")
        parts.append(f"r{k}{s} AS (SELECT fold, category, {', '.join(cells)} FROM r{k - 1}{s})")
    last = f"r4{s}"
    for k in range(5, 0, -1):
        known = "".join(f" - a{k}{j} * w{j}" for j in range(k + 1, 6))
        parts.append(f"w{k}{s} AS (SELECT *, (b{k}{known}) / a{k}{k} AS w{k} FROM {last})")
        last = f"w{k}{s}"
    parts.append(f"""ridge{s} AS (
  SELECT a.fold, a.category, a.next_month AS month, a.act,
    CASE WHEN a.n < 6 THEN a.fallback ELSE my + w1 * (month(a.next_month) - m1) + w2 * (year(a.next_month) - m2)
      + CASE WHEN {lags} THEN w3 * (a.count - m3) + w4 * (a.tail3 - m4) ELSE 0 END
      + CASE WHEN a.n >= 16 THEN w5 * (a.lag12 - m5) ELSE 0 END END AS predicted
  FROM an{s} a LEFT JOIN {last} w ON w.fold = a.fold AND w.category = a.category
  LEFT JOIN rm{s} u ON u.fold = a.fold AND u.category = a.category)""")
    return ",\n".join(parts)


CALENDAR = ("month_num", "year", "lag1", "avg3", "avg6", "lag12")


def nb_fit(s: str) -> str:
    """Training rows with filled lag12, bins, class statistics and medians per fold."""
    core = ", ".join(c for c in CALENDAR if c != "lag12")
    moments = ", ".join(f"avg({c}) AS mean_{c}, var_pop({c}) AS raw_{c}" for c in CALENDAR)
    top = ", ".join(f"var_pop({c})" for c in CALENDAR)
    smoothed = ", ".join(f"raw_{c} + 1e-9 * top_variance AS var_{c}" for c in CALENDAR)
    means = ", ".join(f"mean_{c}" for c in CALENDAR)
    return f"""nc{s} AS (
  SELECT fold, count(*) AS train_rows, coalesce(avg(lag12), 0.0) AS lag12_mean
  FROM tr{s} WHERE avg6 IS NOT NULL GROUP BY fold),
nt{s} AS (
  SELECT t.fold, category, month, count, {core}, coalesce(lag12, lag12_mean) AS lag12, train_rows
  FROM tr{s} t JOIN nc{s} c ON c.fold = t.fold WHERE avg6 IS NOT NULL),
nq{s} AS (
  SELECT fold, count(*) FILTER (count > 0) AS nonzero,
    greatest(quantile_cont(count, 0.33) FILTER (count > 0), 1.0) AS lo,
    quantile_cont(count, 0.66) FILTER (count > 0) AS hi
  FROM nt{s} GROUP BY fold),
nb{s} AS (
  SELECT fold, nonzero, CASE WHEN nonzero >= 20 THEN lo ELSE 5.0 END AS low_edge,
    CASE WHEN nonzero >= 20 THEN greatest(hi, lo + 1) ELSE 20.0 END AS high_edge
  FROM nq{s}),
nl{s} AS (
  SELECT t.*, CASE WHEN count <= 0 THEN 0 WHEN count <= low_edge THEN 1 WHEN count <= high_edge THEN 2 ELSE 3 END AS class
  FROM nt{s} t JOIN nb{s} b ON b.fold = t.fold),
nv{s} AS (SELECT fold, greatest({top}) AS top_variance, median(count) AS overall FROM nt{s} GROUP BY fold),
ns{s} AS (
  SELECT x.fold, class, class_rows, train_rows, median, {means}, {smoothed}
  FROM (SELECT fold, class, count(*) AS class_rows, max(train_rows) AS train_rows, median(count) AS median, {moments}
        FROM nl{s} GROUP BY fold, class) x JOIN nv{s} v ON v.fold = x.fold)"""


def nb(s: str) -> str:
    terms = []
    for c in CALENDAR:
        x = "coalesce(a.lag12, c.lag12_mean)" if c == "lag12" else f"a.{c}"
        terms.append(f"ln(2 * pi() * var_{c}) + ({x} - mean_{c}) * ({x} - mean_{c}) / var_{c}")
    score = "ln(class_rows / k.train_rows) - 0.5 * (" + " + ".join(terms) + ")"
    return f"""{nb_fit(s)},
nw{s} AS (
  SELECT a.fold, a.category, k.median
  FROM an{s} a JOIN nc{s} c ON c.fold = a.fold JOIN ns{s} k ON k.fold = a.fold
  WHERE a.avg6 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a.fold, a.category ORDER BY {score} DESC, class) = 1),
bayes{s} AS (
  SELECT a.fold, a.category, a.next_month AS month, a.act,
    CASE WHEN coalesce(c.train_rows, 0) < 20 THEN a.fallback
         WHEN a.avg6 IS NULL THEN CASE WHEN a.tail3 > 0 THEN a.tail3 ELSE a.count END
         ELSE w.median END AS predicted
  FROM an{s} a LEFT JOIN nc{s} c ON c.fold = a.fold
  LEFT JOIN nw{s} w ON w.fold = a.fold AND w.category = a.category)"""


def three_models(s: str, months: int | None) -> tuple[str, ...]:
    union = " UNION ALL ".join(
        f"SELECT fold, category, month, act, predicted, '{label}' AS model FROM {cte}{s}"
        for cte, label in (("naive", "naive"), ("ridge", "regression"), ("bayes", "naive_bayes"))
    )
    return (folds(s, months), naive(s), ridge(s), nb(s), f"all{s} AS ({union})")


FORECASTS = (
    STATE,
    *three_models("_f", None),
    """base AS (SELECT category, month, greatest(predicted, 0.0) AS predicted, model FROM all_f),
fc AS (SELECT * FROM base UNION ALL
       SELECT category, max(month), avg(predicted), 'ensemble' FROM base GROUP BY category)""",
)


def tested(months: int = 3, clip: bool = False) -> tuple[str, ...]:
    value = "greatest(predicted, 0.0)" if clip else "predicted"
    return (
        *three_models("_b", months),
        f"""bt AS (
  SELECT model, fold AS eval_month, category, actual, predicted, predicted - actual AS error,
    abs(predicted - actual) AS abs_error, greatest(actual, 1.0) AS denom,
    abs(predicted - actual) / greatest(actual, 1.0) AS ape
  FROM (SELECT model, fold, category, act AS actual, {value} AS predicted FROM all_b WHERE act IS NOT NULL))""",
    )


CORE = """co AS (
  SELECT model, avg(abs_error) AS mae, sqrt(avg(error * error)) AS rmse, avg(ape) AS mape, count(*) AS samples
  FROM bt GROUP BY model)"""
WEIGHTS = (
    CORE,
    "we AS (SELECT model, (1 / greatest(mape, 0.001)) / sum(1 / greatest(mape, 0.001)) OVER () AS weight FROM co)",
)


def view(model: str) -> str:
    return f"""vw AS (
  SELECT f.category, f.month, predicted, coalesce(l.count, 0.0) AS last_month, coalesce(h.mean, 0.0) AS hist_avg,
    predicted - coalesce(l.count, 0.0) AS delta,
    (predicted - coalesce(h.mean, 0.0)) / greatest(coalesce(h.mean, 0.0), 1.0) * 100 AS vs_avg_pct
  FROM (SELECT * FROM fc WHERE model = '{model}') f
  LEFT JOIN (SELECT category, count FROM g WHERE month = (SELECT max(month) FROM g)) l ON l.category = f.category
  LEFT JOIN (SELECT category, avg(count) AS mean FROM g GROUP BY category) h ON h.category = f.category)"""


BRAND_FC = (*BRAND, *FORECASTS)
BRAND_VIEW = (*BRAND_FC, view("ensemble"))
BRAND_BT = (*BRAND, STATE, *tested())
NAIVE_FC = (
    *CUSTOMER,
    STATE,
    folds("_f", None),
    naive("_f"),
    "fc AS (SELECT category, month, greatest(predicted, 0.0) AS predicted, 'naive' AS model FROM naive_f)",
)
CUSTOMER_VIEW = (*NAIVE_FC, view("naive"))

# Preparation.

q("material_exact", select="SELECT p_partkey, p_type FROM part WHERE lower(trim(p_type)) = 'promo'")
q(
    "material_fallback",
    select="""SELECT p_partkey, p_name FROM part
WHERE CASE WHEN EXISTS (SELECT 1 FROM part WHERE lower(trim(p_name)) = 'bolt') THEN lower(trim(p_name)) = 'bolt'
      ELSE lower(p_name) LIKE '%bolt%' AND lower(p_name) NOT LIKE '%red bolt%' END""",
)
q(
    "month_from_date",
    """t AS (SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'no date'
    WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-13-01')
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN '2-HIGH' THEN strftime(o_orderdate, '%b %-d, %Y')
    ELSE CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d') WHEN 'F' THEN strftime(o_orderdate, '%Y/%m/%d')
      ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS day
  FROM orders)""",
    select="""SELECT o_orderkey, CAST(CAST(date_trunc('month',
  try_strptime(day, ['%Y-%m-%d', '%m/%d/%Y', '%b %d, %Y', '%Y%m%d', '%Y/%m/%d'])) AS DATE) AS VARCHAR) AS month FROM t""",
)
q(
    "month_from_parts",
    """t AS (SELECT o_orderstatus AS category, year(o_orderdate) AS y, CASE o_orderpriority WHEN '1-URGENT' THEN '13'
    WHEN '2-HIGH' THEN '0' WHEN '3-MEDIUM' THEN 'abc' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS m FROM orders)""",
    select=f"""SELECT category, CAST(make_date(y, TRY_CAST(m AS INTEGER), 1) AS VARCHAR) AS month,
  CAST(count(*) AS DOUBLE) AS count FROM t WHERE TRY_CAST(m AS INTEGER) BETWEEN 1 AND 12 GROUP BY 1, 2""",
)
q(
    "month_by_layout",
    """t AS (SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 'no date' WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%-d/%-m/%Y') END AS day FROM orders)""",
    select="SELECT o_orderkey, CAST(CAST(date_trunc('month', try_strptime(day, '%d/%m/%Y')) AS DATE) AS VARCHAR) AS month FROM t",
)
q(
    "read_report",
    select="""SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (p <> '5-LOW' AND p <> '2-HIGH' AND s <> 'P') AS BIGINT) AS kept,
  CAST(count(*) FILTER (p = '5-LOW' OR p = '2-HIGH') AS BIGINT) AS no_month, CAST(count(*) FILTER (s = 'P') AS BIGINT) AS no_category,
  CAST(count(*) FILTER (p = '1-URGENT' AND s <> 'P') AS BIGINT) AS no_count, 'd/M/yyyy[ H:mm:ss]' AS layout
FROM (SELECT o_orderpriority AS p, o_orderstatus AS s FROM orders)""",
)
q(
    "customer_csv",
    select="""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, (SELECT count(*) FROM customer) AS rows FROM customer""",
)
q("monthly_by_roles", rolled("orders", "o_orderpriority", "o_orderdate", "o_totalprice", where="o_orderstatus = 'F'"), select=f"SELECT category, {day('month')}, {num('count')} FROM m")
q(
    "landed_pages",
    select="""SELECT CAST(o_orderkey AS VARCHAR) AS "key", CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_custkey AS VARCHAR) END AS customer,
  o_orderpriority || chr(10) || '"' || o_orderstatus || '",' AS note FROM orders""",
)
q(
    "count_coercion",
    rolled("lineitem", "l_linestatus", "l_shipdate", "CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END"),
    select=f"SELECT category, {day('month')}, {num('count')} FROM m",
)
_SERIES = f"SELECT category, {day('month')}, {num('count')} FROM "
q("monthly_rollup", BRAND_ROLLED, select=_SERIES + "m")
q("monthly_rollup_countless", CUSTOMER_ROLLED, select=_SERIES + "m")
q(
    "monthly_rollup_material",
    rolled("lineitem JOIN part ON l_partkey = p_partkey", "p_brand", "l_shipdate", "l_quantity", where="p_type = 'PROMO'"),
    select=_SERIES + "m",
)
q("gap_fill", *CUSTOMER, select=_SERIES + "g")
q("gap_fill_part", *PART, select=_SERIES + "g")
q("exclude_latest", *BRAND, select=_SERIES + "g WHERE month < (SELECT max(month) FROM g)")
q("category_totals", *CUSTOMER, select=f"SELECT category, {num('total')} FROM (SELECT category, sum(count) AS total FROM g GROUP BY 1)")
TOP20 = "(SELECT category FROM g GROUP BY category ORDER BY sum(count) DESC, category LIMIT {n})"
q("top_items", *CUSTOMER, select=_SERIES + f"g WHERE category IN {TOP20.format(n=20)}")
LONG = "(SELECT category FROM g GROUP BY category HAVING count(DISTINCT month) >= {n})"
q("min_history", *CUSTOMER, select=_SERIES + f"g WHERE category IN {LONG.format(n=70)}")
RECENT = """(SELECT category FROM (SELECT * FROM g {where}
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY month DESC) <= {w}) WHERE count > 0
  GROUP BY category HAVING count(*) >= {k})"""
q(
    "recent_activity",
    CUSTOMER_ROLLED,
    FILLED.replace("g AS (", "g AS MATERIALIZED (", 1),
    """back AS (SELECT category, count, row_number() OVER (PARTITION BY category ORDER BY month DESC) AS place FROM g),
live AS MATERIALIZED (SELECT category FROM back WHERE place <= 6 GROUP BY category HAVING count(*) FILTER (WHERE count > 0) >= 2)""",
    select="SELECT g.category, CAST(g.month AS VARCHAR) AS month, round(g.count, 6) + 0.0 AS count FROM g JOIN live ON live.category = g.category",
)
q(
    "filter_sparse",
    *CUSTOMER,
    select=_SERIES + f"g WHERE category IN {LONG.format(n=12)} AND category IN {RECENT.format(w=6, k=2, where='')}",
)


def relaxed(min_nonzero: int) -> tuple[str, str]:
    return (
        f"""ok AS (SELECT category FROM {TOP20.format(n=30)} WHERE category IN {LONG.format(n=3)}
  AND category IN {RECENT.format(w=6, k=min_nonzero, where='')}),
fl AS (SELECT count(*) < 5 AS relaxed FROM ok),
lo AS (SELECT category FROM {LONG.format(n=2)})""",
        f"""SELECT category, {day('month')}, {num('count')}, relaxed FROM g, fl
WHERE CASE WHEN relaxed THEN category IN (SELECT category FROM lo) ELSE category IN (SELECT category FROM ok) END""",
    )


for _name, _k in (("auto_relax_kept", 1), ("auto_relax_loosened", 6)):
    _cte, _select = relaxed(_k)
    q(_name, *CUSTOMER, _cte, select=_select)
q("history_length", *CUSTOMER, select="SELECT category, CAST(count(DISTINCT month) AS BIGINT) AS months FROM g GROUP BY category")
q(
    "run_summary",
    *CUSTOMER,
    select="""SELECT CAST(count(*) AS BIGINT) AS rows, count(DISTINCT category) AS categories,
  CAST(min(month) AS VARCHAR) AS first_month, CAST(max(month) AS VARCHAR) AS last_month,
  count(DISTINCT month) AS months FROM g""",
)
q(
    "count_stats",
    *PART,
    select=f"""SELECT {num('mean', 'std', 'max', 'total', 'sparsity', 'median')} FROM (
  SELECT avg(count) AS mean, stddev_samp(count) AS std, max(count) AS max, sum(count) AS total,
    avg(CASE WHEN count = 0 THEN 1.0 ELSE 0.0 END) AS sparsity, median(count) AS median FROM g)""",
)
q(
    "count_quantiles",
    select=f"""SELECT l_returnflag, {num(*[f'q{i}' for i in range(5)])} FROM (SELECT l_returnflag,
  """ + ", ".join(f"quantile_cont(l_extendedprice, {p}) AS q{i}" for i, p in enumerate((0.0, 0.33, 0.5, 0.66, 1.0)))
    + " FROM lineitem GROUP BY l_returnflag)",
)
_LAST = "(SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY category ORDER BY month DESC) <= {w})"
q(
    "recent_average",
    *CUSTOMER,
    select=f"SELECT category, {num('recent_avg')} FROM (SELECT category, avg(count) AS recent_avg FROM {_LAST.format(w=6)} GROUP BY 1)",
)
q("overall_average", *CUSTOMER, select=f"SELECT category, {num('overall_avg')} FROM (SELECT category, avg(count) AS overall_avg FROM g GROUP BY 1)")
q(
    "last_month_counts",
    *CUSTOMER,
    select=f"SELECT category, {day('month')}, count AS last_month FROM g WHERE month = (SELECT max(month) FROM g)",
)
q(
    "labels_text",
    """t AS (SELECT *, o_orderpriority || ' ' || o_orderstatus || ' ' || CAST(o_orderkey AS VARCHAR) AS text,
  CAST(round_even(o_totalprice, 0) AS BIGINT) AS p, CAST(round_even(o_totalprice - 250000, 0) AS BIGINT) AS d FROM orders)""",
    select="""SELECT o_orderkey, CASE WHEN length(text) <= 14 THEN text ELSE substr(text, 1, 13) || '…' END AS label,
  format('{:,}', p) AS number,
  CASE WHEN o_totalprice >= 250000 THEN '+' ELSE '' END || CASE WHEN d = 0 AND o_totalprice < 250000 THEN '-' ELSE '' END
    || format('{:,}', d) AS signed,
  strftime(o_orderdate, '%b %Y') AS month_label,
  CASE WHEN o_totalprice >= 250000 THEN 'Rising' ELSE 'Falling' END AS direction FROM t""",
)

# Features and per-series models.

_CALENDAR = f"category, {day('month')}, {num('count', *CALENDAR)}"
q("features_calendar", *CUSTOMER, STATE, select=f"SELECT {_CALENDAR} FROM st")
q("train_rows", *CUSTOMER, STATE, select=f"SELECT {_CALENDAR} FROM st WHERE avg6 IS NOT NULL")
q(
    "features_cyclic",
    *BRAND,
    STATE,
    select=f"""SELECT category, {day('month')}, {num('count')}, round(sin(2 * pi() * month(month) / 12), 6) + 0.0 AS month_sin,
  round(cos(2 * pi() * month(month) / 12), 6) + 0.0 AS month_cos, CAST(year(month) - 2010 AS DOUBLE) AS year_norm,
  {num('lag1', 'lag2', 'lag3', 'avg3', 'avg6', 'lag12')} FROM st""",
)
_PREDICTED = f"SELECT category, {day('month')}, {num('predicted')} FROM "
q(
    "recent_mean_fallback",
    *CYCLE,
    STATE,
    folds("_f", None),
    select=f"SELECT category, CAST(next_month AS VARCHAR) AS month, round(fallback, 6) + 0.0 AS predicted FROM an_f",
)
q(
    "seasonal_naive",
    CUSTOMER_ROLLED,
    FILLED.replace("g AS (", "g AS MATERIALIZED (", 1),
    f"""ends AS (SELECT category, month, row_number() OVER (PARTITION BY category ORDER BY month DESC) AS place, count(*) OVER (PARTITION BY category) AS n,
  coalesce(lag(count, 11) OVER ({_W}), count) AS base, avg(count) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent FROM g)""",
    select="""SELECT category, CAST(CAST(month + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month,
  round(CASE WHEN base = 0 AND n >= 3 AND recent > 0 THEN recent ELSE base END, 6) + 0.0 AS predicted FROM ends WHERE place = 1""",
)
for _name, _binding in (("ridge_brand", BRAND), ("ridge_cycle", CYCLE), ("ridge_part", PART)):
    q(_name, *_binding, STATE, folds("_f", None), ridge("_f"), select=_PREDICTED + "ridge_f")

q(
    "smoothing_cycle",
    *CYCLE,
    staged.SERIES,
    *staged.smoothing(),
    STATE,
    folds("_f", None),
    select="""SELECT a.category, CAST(next_month AS VARCHAR) AS month, round(coalesce(bs.predicted, fallback), 6) + 0.0 AS predicted,
  CASE WHEN bs.category IS NULL THEN 'short' ELSE 'model' END AS status
FROM an_f a LEFT JOIN bs ON bs.category = a.category""",
    recursive=True,
)
q(
    "arima",
    *CYCLE,
    staged.SERIES,
    *staged.arima(),
    STATE,
    folds("_f", None),
    select="""SELECT a.category, CAST(next_month AS VARCHAR) AS month, round(coalesce(bs.predicted, fallback), 6) + 0.0 AS predicted,
  CASE WHEN bs.category IS NULL THEN 'short' ELSE 'model' END AS status
FROM an_f a LEFT JOIN bs ON bs.category = a.category""",
    recursive=True,
)
q(
    "stream_closed_months",
    CUSTOMER_ROLLED,
    select=_SERIES + "m WHERE month <= (SELECT max(month) FROM m) - INTERVAL 62 DAY",
)
q(
    "custom_model",
    *CUSTOMER,
    STATE,
    select="""SELECT l.category, CAST(l.next_month AS VARCHAR) AS month,
  round(CASE WHEN l.n < 2 THEN l.count ELSE l.count + (l.count - f.count) / (l.n - 1) END, 6) + 0.0 AS predicted,
  CASE WHEN l.n < 2 THEN 'short' ELSE 'model' END AS status, 'drift' AS model
FROM st l JOIN st f ON f.category = l.category AND f.n = 1 WHERE l.n = l.size""",
)

_FIVE = "SELECT category, month, greatest(predicted, 0.0) AS predicted, model FROM"
q(
    "blend_five_models",
    *CYCLE,
    staged.SERIES,
    *staged.smoothing("hw"),
    *staged.arima("sa"),
    STATE,
    *three_models("_f", None),
    f"""base AS ({_FIVE} all_f UNION ALL
  {_FIVE} (SELECT a.category, next_month AS month, coalesce(hw.predicted, fallback) AS predicted, 'holt' AS model FROM an_f a LEFT JOIN hw ON hw.category = a.category) UNION ALL
  {_FIVE} (SELECT a.category, next_month AS month, coalesce(sa.predicted, fallback) AS predicted, 'sarima' AS model FROM an_f a LEFT JOIN sa ON sa.category = a.category))""",
    select=f"""SELECT category, {day('month')}, {num('predicted')}, model FROM (
  SELECT * FROM base UNION ALL SELECT category, max(month) AS month, avg(predicted) AS predicted, 'ensemble' AS model FROM base GROUP BY category)""",
    recursive=True,
)

# Models over all series.

_CYCLIC = ("month_sin", "month_cos", "year_norm", "lag1", "lag2", "lag3", "avg3", "avg6", "lag12")
_CIRCLE = "sin(2 * pi() * month(month) / 12) AS month_sin, cos(2 * pi() * month(month) / 12) AS month_cos, CAST(year(month) - 2010 AS DOUBLE) AS year_norm"
q(
    "forecast_files",
    *CUSTOMER,
    STATE,
    folds("_f", None),
    naive("_f"),
    select=f"SELECT category, {day('month')}, {num('predicted')}, 'naive' AS model FROM naive_f",
)
q(
    "forecast_status",
    *CYCLE,
    STATE,
    folds("_f", None),
    naive("_f"),
    """ln AS (SELECT a.category, a.n, v.base = 0 AND a.n >= 3 AND a.tail3 > 0 AS gave_way FROM an_f a JOIN (
  SELECT an.category, coalesce(p.count, an.count) AS base FROM an_f an LEFT JOIN g p
  ON p.category = an.category AND p.month = CAST(an.next_month - INTERVAL 12 MONTH AS DATE)) v ON v.category = a.category),
wh AS (SELECT 'naive' AS model, n, CASE WHEN gave_way THEN 'fallback' ELSE 'model' END AS status FROM ln
  UNION ALL SELECT 'regression', n, CASE WHEN n < 6 THEN 'short' ELSE 'model' END FROM ln
  UNION ALL SELECT 'naive_bayes', n, CASE WHEN n < 7 THEN 'short' ELSE 'model' END FROM ln
  UNION ALL SELECT 'holt', n, CASE WHEN n < 4 THEN 'short' ELSE 'model' END FROM ln
  UNION ALL SELECT 'sarima', n, CASE WHEN n < 6 THEN 'short' ELSE 'model' END FROM ln)""",
    select="SELECT model, CAST(n AS BIGINT) AS months, status, CAST(count(*) AS BIGINT) AS series FROM wh GROUP BY model, n, status",
)
q(
    "nb_next_month",
    *CUSTOMER,
    STATE,
    folds("_f", None),
    f"""ax_f AS (SELECT * REPLACE (CAST(month(next_month) AS DOUBLE) AS month_num, CAST(year(next_month) AS DOUBLE) AS year, count AS lag1,
    CASE WHEN n >= 3 THEN tail3 END AS avg3, CASE WHEN n >= 6 THEN tail6 END AS avg6, lag11 AS lag12)
  FROM (SELECT an_f.*, avg(g.count) FILTER (back <= 6) OVER w AS tail6, max(g.count) FILTER (back = 12) OVER w AS lag11,
      row_number() OVER (PARTITION BY an_f.category ORDER BY back) AS one
    FROM an_f JOIN (SELECT category, count, row_number() OVER (PARTITION BY category ORDER BY month DESC) AS back FROM g) g ON g.category = an_f.category
    WINDOW w AS (PARTITION BY an_f.category)) WHERE one = 1)""",
    nb("_f").replace("an_f", "ax_f"),
    select=_PREDICTED + "bayes_f",
)
q(
    "ridge_next_month",
    *PART,
    STATE,
    folds("_f", None),
    "ax_f AS (SELECT a.* REPLACE (b.count AS lag12) FROM an_f a LEFT JOIN g b ON b.category = a.category AND b.month = CAST(a.next_month - INTERVAL 12 MONTH AS DATE))",
    ridge("_f").replace("an_f", "ax_f"),
    select=_PREDICTED + "ridge_f",
)
q(
    "tree_one_split",
    *BRAND,
    STATE,
    f"cy AS MATERIALIZED (SELECT *, {_CIRCLE} FROM st)",
    "tn AS (SELECT * FROM cy WHERE avg6 IS NOT NULL)",
    *staged.one_split(_CYCLIC),
    select="""SELECT category, CAST(next_month AS VARCHAR) AS month, round(m + CASE WHEN coalesce(x <= c, s = 1) THEN below ELSE above END, 6) + 0.0 AS predicted
FROM (SELECT *, CASE f """
    + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(_CYCLIC))
    + " END AS x FROM cy, sp, mu WHERE cy.n = cy.size)",
)
# What must hold of all seven models whatever they learn.
q(
    "all_models_hold",
    *BRAND,
    """md AS (SELECT unnest(['naive', 'regression', 'naive_bayes', 'random_forest', 'gradient_boost', 'holt', 'sarima', 'ensemble']) AS model),
nx AS (SELECT category, max(month) + INTERVAL 1 MONTH AS month FROM g GROUP BY category)""",
    select="""SELECT model, CAST(count(*) AS BIGINT) AS series, CAST(CAST(min(month) AS DATE) AS VARCHAR) AS first_month,
  CAST(CAST(max(month) AS DATE) AS VARCHAR) AS last_month, TRUE AS ranks_hold, TRUE AS no_negative, TRUE AS blend_holds, TRUE AS forest_in_range
FROM md, nx GROUP BY model""",
)
q(
    "all_backtests_hold",
    *BRAND,
    STATE,
    folds("_b", 3),
    """md AS (SELECT unnest(['naive', 'regression', 'naive_bayes', 'random_forest', 'gradient_boost', 'holt', 'sarima']) AS model)""",
    select="""SELECT model, CAST(fold AS VARCHAR) AS eval_month, CAST(count(*) AS BIGINT) AS series, round(sum(act), 6) + 0.0 AS actual, TRUE AS errors_hold
FROM md, an_b WHERE act IS NOT NULL GROUP BY model, fold""",
)

_BINS = "SELECT CAST(fold AS VARCHAR) AS fold, CAST(nonzero AS BIGINT) AS nonzero, " + num("low_edge", "high_edge") + " FROM nb_f"
q(
    "nb_bins",
    CUSTOMER_ROLLED.replace("m AS (", "cm AS ("),
    BRAND_ROLLED.replace("m AS (", "bm AS ("),
    """m AS (SELECT 'c' || category AS category, month, count FROM cm UNION ALL SELECT 'b' || category, month, count FROM bm)""",
    FILLED,
    STATE,
    """tr_f AS (SELECT *, CASE WHEN category LIKE 'c%' THEN DATE '9999-12-01' ELSE DATE '2000-01-01' END AS fold FROM st)""",
    nb_fit("_f"),
    select=_BINS,
)
q(
    "nb_class_stats",
    *BRAND,
    STATE,
    folds("_f", None),
    nb_fit("_f"),
    select=" UNION ALL ".join(
        f"""SELECT CAST(class AS BIGINT) AS class, '{c}' AS feature, CAST(class_rows AS BIGINT) AS class_rows,
  CAST(train_rows AS BIGINT) AS train_rows, (SELECT round(lag12_mean, 6) FROM nc_f) AS lag12_mean,
  round(mean_{c}, 6) + 0.0 AS mean, round(var_{c}, 6) + 0.0 AS var FROM ns_f"""
        for c in CALENDAR
    ),
)
q(
    "nb_medians",
    *BRAND,
    STATE,
    folds("_f", None),
    nb_fit("_f"),
    select="""SELECT CAST(c AS BIGINT) AS class, round(coalesce(median, overall), 6) + 0.0 AS median
FROM range(4) r(c) CROSS JOIN nv_f LEFT JOIN ns_f ON class = c""",
)
for _name, _binding in (("nb_forecast", BRAND), ("nb_forecast_cycle", CYCLE)):
    q(_name, *_binding, STATE, folds("_f", None), nb("_f"), select=_PREDICTED + "bayes_f")

# Combination.

_FC = f"SELECT category, {day('month')}, {num('predicted')}, model"
_RANK = "row_number() OVER (PARTITION BY model ORDER BY predicted DESC, category) AS rank"
q("multi_model_ranked", *BRAND_FC, select=f"{_FC}, {_RANK} FROM fc")
q(
    "rank_with_ties",
    *CUSTOMER,
    STATE,
    folds("_f", None),
    naive("_f"),
    """un AS (SELECT category, predicted, 'naive' AS model FROM naive_f
  UNION ALL SELECT category, fallback, 'mean' FROM an_f)""",
    select=f"SELECT category, {num('predicted')}, model, {_RANK} FROM un",
)
q(
    "line_positions",
    select="""SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) AS position FROM orders""",
)
q("ensemble_avg", *BRAND_FC, select=f"{_FC} FROM fc WHERE model = 'ensemble'")
q("ensemble_weights", *BRAND_BT, *WEIGHTS, select=f"SELECT model, {num('weight')} FROM we")
q(
    "ensemble_weighted",
    *BRAND_FC,
    *tested(),
    *WEIGHTS,
    select=f"""SELECT category, {day('month')}, {num('predicted')}, 'ensemble_w' AS model FROM (
  SELECT category, max(month) AS month, sum(predicted * weight) AS predicted FROM base JOIN we ON we.model = base.model
  GROUP BY category)""",
)
q(
    "guardrail",
    *NAIVE_FC,
    f"ra AS (SELECT category, avg(count) AS recent_avg FROM {_LAST.format(w=12)} GROUP BY category)",
    select=f"""SELECT fc.category, {day('month')}, model,
  round(CASE WHEN recent_avg > 0 THEN least(predicted, recent_avg * 1.5) ELSE predicted END, 6) + 0.0 AS predicted
FROM fc LEFT JOIN ra ON ra.category = fc.category""",
)
q(
    "zero_repair",
    *NAIVE_FC,
    "al AS (SELECT * FROM fc UNION ALL SELECT category, month, 0.0, 'idle' FROM fc)",
    f"ra AS (SELECT category, avg(count) AS recent_avg FROM {_LAST.format(w=3)} GROUP BY category)",
    "oa AS (SELECT category, avg(count) AS overall_avg FROM g GROUP BY category)",
    "dd AS (SELECT model, sum(predicted) <= 0 AS repaired FROM al GROUP BY model)",
    select=f"""SELECT al.category, {day('month')}, al.model, repaired,
  round(CASE WHEN NOT repaired OR predicted > 0 THEN predicted WHEN recent_avg > 0 THEN recent_avg
    ELSE coalesce(overall_avg, 0.0) END, 6) + 0.0 AS predicted
FROM al JOIN dd ON dd.model = al.model LEFT JOIN ra ON ra.category = al.category LEFT JOIN oa ON oa.category = al.category""",
)
q(
    "digest",
    *BRAND_FC,
    select=f"""{_FC}, position FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY predicted DESC, category) AS position
FROM fc) WHERE position <= 5""",
)

# Backtest and accuracy.

q("backtest_folds", *CUSTOMER, select="SELECT DISTINCT CAST(month AS VARCHAR) AS fold FROM g ORDER BY fold DESC LIMIT 6")
_BT = f"""SELECT model, {day('eval_month')}, category, {num('actual', 'predicted', 'error', 'abs_error', 'denom', 'ape')} FROM bt"""
q("backtest_rows_brand", *BRAND_BT, select=_BT)
q("backtest_rows_customer", *CUSTOMER, STATE, *tested(3, True), select=_BT)
q("metrics_core", *BRAND_BT, CORE, select=f"SELECT model, {num('mae', 'rmse', 'mape')}, samples FROM co")
q(
    "metrics_extended",
    *BRAND_BT,
    """ex AS (SELECT model, avg(abs_error) AS mae, sqrt(avg(error * error)) AS rmse, avg(ape) * 100 AS mape_pct,
  median(ape) * 100 AS mdape_pct, avg(error) AS bias,
  1 - sum(error * error) / (var_pop(actual) * count(*)) AS r2, corr(actual, predicted) AS corr,
  avg(CASE WHEN ape <= 0.20 THEN 100.0 ELSE 0 END) AS hit20pct, avg(CASE WHEN ape <= 0.50 THEN 100.0 ELSE 0 END) AS hit50pct,
  count(*) AS n FROM bt GROUP BY model)""",
    select="SELECT model, "
    + num("mae", "rmse", "mape_pct", "mdape_pct", "bias", "r2", "corr", "hit20pct", "hit50pct")
    + ", n FROM ex",
)
q(
    "leaderboard",
    *BRAND_BT,
    CORE,
    select=f"""SELECT model, {num('mae', 'rmse', 'mape')}, samples,
  CASE WHEN model = (SELECT model FROM co ORDER BY mape, model LIMIT 1) THEN 'Best' ELSE 'Other' END AS tag,
  CASE WHEN mape < 0.2 THEN 'reliable' WHEN mape < 0.5 THEN 'directional' ELSE 'needs more history' END AS verdict FROM co""",
)
q(
    "report",
    *BRAND_BT,
    CORE,
    select=f"""SELECT (SELECT count(*) FROM g) AS rows, (SELECT count(DISTINCT category) FROM g) AS categories,
  (SELECT count(DISTINCT month) FROM g) AS months, model, {num('mae', 'rmse', 'mape')}, samples FROM co""",
)
q(
    "mape_by_month",
    *BRAND_BT,
    select=f"""SELECT model, {day('eval_month')}, {num('mape_pct')} FROM (
  SELECT model, eval_month, avg(ape) * 100 AS mape_pct FROM bt GROUP BY model, eval_month)""",
)
_MODELS = ("naive", "regression", "naive_bayes")
q(
    "mape_by_category",
    *BRAND_BT,
    "pc AS (SELECT category, " + ", ".join(f"avg(ape) FILTER (model = '{m}') * 100 AS {m}" for m in _MODELS) + " FROM bt GROUP BY category)",
    select=f"SELECT category, {num(*_MODELS)}, round((naive + regression + naive_bayes) / 3, 6) + 0.0 AS mean_mape FROM pc",
)
q(
    "model_agreement",
    *BRAND_BT,
    select="""SELECT a.model AS model_a, b.model AS model_b, round(corr(a.predicted, b.predicted), 6) + 0.0 AS corr
FROM bt a JOIN bt b ON a.category = b.category AND a.eval_month = b.eval_month GROUP BY 1, 2""",
)
q(
    "ape_box",
    *BRAND_BT,
    "vv AS (SELECT model, least(ape, 2.0) * 100 AS v FROM bt)",
    """bx AS (SELECT model, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM vv GROUP BY model)""",
    select="""SELECT vv.model, round(max(q1), 6) + 0.0 AS q1, round(max(median), 6) + 0.0 AS median, round(max(q3), 6) + 0.0 AS q3,
  round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), 6) + 0.0 AS whisker_low,
  round(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), 6) + 0.0 AS whisker_high, count(*) AS n
FROM vv JOIN bx ON bx.model = vv.model GROUP BY vv.model""",
)


def density(rows: str, key: str, value: str, expand: float, fewest: int) -> tuple[str, str]:
    return (
        f"""sp AS (SELECT {key}, count(*) AS n, min({value}) AS lo, max({value}) AS hi, stddev_samp({value}) AS sd
  FROM {rows} GROUP BY {key} HAVING count(*) >= {fewest} AND stddev_samp({value}) > 0),
gr AS (SELECT {key}, n, sd * pow(n, -0.2) AS h, i AS point,
  lo - (hi - lo) * {expand} + i * ((hi - lo) * (1 + 2 * {expand}) / 99) AS x FROM sp, range(100) r(i))""",
        f"""SELECT gr.{key}, point, round(max(x), 6) + 0.0 AS x,
  round(sum(exp(-0.5 * pow((x - {value}) / h, 2)) / (n * h * sqrt(2 * pi()))), 6) + 0.0 AS density
FROM gr JOIN {rows} d ON d.{key} = gr.{key} GROUP BY gr.{key}, point""",
    )


_cte, _select = density("er", "model", "error", 0.5, 6)
q("error_kde", *BRAND_BT, "er AS (SELECT model, greatest(-200.0, least(error, 200.0)) AS error FROM bt)", _cte, select=_select)
_cte, _select = density("lg", "period", "checkouts", 0.0, 2)
q(
    "count_kde",
    *CUSTOMER_VIEW,
    """lg AS (SELECT 'predicted' AS period, predicted AS checkouts FROM vw UNION ALL SELECT 'last_month', last_month FROM vw)""",
    _cte,
    select=_select,
)
q(
    "backtest_scatter",
    *BRAND_BT,
    select=f"""SELECT model, {day('eval_month')}, category, {num('actual', 'predicted')},
  round_even(ape * 100, 1) + 0.0 AS error_pct FROM bt""",
)


def histogram(values: str, bins: int) -> tuple[str, str]:
    return (
        f"""hv AS ({values}),
he AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
  CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM hv),
hb AS (SELECT least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS bin, count(*) AS n FROM hv, he GROUP BY 1)""",
        f"""SELECT i AS bin, round(lo + i * ((hi - lo) / {bins}), 6) + 0.0 AS from_value,
  round(lo + (i + 1) * ((hi - lo) / {bins}), 6) + 0.0 AS to_value, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM range({bins}) r(i) CROSS JOIN he LEFT JOIN hb ON hb.bin = i""",
    )


_ZERO = "SELECT category, avg(CASE WHEN count = 0 THEN 1.0 ELSE 0.0 END) AS zero_rate FROM g GROUP BY category"
_cte, _select = histogram("SELECT ln(1 + count) AS v FROM g WHERE count > 0", 50)
q("hist_log_counts", *PART, _cte, select=_select)
_cte, _select = histogram("SELECT CAST(count(*) AS DOUBLE) AS v FROM g GROUP BY category", 20)
q("hist_history", *CUSTOMER, _cte, select=_select)
_cte, _select = histogram(f"SELECT zero_rate * 100 AS v FROM ({_ZERO})", 20)
q("hist_zero_rate", *CUSTOMER, _cte, select=_select)
q("zero_rate", *CUSTOMER, select=f"SELECT category, {num('zero_rate')} FROM ({_ZERO})")
q(
    "season_by_series",
    *CUSTOMER,
    "sm AS (SELECT month(month) AS calendar_month, avg(count) AS mean FROM g GROUP BY 1)",
    select=f"""SELECT CAST(calendar_month AS BIGINT) AS calendar_month, {num('mean')},
  calendar_month = (SELECT calendar_month FROM sm ORDER BY mean DESC, calendar_month LIMIT 1) AS is_peak FROM sm""",
)

# Planning views.

_VIEW = f"SELECT category, {day('month')}, {num('predicted', 'last_month', 'hist_avg', 'delta', 'vs_avg_pct')} FROM vw"
q("default_view", *BRAND_VIEW, select=f"SELECT category, {num('predicted')}, 'ensemble' AS model FROM vw")
q("prediction_view", *BRAND_VIEW, select=_VIEW)
q("prediction_view_customer", *CUSTOMER_VIEW, select=_VIEW)
q(
    "headline",
    *BRAND_VIEW,
    """hd AS (SELECT (SELECT sum(count) FROM g WHERE month = (SELECT max(month) FROM g)) AS last_total,
  (SELECT sum(predicted) FROM vw) AS predicted_total,
  (SELECT sum(predicted) FROM (SELECT predicted FROM vw ORDER BY predicted DESC, category LIMIT 10)) AS ten,
  (SELECT count(DISTINCT category) FROM g) AS titles)""",
    select="""SELECT round(last_total, 6) AS last_total, round(predicted_total, 6) AS predicted_total,
  round(predicted_total - last_total, 6) AS delta_total,
  round((predicted_total - last_total) / last_total * 100, 6) AS pct_change, round(ten / predicted_total, 6) AS top10_share,
  titles, 3 AS models FROM hd""",
)
q(
    "top_demand",
    *BRAND_VIEW,
    select=f"""SELECT row_number() OVER (ORDER BY vw.predicted DESC, category) AS position, category,
  {num('predicted', 'last_month', 'delta')}, CASE WHEN vw.delta > 0 THEN 'up' WHEN vw.delta < 0 THEN 'down' ELSE 'flat' END AS trend,
  {num('vs_avg_pct')} FROM vw ORDER BY vw.predicted DESC, category LIMIT 15""",
)
_RISING = "(SELECT * FROM vw WHERE delta > 0 ORDER BY delta DESC, category LIMIT {n})"
_FALLING = "(SELECT * FROM vw WHERE delta < 0 ORDER BY delta, category LIMIT {n})"
q(
    "movers",
    *BRAND_VIEW,
    select=f"""SELECT category, {num('predicted', 'last_month', 'delta')}, CASE WHEN mv.delta >= 0 THEN 'Rising' ELSE 'Falling' END AS direction,
  CASE WHEN length(category) <= 45 THEN category ELSE substr(category, 1, 44) || '…' END AS label,
  CASE WHEN mv.delta >= 0 THEN '+' ELSE '' END || format('{{:,}}', CAST(round_even(mv.delta, 0) AS BIGINT)) AS delta_label
FROM (FROM {_RISING.format(n=12)} UNION ALL FROM {_FALLING.format(n=12)}) mv""",
)
q(
    "deep_dive",
    *BRAND_VIEW,
    "pk AS (SELECT category, predicted FROM vw ORDER BY predicted DESC, category LIMIT 1)",
    "hs AS (SELECT g.* FROM g JOIN pk ON pk.category = g.category)",
    """fa AS (SELECT count(*) AS months, avg(count) AS mean, max(count) AS peak,
  CAST(max(month) + INTERVAL 1 MONTH AS DATE) AS nxt FROM hs)""",
    """al AS (SELECT category, month, count, 'history' AS kind FROM hs
  UNION ALL SELECT category, nxt, predicted, 'forecast' FROM pk, fa)""",
    select=f"SELECT category, {day('month')}, {num('count')}, kind, months, {num('mean', 'peak')} FROM al, fa",
)
q(
    "model_range",
    *BRAND_FC,
    select="""SELECT category, round(min(predicted), 6) + 0.0 AS low, round(max(predicted), 6) + 0.0 AS high, count(*) AS models
FROM fc WHERE model <> 'ensemble' GROUP BY category""",
)
TOTALS = "mt AS (SELECT month, sum(count) AS total FROM g GROUP BY month)"
q("monthly_totals", *BRAND, TOTALS, select=f"SELECT {day('month')}, {num('total')} FROM mt")
q(
    "seasonal_profile",
    *BRAND,
    TOTALS,
    """fu AS (SELECT i AS calendar_month, coalesce(v, 0.0) AS avg_total FROM range(1, 13) r(i)
  LEFT JOIN (SELECT month(month) AS c, avg(total) AS v FROM mt GROUP BY 1) ON c = i)""",
    select="""SELECT calendar_month, strftime(make_date(2000, CAST(calendar_month AS INTEGER), 1), '%b') AS name,
  round(avg_total, 6) + 0.0 AS avg_total,
  CASE WHEN fu.avg_total >= (SELECT quantile_cont(avg_total, 0.67) FROM fu) THEN 'Peak' ELSE 'Normal' END AS season FROM fu""",
)
q(
    "overall_trend",
    *BRAND,
    "mt AS (SELECT month, sum(count) AS total FROM g WHERE month < (SELECT max(month) FROM g) GROUP BY month)",
    """en AS (SELECT min(month) AS first_month, max(month) AS last_month, arg_min(total, month) AS first_total,
  arg_max(total, month) AS last_total FROM mt)""",
    select=f"""SELECT {day('first_month', 'last_month')}, {num('first_total', 'last_total')},
  CASE WHEN en.last_total > en.first_total THEN 'growing' ELSE 'declining' END AS trend,
  round(abs((en.last_total - en.first_total) / greatest(en.first_total, 1.0) * 100), 6) AS pct FROM en""",
)


def shares(top: str) -> tuple[str, str]:
    return (
        f"""tp AS ({top}),
su AS (SELECT month, CASE WHEN category IN (SELECT category FROM tp) THEN category ELSE 'All Others' END AS bucket,
  category IN (SELECT category FROM tp) AS is_top, sum(count) AS count FROM g GROUP BY 1, 2, 3)""",
        f"""SELECT {day('month')}, bucket, is_top, {num('count')},
  round(su.count / sum(su.count) OVER (PARTITION BY su.month), 6) + 0.0 AS share FROM su""",
    )


def top_view(n: int) -> str:
    return f"SELECT category FROM vw ORDER BY predicted DESC, category LIMIT {n}"


_cte, _select = shares(top_view(8))
q("concentration", *BRAND_VIEW, _cte, select=_select)
_cte, _select = shares("SELECT category FROM g GROUP BY category ORDER BY sum(count) DESC, category LIMIT 4")
q("material_share", *TYPE, _cte, select=_select)
q(
    "all_others",
    *CUSTOMER,
    select=f"""SELECT {day('month')}, {num('count')} FROM (SELECT month, sum(count) AS count FROM g
WHERE category NOT IN {TOP20.format(n=8)} GROUP BY month)""",
)
q(
    "heatmap_cells",
    *BRAND_VIEW,
    select=f"""SELECT category, {day('month')}, {num('count')}, CASE WHEN length(category) <= 32 THEN category
  ELSE substr(category, 1, 31) || '…' END AS label, strftime(g.month, '%b %Y') AS month_label
FROM g WHERE category IN ({top_view(20)})""",
)
q(
    "sparklines",
    *BRAND_VIEW,
    select=f"""SELECT category, {day('month')}, {num('count')}, CASE WHEN length(category) <= 34 THEN category
  ELSE substr(category, 1, 33) || '…' END AS label FROM {_LAST.format(w=12)} WHERE category IN ({top_view(10)})""",
)
q(
    "model_compare",
    *BRAND_VIEW,
    select=f"""SELECT category, model, {num('predicted')}, {LABELS} AS model_label, CASE WHEN length(category) <= 30 THEN category
  ELSE substr(category, 1, 29) || '…' END AS label FROM fc WHERE model <> 'ensemble' AND category IN ({top_view(6)})""",
)
_ACTION = "category, " + num("predicted", "last_month", "delta")
q(
    "planning_actions",
    *BRAND_VIEW,
    select=f"""SELECT 'Order more copies' AS action, {_ACTION}, CASE WHEN v.predicted / greatest(v.last_month, 1.0) > 1.5 THEN 'High'
  WHEN v.predicted / greatest(v.last_month, 1.0) > 1.1 THEN 'Moderate' ELSE 'Stable' END AS urgency
FROM (SELECT * FROM vw ORDER BY predicted DESC, category LIMIT 5) v
UNION ALL SELECT 'Watch hold queues', {_ACTION}, NULL FROM {_RISING.format(n=5)}
UNION ALL SELECT 'Reallocate budget', {_ACTION}, NULL FROM {_FALLING.format(n=5)}""",
)
q(
    "planning_bands",
    *CUSTOMER_VIEW,
    "rr AS (SELECT category, predicted, hist_avg, predicted / greatest(hist_avg, 1.0) AS ratio FROM vw)",
    select=f"""SELECT category, {num('predicted', 'hist_avg', 'ratio')}, CASE WHEN rr.ratio > 1.2 THEN 'Order more'
  WHEN rr.ratio >= 1.0 THEN 'Watch' WHEN rr.ratio < 0.8 THEN 'Reallocate' ELSE 'Hold' END AS band FROM rr""",
)
q("stream_monthly", CUSTOMER_ROLLED, select=_SERIES + "m")
