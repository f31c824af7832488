"""The SQL counterparts of ``queries``, for an independent engine on the same tables."""

# Written out here and not imported, so that a wrong constant of the code under test shows.
METRICS = ["mae", "rmse", "mape", "r2"]
BASELINES = ["Last Value", "Linear Trend", "Holt-Winters"]
HOLT_GRID = [(0.2, 0.05), (0.2, 0.1), (0.2, 0.2), (0.5, 0.05), (0.5, 0.1), (0.5, 0.2),
             (0.8, 0.05), (0.8, 0.1), (0.8, 0.2)]
LIST_NAMES = ["c1", "c2", "c3", "c4", "c5", "c6"]
URL_TEMPLATE = "https://data.example.com/%s/daily.htm"
MIN_ROWS = 20

_LINES = """{name} AS (
  SELECT series, date, value FROM (
    SELECT CAST({key} AS VARCHAR) AS series, CAST(l_shipdate AS DATE) AS date,
           {value} AS value,
           row_number() OVER (PARTITION BY {key}, CAST(l_shipdate AS DATE)
             ORDER BY l_orderkey DESC, l_linenumber DESC, {value} DESC) AS k
    FROM lineitem) WHERE k = 1)"""
_ORDERS = """{name} AS (
  SELECT series, date, value FROM (
    SELECT CAST({key} AS VARCHAR) AS series, CAST(o_orderdate AS DATE) AS date,
           o_totalprice AS value,
           row_number() OVER (PARTITION BY {key}, CAST(o_orderdate AS DATE)
             ORDER BY o_orderkey DESC) AS k
    FROM orders) WHERE k = 1)"""
_EVENTS = """{name} AS (
  SELECT series, date, value FROM (
    SELECT CAST(user_id AS VARCHAR) AS series, CAST(ts AS DATE) AS date, value,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
             ORDER BY event_id DESC) AS k
    FROM events) WHERE k = 1)"""

_SOURCES = {
    "bars": (_LINES, "l_returnflag"), "supplier_bars": (_LINES, "l_suppkey"),
    "quantity_days": (_LINES, "l_returnflag", "l_quantity"),
    "order_days": (_ORDERS, "o_orderpriority"), "customer_orders": (_ORDERS, "o_custkey"),
    "event_days": (_EVENTS, "user_id"), "order_lines": (_LINES, "l_orderkey"),
}


def source(name, alias="s"):
    template, key, *value = _SOURCES[name]
    return template.format(name=alias, key=key, value=(value or ["l_extendedprice"])[0])


# s -> numbered and split
SPLIT = """sp AS (
  SELECT *, CASE WHEN rn <= n * CAST(0.8 AS DOUBLE) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT series, date, value,
          CAST(row_number() OVER (PARTITION BY series ORDER BY date) AS INTEGER) AS rn,
          CAST(count(*) OVER (PARTITION BY series) AS INTEGER) AS n
        FROM s))"""

_LAST = """last_value_p AS (
  SELECT t.series, t.date, t.value AS actual, l.value AS predicted,
         'Last Value' AS model, 'multi_step' AS horizon_kind
  FROM sp t JOIN (
    SELECT series, arg_max(value, rn) AS value FROM sp WHERE split = 'train'
    GROUP BY series) l USING (series)
  WHERE t.split = 'test')"""
_TREND = """linear_trend_p AS (
  SELECT t.series, t.date, t.value AS actual,
         f.my + coalesce(f.slope, 0) * (t.rn - 1 - f.mx) AS predicted,
         'Linear Trend' AS model, 'multi_step' AS horizon_kind
  FROM sp t JOIN (
    SELECT series, CASE WHEN count(*) > 1 THEN regr_slope(value, rn - 1) END AS slope,
           avg(value) AS my, avg(rn - 1) AS mx
    FROM sp WHERE split = 'train' GROUP BY series) f USING (series)
  WHERE t.split = 'test')"""


def holt(grid):
    pairs = ", ".join(f"(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in grid)
    return f"""grid(alpha, beta) AS (VALUES {pairs}),
walk AS (
  SELECT a.series, g.alpha, g.beta, 1 AS rn, a.value AS level,
         coalesce(b.value - a.value, 0) AS trend, CAST(0 AS DOUBLE) AS sse
  FROM (SELECT * FROM sp WHERE rn = 1 AND split = 'train') a
       LEFT JOIN sp b ON a.series = b.series AND b.rn = 2 AND b.split = 'train'
       CROSS JOIN grid g
  UNION ALL
  SELECT series, alpha, beta, rn, new_level,
         beta * (new_level - level) + (1 - beta) * trend, sse
  FROM (SELECT w.series, w.alpha, w.beta, t.rn, w.level, w.trend,
               w.alpha * t.value + (1 - w.alpha) * (w.level + w.trend) AS new_level,
               w.sse + (t.value - w.level - w.trend) * (t.value - w.level - w.trend) AS sse
        FROM walk w JOIN sp t ON t.series = w.series AND t.rn = w.rn + 1
             AND t.split = 'train')),
ends AS (
  SELECT w.* FROM walk w JOIN (
    SELECT series, max(rn) AS rn FROM sp WHERE split = 'train' GROUP BY series) l
  ON w.series = l.series AND w.rn = l.rn)"""


_HOLT = """holt_p AS (
  SELECT t.series, t.date, t.value AS actual,
         e.level + (t.rn - l.rn) * e.trend AS predicted,
         'Holt-Winters' AS model, 'multi_step' AS horizon_kind
  FROM sp t
  JOIN (SELECT series, level, trend FROM ends QUALIFY row_number() OVER (
          PARTITION BY series ORDER BY round(ln(1 + sse), 8), alpha, beta) = 1) e USING (series)
  JOIN (SELECT series, max(rn) AS rn FROM sp WHERE split = 'train' GROUP BY series) l
       USING (series)
  WHERE t.split = 'test')"""


def predictions(name):
    return ",\n".join([source(name), SPLIT, _LAST, _TREND, holt(HOLT_GRID), _HOLT,
                       """p AS (SELECT * FROM last_value_p UNION ALL
  SELECT * FROM linear_trend_p UNION ALL SELECT * FROM holt_p)"""])


def metrics(name, mae=4, rmse=4, mape=4, r2=4):
    return predictions(name) + f""",
m AS (
  SELECT series, model, round(avg(abs(actual - predicted)), {mae}) AS mae,
         round(sqrt(avg((actual - predicted) * (actual - predicted))), {rmse}) AS rmse,
         round(avg(CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END) * 100,
               {mape}) AS mape,
         round(CASE WHEN sum((actual - mean) * (actual - mean)) = 0 THEN 0.0
               ELSE 1 - sum((actual - predicted) * (actual - predicted))
                        / sum((actual - mean) * (actual - mean)) END, {r2}) AS r2
  FROM (SELECT *, avg(actual) OVER (PARTITION BY series, model) AS mean FROM p)
  GROUP BY series, model)"""


LEADERBOARD = """lb AS (
  SELECT model, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse,
         round(avg(mape), 4) AS mape, round(avg(r2), 4) AS r2
  FROM m GROUP BY model)"""


def _half_up(column, digits):
    """Rounded as the decimal it shows, as the four-decimal metrics are."""
    return (f"CAST(round(CAST({column} AS DECIMAL(24, 4)), {digits}) AS DOUBLE) "
            f"AS {column}")


BEST = f"""best AS (
  SELECT series, model AS best_model, {_half_up('rmse', 2)}, {_half_up('r2', 4)},
         {_half_up('mae', 2)}, {_half_up('mape', 2)}
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY rmse NULLS LAST, model)
               AS k FROM m) WHERE k = 1)"""

# sp -> correlations of the differenced train part
CORRELATIONS = """d AS (
  SELECT series, rn, diff, diff - avg(diff) OVER (PARTITION BY series) AS z
  FROM (SELECT series, rn,
          value - lag(value) OVER (PARTITION BY series ORDER BY rn) AS diff
        FROM sp WHERE split = 'train') WHERE rn > 1),
sizes AS (
  SELECT series, count(*) AS n, sum(z * z) AS c0,
         least(40, count(*) - 1) AS lags
  FROM d GROUP BY series),
pairs AS (
  SELECT series, lag, n, c0 FROM (
    SELECT series, n, c0, unnest(generate_series(0, lags)) AS lag FROM sizes)),
r AS (
  SELECT q.series, CAST(q.lag AS INTEGER) AS lag, any_value(q.n) AS n,
         coalesce(sum(a.z * b.z), 0) / nullif(any_value(q.c0), 0) AS value
  FROM pairs q LEFT JOIN d a ON a.series = q.series
       LEFT JOIN d b ON b.series = q.series AND b.rn = a.rn - q.lag
  GROUP BY q.series, q.lag),
acf AS (
  SELECT series, lag, value, value - half AS lo, value + half AS hi FROM (
    SELECT series, lag, value, 1.959964 * sqrt(CASE WHEN lag = 0 THEN 0 ELSE
      (1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN value * value END) OVER (
         PARTITION BY series ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       0)) / n END) AS half FROM r))"""
PARTIALS = """rl AS (SELECT series, any_value(n) AS n, list(value ORDER BY lag) AS r
  FROM r GROUP BY series),
dl AS (
  SELECT series, n, r, 1 AS k, [r[2]] AS phi, r[2] AS last FROM rl WHERE len(r) > 1
  UNION ALL
  SELECT series, n, r, k + 1,
         list_concat([phi[j] - nxt * phi[k + 1 - j] for j in range(1, k + 1)], [nxt]), nxt
  FROM (SELECT *, (r[k + 2] - list_sum([phi[j] * r[k + 2 - j] for j in range(1, k + 1)]))
               / (1 - list_sum([phi[j] * r[j + 1] for j in range(1, k + 1)])) AS nxt
        FROM dl WHERE len(r) >= k + 2)),
pacf AS (
  SELECT series, CAST(0 AS INTEGER) AS lag, CAST(1 AS DOUBLE) AS value,
         CAST(1 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi FROM rl WHERE r[1] IS NOT NULL
  UNION ALL
  SELECT series, CAST(k AS INTEGER), last, last - 1.959964 / sqrt(n),
         last + 1.959964 / sqrt(n) FROM dl)"""

# s -> business days
BUSINESS_DAYS = """days AS (
  SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT series, CAST(min(date) AS TIMESTAMP) AS lo, CAST(max(date) AS TIMESTAMP) AS hi
        FROM s GROUP BY series)),
grid_days AS (
  SELECT g.series, g.date, s.value FROM days g LEFT JOIN s USING (series, date)
  WHERE dayofweek(g.date) BETWEEN 1 AND 5),
filled AS (
  SELECT series, date, value FROM (
    SELECT series, date, last_value(value IGNORE NULLS) OVER (
      PARTITION BY series ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
    FROM grid_days) WHERE value IS NOT NULL)"""
_GRID_TRAIN = """gt AS (
  SELECT series, date, value, rn, count(*) OVER (PARTITION BY series) AS n FROM (
    SELECT series, date, value,
           row_number() OVER (PARTITION BY series ORDER BY date) AS rn,
           count(*) OVER (PARTITION BY series) AS total FROM filled)
  WHERE rn <= total * CAST(0.8 AS DOUBLE))"""
DECOMPOSE = _GRID_TRAIN + """,
tr AS (
  SELECT series, date, value, rn, period,
         CASE WHEN rn <= period // 2 OR rn > n - period // 2 THEN NULL
              WHEN period = 252 THEN year_mean ELSE week_mean END AS trend,
         (rn - 1) % period AS phase
  FROM (SELECT *, CASE WHEN n >= 504 THEN 252 ELSE 5 END AS period,
          (2 * sum(value) OVER (PARTITION BY series ORDER BY rn
                 ROWS BETWEEN 125 PRECEDING AND 125 FOLLOWING)
           + lag(value, 126) OVER (PARTITION BY series ORDER BY rn)
           + lead(value, 126) OVER (PARTITION BY series ORDER BY rn)) / 504 AS year_mean,
          avg(value) OVER (PARTITION BY series ORDER BY rn
                 ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS week_mean
        FROM gt WHERE n >= 10)),
ph AS (SELECT series, phase, avg(value - trend) AS m FROM tr GROUP BY series, phase),
ce AS (SELECT series, avg(m) AS c FROM ph GROUP BY series),
dc AS (
  SELECT tr.series, tr.date, CAST(tr.period AS INTEGER) AS period, tr.value AS observed,
         tr.trend, ph.m - ce.c AS seasonal, tr.value - tr.trend - (ph.m - ce.c) AS resid
  FROM tr JOIN ph USING (series, phase) JOIN ce ON ce.series = tr.series)"""

_W = "(PARTITION BY series ORDER BY date)"


def _frame(k):
    return (f"(PARTITION BY series ORDER BY date "
            f"ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)")


_LAGS = ", ".join(f"lag(value, {k}) OVER {_W} AS lag{k}" for k in (1, 2, 3, 5, 10))
_TRAILING = ", ".join(
    [f"round(avg(value) OVER {_frame(k)}, 6) AS rmean{k}" for k in (5, 10, 20)]
    + [f"round(stddev_samp(value) OVER {_frame(k)}, 6) AS rstd{k}" for k in (5, 10, 20)])

FEATURE_ROWS = f"""f AS (
  SELECT * FROM (
    SELECT *, {_LAGS}, {_TRAILING.replace("round(", "(").replace(", 6)", ")")},
           dayofweek(date) + 1 AS dow, month(date) AS month FROM sp)
  WHERE lag10 IS NOT NULL AND rstd5 IS NOT NULL)"""
_NAMES = ["lag1", "lag2", "lag3", "lag5", "lag10", "rmean5", "rmean10", "rmean20", "rstd5",
          "rstd10", "rstd20", "dow", "month"]


def ridge(penalty):
    """Normal equations of the standardised features, solved one pivot after another."""
    size = range(len(_NAMES))
    label = len(_NAMES)
    names = [*_NAMES, "value"]
    pairs = ", ".join(f"covar_pop({names[min(i, j)]}, {names[max(i, j)]}) AS c{i}_{j}"
                      for i in range(label + 1) for j in range(label + 1))
    means = ", ".join(f"avg({n}) AS m{i}" for i, n in enumerate(names))
    first = ", ".join(
        f"c{i}_{j} / sqrt(c{i}_{i} * c{j}_{j})"
        + (f" + {penalty} / sqrt(c{label}_{label})" if i == j else "") + f" AS a{i}_{j}"
        for i in size for j in range(label + 1))
    steps = [f"mo AS MATERIALIZED (SELECT {means}, {pairs} FROM f WHERE split = 'train')",
             f"e0 AS MATERIALIZED (SELECT {first} FROM mo)"]
    for k in size:
        cells = ", ".join(
            (f"a{k}_{j} / a{k}_{k}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k}")
            + f" AS a{i}_{j}" for i in size for j in range(k + 1, label + 1))
        steps.append(f"e{k + 1} AS MATERIALIZED (SELECT {cells} FROM e{k})")
    terms = " + ".join(f"a{i}_{label} * sqrt(c{label}_{label} / c{i}_{i}) * ({n} - m{i})"
                       for i, n in enumerate(_NAMES))
    steps.append(f"""lr_p AS (
  SELECT series, date, value AS actual, m{label} + {terms} AS predicted,
         'Linear Regression' AS model, 'one_step' AS horizon_kind
  FROM f, mo, e{label} WHERE split = 'test')""")
    return ",\n".join(steps)


ADF = """x AS (
  SELECT series, 'level' AS variant, rn AS i, value AS v FROM sp WHERE split = 'train'
  UNION ALL
  SELECT series, 'difference', rn - 1, diff FROM (
    SELECT series, rn, value - lag(value) OVER (PARTITION BY series ORDER BY rn) AS diff
    FROM sp WHERE split = 'train') WHERE rn > 1),
y AS (SELECT series, variant, i, v - lag(v) OVER w AS d, lag(v) OVER w AS l
      FROM x WINDOW w AS (PARTITION BY series, variant ORDER BY i)),
b AS (SELECT *, lag(d, 1) OVER w AS d1, lag(d, 2) OVER w AS d2, lag(d, 3) OVER w AS d3
      FROM y WINDOW w AS (PARTITION BY series, variant ORDER BY i))"""


def adf_at(lags):
    """t-ratio of l in the regression of d on 1, l and the lagged steps, one pivot each."""
    names = [f"d{k}" for k in range(1, lags + 1)] + ["l", "d"]
    size = range(len(names))
    cells = ", ".join(f"covar_pop({names[i]}, {names[j]}) AS a{i}_{j}" for i in size for j in size)
    steps = [f"k{lags}_0 AS (SELECT series, variant, count(*) AS n, {cells} FROM b "
             f"WHERE d{lags or ''} IS NOT NULL GROUP BY series, variant)"]
    for k in range(lags):
        cells = ", ".join(f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}"
                          for i in range(k + 1, len(names)) for j in range(k + 1, len(names)))
        steps.append(f"k{lags}_{k + 1} AS (SELECT series, variant, n, {cells} FROM k{lags}_{k})")
    y, t = len(names) - 2, len(names) - 1
    ratio = (f"a{y}_{t} / a{y}_{y} / sqrt((a{t}_{t} - a{y}_{t} * a{y}_{t} / a{y}_{y})"
             f" / (n - {lags + 2}) / a{y}_{y})")
    steps.append(f"t{lags} AS (SELECT series, variant, {lags} AS lags, {ratio} AS stat "
                 f"FROM k{lags}_{lags} WHERE n > {lags + 2})")
    return ",\n".join(steps)


# the raw text the readers see, derived as the Spark side derives it
TEXT = source("supplier_bars") + """,
t AS (
  SELECT series AS "Ticker", date AS d, strftime(date, '%d/%m/%Y') AS "Date",
         CASE WHEN day(date) = 13 THEN 'N/A' ELSE format('{:,.2f}', value) END
           AS "Close_price",
         CASE WHEN month(date) = 2 THEN strftime(date, '%-d-%-m-%Y')
              ELSE strftime(date, '%-d/%-m/%Y') END AS "Loose_date", value FROM s)"""

# the last line of each supplier's day
RECORDS = """t AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS supplier, CAST(l_shipdate AS DATE) AS d, * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
    ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_partkey DESC,
             l_quantity DESC, l_discount DESC, l_tax DESC) = 1)"""
SUMS = """count(*) FILTER (day(d) <> 13) AS n_values, count(*) AS n_rows, min(d) AS first_day,
        max(d) AS last_day, CAST(sum(l_linenumber) AS BIGINT) AS lines,
        CAST(sum(l_partkey) AS BIGINT) AS parts, CAST(sum(l_orderkey) AS BIGINT) AS orders,
        CAST(round(sum(l_quantity), 0) AS BIGINT) AS quantity,
        round(sum(l_discount), 2) AS discount, round(sum(l_tax), 2) AS tax"""

# the series of the quick analysis
QUICK = source("event_days", "every") + """,
s AS (SELECT series, date, value FROM (
  SELECT *, count(*) OVER (PARTITION BY series) AS k FROM every) WHERE k >= 20)"""

UNITS = source("supplier_bars") + """,
u AS (SELECT series, CAST(year(min(date)) AS INTEGER) AS year_from,
             CAST(year(max(date)) AS INTEGER) AS year_to FROM s GROUP BY series)"""

LENGTHS = source("customer_orders") + """,
len AS (SELECT series, count(*) AS total FROM s GROUP BY series),
st AS (SELECT series, CASE WHEN total >= 10 THEN 'ok' ELSE 'failed' END AS status,
              CASE WHEN total < 10 THEN 'only ' || total || ' rows' END AS reason FROM len)"""


def _clean_html(expr):
    return (f"replace(replace(replace(replace(replace(replace("
            f"regexp_replace({expr}, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), "
            f"'&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')")


def _marked(expr):
    trimmed = f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"
    return (f"CASE WHEN strpos({trimmed}, '#####') > 0 THEN "
            f"substr({trimmed}, 1, strpos({trimmed}, '#####') - 1) || 'N/A' || "
            f"substr({trimmed}, strpos({trimmed}, '#####') + 5) ELSE {trimmed} END")


def _with(*parts, recursive=False):
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def _from_metrics(name, *parts):
    return _with(metrics(name), *parts, recursive=True)



def _summary(name):
    return (f"SELECT '{name}' AS source, count(*) AS n_rows, "
            f"count(DISTINCT series) AS n_series FROM {name}")


def _matrix(metric):
    cells = ", ".join(f"max(CASE WHEN model = '{m}' THEN {metric} END) AS \"{m}\""
                      for m in BASELINES)
    return _from_metrics("supplier_bars", f"SELECT series, {cells} FROM m GROUP BY series")


def _flags(report, over=""):
    marks = ", ".join(f"{c} = {f}({c}) OVER ({over}) AS best_{c}" for c, f in
                      [("mae", "min"), ("rmse", "min"), ("mape", "min"), ("r2", "max")])
    return f"SELECT *, {marks} FROM {report}"


_GRID_MODELS = ", ".join(f"({i}, '{m}')" for i, m in enumerate([*BASELINES, "ARIMA"]))
_OVERLAY_MODELS = ", ".join(
    f"max(CASE WHEN model = '{m}' THEN predicted END) AS \"{m}\"" for m in BASELINES)
_OVERLAY_ROUNDED = ", ".join(f"round(\"{m}\", 4) AS \"{m}\"" for m in BASELINES)
_CELLS = ", ".join(f"{_marked(_clean_html(f'cells[{i + 1}]'))} AS {n}"
                   for i, n in enumerate(LIST_NAMES))

ORACLES = {
    "canonical_series": _with(source("supplier_bars"), "SELECT * FROM s"),
    "canonical_orders": _with(source("customer_orders"), "SELECT * FROM s"),
    "canonical_events": _with(source("event_days"), "SELECT * FROM s"),
    "load_summary": _with(
        *[source(n, n) for n in ("bars", "supplier_bars", "order_days", "customer_orders")],
        " UNION ALL ".join(_summary(n) for n in
                           ("bars", "supplier_bars", "order_days", "customer_orders"))),
    "clean_numbers": _with(TEXT, """SELECT "Ticker", "Date", "Close_price",
        TRY_CAST(replace("Close_price", ',', '') AS DOUBLE) AS cleaned FROM t"""),
    "parse_dates": _with(TEXT, """SELECT "Ticker", "Date", "Loose_date",
        CASE WHEN month(d) <> 2 THEN d END AS day,
        CASE WHEN month(d) <> 2 THEN strftime(d, '%Y-%m-%d') END AS iso,
        CASE WHEN month(d) <> 2 THEN d END AS back,
        split_part("Date", '/', 3) AS year FROM t"""),
    "raw_text_series": _with(TEXT, """SELECT "Ticker" AS series, d AS date, value FROM t
        WHERE day(d) <> 13"""),
    "csv_round_trip": _with(RECORDS, f"""SELECT supplier AS file_series,
        CAST(year(min(d)) AS INTEGER) AS year_from, CAST(year(max(d)) AS INTEGER) AS year_to,
        {SUMS} FROM t GROUP BY supplier"""),
    "scan_mixed_headers": _with(RECORDS, f"""SELECT supplier AS series,
        CASE WHEN CAST(supplier AS BIGINT) % 3 = 2 THEN 'of ' || supplier END AS "Note", {SUMS},
        CASE WHEN CAST(supplier AS BIGINT) % 3 = 2 THEN 0 ELSE count(*) END AS averages
        FROM t GROUP BY supplier"""),
    "ingest_files": _with(UNITS, """SELECT series || '_' || year_from || '_' || year_to AS unit,
        CASE WHEN s_acctbal < 0 THEN 'failed' ELSE 'ok' END AS status,
        CASE WHEN s_acctbal < 0 THEN 'unreadable: header isn''t UTF-8' END AS reason
        FROM u JOIN supplier ON CAST(s_suppkey AS VARCHAR) = series"""),
    "dedupe_exact": """SELECT DISTINCT * FROM (
        SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)""",
    "no_correlogram": _with(source("customer_orders"), SPLIT, """SELECT series,
        count(*) FILTER (split = 'train') AS train, 'fewer than two train rows' AS error
        FROM sp GROUP BY series HAVING count(*) FILTER (split = 'train') < 2"""),
    "skip_landed": _with(UNITS, """SELECT series, year_from, year_to FROM u
        WHERE series NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier
                             WHERE s_acctbal >= 0)"""),
    "resume_after_failure": _with(source("supplier_bars"), """SELECT series,
        CASE WHEN s_acctbal >= 0 THEN 'first' ELSE 'second' END AS batch, count(*) AS n_rows,
        count(*) AS n_found, round(sum(value), 2) AS total
        FROM s JOIN supplier ON CAST(s_suppkey AS VARCHAR) = series GROUP BY ALL"""),
    "upload_load": _with(TEXT, """SELECT "Ticker" AS series, d AS date, value FROM t
        WHERE day(d) <> 13"""),
    "file_keys": _with(UNITS, """SELECT series,
        series || '_' || year_from || '_' || year_to AS file_key FROM u"""),
    "ingest_status": _with(LENGTHS, "SELECT * FROM st"),
    "ingest_report": _with(LENGTHS, """SELECT status, count(*) AS units,
        min(series) AS first_series, max(series) AS last_series FROM st GROUP BY status"""),
    "page_rows": _with("""rows AS (
  SELECT page_id, unnest(elems) AS body, generate_subscripts(elems, 1) - 1 AS row_no
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<ul\\b[^>]*>(.*?)</ul\\s*>', 1)
        AS elems FROM pages)),
c AS (SELECT page_id, row_no, regexp_extract_all(body, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1)
      AS cells FROM rows)""", f"""SELECT page_id, CAST(row_no AS INTEGER) AS row_no, {_CELLS}
  FROM c WHERE len(cells) = {len(LIST_NAMES)}"""),
    "placeholder_cells": f"""SELECT page_id,
        {_marked("'  ' || replace(html, '###', '######') || chr(10)")} AS cell FROM pages""",
    "source_urls": _with(source("supplier_bars"), f"""SELECT DISTINCT series,
        replace('{URL_TEMPLATE}', '%s', series) AS url FROM s"""),
    "sorted_keys": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS series FROM orders",
    "split_counts": _with(source("customer_orders"), SPLIT, """SELECT series,
        count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train,
        count(*) FILTER (WHERE split = 'test') AS test FROM sp GROUP BY series"""),
    "split_rows": _with(source("customer_orders"), SPLIT, "SELECT * FROM sp"),
    "test_rows_of_split": _with(source("supplier_bars"), SPLIT,
                                "SELECT series, date, value FROM sp WHERE split = 'test'"),
    "time_index": _with(source("supplier_bars"), SPLIT,
                        "SELECT series, date, value, rn - 1 AS idx FROM sp"),
    "min_length_gate": _with(source("customer_orders"), SPLIT,
                             "SELECT series, date, value FROM sp WHERE n >= 10"),
    "length_report": _with(source("customer_orders"), f"""SELECT series, count(*) AS total,
        CASE WHEN count(*) >= {MIN_ROWS} THEN 'accepted' ELSE 'rejected' END AS status
        FROM s GROUP BY series"""),
    "membership_lookup": _with(source("supplier_bars"), """SELECT * FROM s WHERE series IN
        (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0)"""),
    "lag_features": _with(source("supplier_bars"),
                          f"SELECT series, date, value, {_LAGS} FROM s"),
    "trailing_stats": _with(source("supplier_bars"),
                            f"SELECT series, date, {_TRAILING} FROM s"),
    "feature_complete_rows": _with(source("supplier_bars"), SPLIT, f"""SELECT * FROM (
        SELECT *, {_LAGS}, {_TRAILING}, CAST(dayofweek(date) + 1 AS INTEGER) AS dow,
               CAST(month(date) AS INTEGER) AS month FROM sp)
        WHERE lag10 IS NOT NULL AND rstd5 IS NOT NULL"""),
    "rolling20_full": _with(source("bars"), SPLIT, """SELECT series, date, value,
        CASE WHEN count(*) OVER w = 20 THEN round(avg(value) OVER w, 6) END AS roll_mean,
        CASE WHEN count(*) OVER w = 20 THEN round(stddev_samp(value) OVER w, 6) END
          AS roll_std
        FROM sp WHERE split = 'train' WINDOW w AS (PARTITION BY series ORDER BY date
          ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""),
    "daily_return": _with(source("supplier_bars"), SPLIT, """SELECT *,
        CASE WHEN return_pct < 0 THEN 'down' ELSE 'up' END AS direction FROM (
          SELECT series, date, value, split, round((value / nullif(
            lag(value) OVER (PARTITION BY series ORDER BY date), 0) - 1) * 100, 6)
            AS return_pct FROM sp)"""),
    "first_difference": _with(source("supplier_bars"), SPLIT, """SELECT * FROM (
        SELECT series, date, rn, value, round(value - lag(value) OVER (
          PARTITION BY series ORDER BY date), 4) AS diff FROM sp WHERE split = 'train')
        WHERE rn > 1"""),
    "bday_fill": _with(source("order_days"), BUSINESS_DAYS, "SELECT * FROM filled"),
    "bday_fill_sparse": _with(source("customer_orders"), BUSINESS_DAYS,
                              "SELECT * FROM filled"),
    "describe_series": _with(source("supplier_bars"), """SELECT series, count(*) AS count,
        round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
        round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
        round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6)
        AS p75, round(max(value), 6) AS max FROM s GROUP BY series"""),
    "acf_band": _with(source("supplier_bars"), SPLIT, CORRELATIONS, """SELECT series, lag,
        round(value, 6) AS value, round(lo, 6) AS lo, round(hi, 6) AS hi FROM acf"""),
    "pacf_band": _with(source("supplier_bars"), SPLIT, CORRELATIONS, PARTIALS, """SELECT
        series, lag, round(value, 6) AS value, round(lo, 6) AS lo, round(hi, 6) AS hi
        FROM pacf""", recursive=True),
    "correlogram_bars": _with(source("bars"), SPLIT, CORRELATIONS, PARTIALS, """SELECT
        series, kind, lag, round(value, 6) AS value, round(hi - value, 6) AS upper,
        round(value - lo, 6) AS lower
        FROM (SELECT 'acf' AS kind, * FROM acf UNION ALL SELECT 'pacf', * FROM pacf)""",
                              recursive=True),
    "decompose_additive": _with(source("quantity_days"), BUSINESS_DAYS, DECOMPOSE, """SELECT
        series, date, period, observed, round(trend, 6) AS trend,
        round(seasonal, 6) AS seasonal, round(resid, 6) AS resid FROM dc"""),
    "decompose_weekly": _with(
        source("event_days"), BUSINESS_DAYS, DECOMPOSE,
        """SELECT series, date, period, observed, round(trend, 5) AS trend,
        round(seasonal, 5) AS seasonal, round(resid, 5) AS resid FROM dc"""),
    "decomposition_long": _with(source("quantity_days"), BUSINESS_DAYS, DECOMPOSE, " UNION ALL ".join(
        f"SELECT series, date, '{c}' AS component, round({c}, 6) AS value FROM dc"
        for c in ("observed", "trend", "seasonal", "resid"))),
    "undecomposable": _with(
        source("customer_orders"), BUSINESS_DAYS, _GRID_TRAIN,
        """SELECT series, count(*) AS train_days, 'fewer than two periods' AS error
        FROM gt GROUP BY series HAVING count(*) < 10"""),
    "undecomposable_short": _with(
        source("order_lines"), BUSINESS_DAYS, _GRID_TRAIN,
        """SELECT series, count(*) AS train_days, 'fewer than two periods' AS error
        FROM gt GROUP BY series HAVING count(*) < 10"""),
    "kpss_statistic": _with(source("supplier_bars"), SPLIT, """z AS (
  SELECT series, rn, z, sum(z) OVER (PARTITION BY series ORDER BY rn) AS cs FROM (
    SELECT series, rn, value - avg(value) OVER (PARTITION BY series) AS z
    FROM sp WHERE split = 'train')),
a AS (SELECT series, count(*) AS n, sum(cs * cs) AS ss FROM z GROUP BY series),
c AS (SELECT x.series, k, sum(x.z * y.z) AS c FROM z x
      CROSS JOIN generate_series(0, 8) g(k)
      JOIN z y ON y.series = x.series AND y.rn = x.rn - k GROUP BY x.series, k)""",
                            """SELECT a.series, a.n, CAST(l.k AS INTEGER) AS lags,
        round(any_value(a.ss) / (a.n * sum(CASE WHEN c.k = 0 THEN c.c
          ELSE 2 * (1 - c.k / (l.k + 1.0)) * c.c END)), 6) AS statistic
        FROM a CROSS JOIN generate_series(0, 8) l(k)
        JOIN c ON c.series = a.series AND c.k <= l.k GROUP BY a.series, a.n, l.k"""),
    "kpss_verdicts": _with(source("supplier_bars"), SPLIT, """x AS (
  SELECT series, 'level' AS variant, rn AS i, value AS v FROM sp WHERE split = 'train'
  UNION ALL
  SELECT series, 'difference', rn - 1, diff FROM (
    SELECT series, rn, value - lag(value) OVER (PARTITION BY series ORDER BY rn) AS diff
    FROM sp WHERE split = 'train') WHERE rn > 1),
z AS (SELECT *, v - avg(v) OVER (PARTITION BY series, variant) AS z FROM x),
cs AS (SELECT series, variant, z, sum(z) OVER (PARTITION BY series, variant ORDER BY i)
       AS s FROM z),
a AS (SELECT series, variant, CAST(count(*) AS INTEGER) AS n, sum(s * s) AS ss,
             sum(z * z) / count(*) AS base FROM cs GROUP BY series, variant),
c AS (SELECT p.series, p.variant, p.i - q.i AS k, 2 * sum(p.z * q.z) / any_value(a.n) AS g
      FROM z p JOIN a ON a.series = p.series AND a.variant = p.variant
      JOIN z q ON q.series = p.series AND q.variant = p.variant AND q.i < p.i
      GROUP BY p.series, p.variant, p.i - q.i),
l AS (SELECT a.series, a.variant, a.n, a.ss, a.base, CAST(least(floor(1.1447 *
        pow(pow(sum(k * g) / (a.base + sum(g)), 2), 1.0 / 3) * pow(a.n, 1.0 / 3)), a.n - 1)
        AS INTEGER) AS lags
      FROM a JOIN c ON c.series = a.series AND c.variant = a.variant
           AND k <= floor(pow(a.n, 2.0 / 9))
      GROUP BY a.series, a.variant, a.n, a.ss, a.base),
st AS (SELECT l.series, l.variant, l.n, l.lags, l.ss / (CAST(l.n AS DOUBLE) * l.n *
        (l.base + coalesce(sum((1 - k / (l.lags + 1.0)) * g), 0))) AS stat
       FROM l LEFT JOIN c ON c.series = l.series AND c.variant = l.variant AND k <= l.lags
       GROUP BY l.series, l.variant, l.n, l.ss, l.base, l.lags),
pv AS (SELECT *, CASE WHEN stat <= 0.347 THEN 0.10
        WHEN stat <= 0.463 THEN 0.10 + (stat - 0.347) / (0.463 - 0.347) * (0.05 - 0.10)
        WHEN stat <= 0.574 THEN 0.05 + (stat - 0.463) / (0.574 - 0.463) * (0.025 - 0.05)
        WHEN stat <= 0.739 THEN 0.025 + (stat - 0.574) / (0.739 - 0.574) * (0.01 - 0.025)
        ELSE 0.01 END AS p FROM st)""", """SELECT series, variant, n,
        round(stat, 6) AS kpss_stat, CAST(round(p, 6) AS DOUBLE) AS kpss_p,
        lags AS kpss_lags, CASE WHEN p > 0.05 THEN 'stationary' ELSE 'not stationary' END
        AS kpss_verdict FROM pv"""),
    "linear_trend_forecast": _with(source("supplier_bars"), SPLIT, _TREND, """SELECT * REPLACE
        (round(predicted, 4) AS predicted) FROM linear_trend_p"""),
    "last_value_forecast": _with(source("customer_orders"), SPLIT, _LAST,
                                 "SELECT * FROM last_value_p"),
    "holt_fixed": _with(source("bars"), SPLIT, holt(HOLT_GRID), """SELECT series, alpha, beta,
        round(level, 4) AS level, round(trend, 4) AS trend, round(sse, 0) AS sse FROM ends""",
                        recursive=True),
    "holt_grid_forecast": _with(source("bars"), SPLIT, holt(HOLT_GRID), _HOLT, """SELECT *
        REPLACE (round(predicted, 4) AS predicted) FROM holt_p""", recursive=True),
    "prediction_union": _with(predictions("supplier_bars"), """SELECT * REPLACE
        (round(predicted, 4) AS predicted) FROM p""", recursive=True),
    "prediction_union_short": _with(predictions("customer_orders"), """SELECT * REPLACE
        (round(predicted, 4) AS predicted) FROM p""", recursive=True),
    "forecast_overlay": _with(predictions("bars"), f"""wide AS (
  SELECT series, date, max(actual) AS actual, {_OVERLAY_MODELS} FROM p GROUP BY series, date),
obs AS (SELECT * FROM sp)""", f"""SELECT
        coalesce(o.series, w.series) AS series, coalesce(o.date, w.date) AS date,
        CASE WHEN o.split = 'train' THEN o.value END AS train,
        CASE WHEN o.split IS NULL OR o.split = 'test' THEN coalesce(o.value, w.actual) END
          AS actual, {_OVERLAY_ROUNDED}
        FROM obs o FULL JOIN wide w ON o.series = w.series AND o.date = w.date""",
                              recursive=True),
    "series_result_lookup": _from_metrics("bars", """SELECT p.* REPLACE
        (round(p.predicted, 4) AS predicted), m.mae, m.rmse, m.mape, m.r2
        FROM p JOIN m ON m.series = p.series AND m.model = p.model"""),
    "metrics_by_series_model": _from_metrics("supplier_bars", "SELECT * FROM m"),
    "metrics_quick_rounding": _with(metrics("bars", 2, 2, 2, 4), "SELECT * FROM m",
                                    recursive=True),
    "model_leaderboard": _from_metrics("supplier_bars", LEADERBOARD, "SELECT * FROM lb"),
    "leaderboard_flags": _from_metrics("supplier_bars", LEADERBOARD, _flags("lb")),
    "labelled_leaderboard": _from_metrics("supplier_bars", LEADERBOARD, """SELECT model,
        mae AS "MAE", rmse AS "RMSE", mape AS "MAPE (%)", r2 AS "R²" FROM lb"""),
    "overall_best_model": _from_metrics("supplier_bars", LEADERBOARD, """SELECT model, rmse
        FROM lb ORDER BY rmse, model LIMIT 1"""),
    **{f"metric_matrix_{metric}": _matrix(metric) for metric in METRICS},
    "metric_matrix_ranked": _from_metrics("supplier_bars", LEADERBOARD, """SELECT k.series,
        list(lb.model ORDER BY lb.rmse, lb.model) AS models,
        list(m.mae ORDER BY lb.rmse, lb.model) AS mae,
        list(m.rmse ORDER BY lb.rmse, lb.model) AS rmse,
        list(m.mape ORDER BY lb.rmse, lb.model) AS mape,
        list(m.r2 ORDER BY lb.rmse, lb.model) AS r2
        FROM (SELECT DISTINCT series FROM m) k CROSS JOIN lb
        LEFT JOIN m ON m.series = k.series AND m.model = lb.model GROUP BY k.series"""),
    "predictions_read_back": _with(predictions("supplier_bars"), """SELECT series, date, actual,
        round(predicted, 4) AS predicted, model FROM p""", recursive=True),
    "prediction_file_order": _with(predictions("supplier_bars"), """SELECT model,
        count(*) AS n_rows, arg_min(series, (series, date)) AS first_series,
        arg_min(date, (series, date)) AS first_date, arg_max(series, (series, date)) AS last_series,
        arg_max(date, (series, date)) AS last_date, CAST(0 AS BIGINT) AS n_breaks
        FROM p GROUP BY model""", recursive=True),
    "metrics_read_back": _from_metrics("supplier_bars", "SELECT * FROM m"),
    "metric_grid": _from_metrics("supplier_bars", f"""SELECT k.series,
        CAST(g.position AS INTEGER) AS position, g.model, m.mae, m.rmse, m.mape, m.r2
        FROM (SELECT DISTINCT series FROM m) k
        CROSS JOIN (VALUES {_GRID_MODELS}) g(position, model)
        LEFT JOIN m ON m.series = k.series AND m.model = g.model"""),
    "metric_long": _from_metrics("supplier_bars", " UNION ALL ".join(
        f"SELECT series, model, '{c}' AS metric, {c} AS value FROM m" for c in METRICS)),
    "best_model_per_series": _from_metrics("supplier_bars", BEST, "SELECT * FROM best"),
    "best_model_flags": _from_metrics("supplier_bars", BEST, _flags("best")),
    "best_model_numbered": _from_metrics("supplier_bars", BEST, """SELECT *,
        row_number() OVER (ORDER BY series) AS no FROM best"""),
    "win_counts": _from_metrics("supplier_bars", BEST, """SELECT best_model AS model,
        count(*) AS wins FROM best GROUP BY best_model"""),
    "series_metric_table": _from_metrics("supplier_bars", _flags("""(SELECT *,
        CAST(row_number() OVER (PARTITION BY series ORDER BY rmse NULLS LAST, model)
        AS INTEGER) AS no FROM m)""", "PARTITION BY series")),
    "feature_vectors": _with(source("supplier_bars"), SPLIT, f"""SELECT series, date, split,
        value, [round(x, 6) FOR x IN [lag1, lag2, lag3, lag5, lag10, rmean5, rmean10, rmean20,
        rstd5, rstd10, rstd20, CAST(dow AS DOUBLE), CAST(month AS DOUBLE)]] AS features
        FROM (SELECT *, {_LAGS}, {_TRAILING}, dayofweek(date) + 1 AS dow, month(date) AS month
              FROM sp) WHERE lag10 IS NOT NULL AND rstd5 IS NOT NULL"""),
    "quick_split_counts": _with(QUICK, SPLIT, """SELECT series,
        count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train,
        count(*) FILTER (WHERE split = 'test') AS test FROM sp GROUP BY series"""),
    "quick_overview": _with(QUICK, SPLIT, """SELECT *,
        CASE WHEN return_pct < 0 THEN 'down' ELSE 'up' END AS direction FROM (
          SELECT series, date, value, split, round((value / nullif(
            lag(value) OVER (PARTITION BY series ORDER BY date), 0) - 1) * 100, 6)
            AS return_pct FROM sp)"""),
    "quick_rolling": _with(QUICK, SPLIT, """SELECT series, date, value,
        CASE WHEN count(*) OVER w = 20 THEN round(avg(value) OVER w, 6) END AS roll_mean,
        CASE WHEN count(*) OVER w = 20 THEN round(stddev_samp(value) OVER w, 6) END
          AS roll_std
        FROM sp WHERE split = 'train' WINDOW w AS (PARTITION BY series ORDER BY date
          ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""),
    "quick_difference": _with(QUICK, SPLIT, """SELECT * FROM (
        SELECT series, date, rn, value, round(value - lag(value) OVER (
          PARTITION BY series ORDER BY date), 6) AS diff FROM sp WHERE split = 'train')
        WHERE rn > 1"""),
    "quick_correlograms": _with(QUICK, SPLIT, CORRELATIONS.replace(
        "least(40, count(*) - 1)", "least(40, count(*) - 1, (count(*) + 1) // 3)"), PARTIALS,
        """SELECT series, kind, lag, round(value, 6) AS value, round(hi - value, 6) AS upper,
        round(value - lo, 6) AS lower
        FROM (SELECT 'acf' AS kind, * FROM acf UNION ALL SELECT 'pacf', * FROM pacf)""",
        recursive=True),
    "lr_forecast": _with(source("supplier_bars"), SPLIT, FEATURE_ROWS, ridge(0.05),
                         "SELECT * REPLACE (round(predicted, 2) AS predicted) FROM lr_p"),
    "forest_leaves": _with(source("bars"), SPLIT, FEATURE_ROWS, """SELECT
        CAST(tree AS INTEGER) AS tree, count(*) AS n_rows, round(sum(value), 0) AS total,
        CAST(0 AS BIGINT) AS n_wrong
        FROM f CROSS JOIN generate_series(0, 99) g(tree) WHERE split = 'train' GROUP BY tree"""),
    "adf_fixed_lags": _with(source("supplier_bars"), SPLIT, ADF, *map(adf_at, range(4)),
                            " UNION ALL ".join(
        f"SELECT series, variant, {k} AS lags, round(stat, 6) AS adf_stat FROM t{k}"
        for k in range(4))),
    "unfitted_series": _with(source("customer_orders"), """SELECT series, count(*) AS total
        FROM s GROUP BY series HAVING floor(count(*) * CAST(0.8 AS DOUBLE)) < 1"""),
}
