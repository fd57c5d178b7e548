"""Independent SQL for the registered queries (DuckDB dialect, whole tables)."""

from __future__ import annotations

from tidegrid.plans.inputs import INDICATORS, TICKERS

# Shared table expressions. Missing periods are generated per series from its own extent.
_PRICE = """price AS (
  SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS month,
         arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price
  FROM orders GROUP BY 1, 2)"""
_WIDE = """wide AS (
  SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month,
         arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price
  FROM orders GROUP BY 1, 2)"""
_DAILY = """daily AS (
  SELECT l_returnflag, l_shipdate::DATE AS day, sum(l_extendedprice::DECIMAL(28, 2))::DOUBLE AS revenue
  FROM lineitem GROUP BY 1, 2)"""
_IND = _DAILY + """, ind AS (
  SELECT l_returnflag, date_trunc('month', day)::DATE AS month, arg_max(revenue, day) AS revenue
  FROM daily GROUP BY 1, 2)"""
_DISC = """disc AS (
  SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS month, min(l_discount) AS discount
  FROM lineitem GROUP BY 1, 2)"""


def _grid(name: str, source: str, key: str, value: str) -> str:
    return f"""{name}_ends AS (
  SELECT {key}, min(month) AS lo, max(month) AS hi FROM {source} GROUP BY 1),
{name}_spine AS (
  SELECT {key}, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month
  FROM {name}_ends),
{name} AS (
  SELECT s.{key}, s.month, x.{value} FROM {name}_spine s
  LEFT JOIN {source} x ON x.{key} = s.{key} AND x.month = s.month)"""


PM = _PRICE + ", " + _grid("pm", "price", "o_orderpriority", "price")
WM = _WIDE + ", " + _grid("wm", "wide", "o_custkey", "price")
IM = _IND + ", " + _grid("im", "ind", "l_returnflag", "revenue")
DM = _DISC + ", " + _grid("dm", "disc", "l_suppkey", "discount")

W_PRIO = "(PARTITION BY o_orderpriority ORDER BY month)"
W_CUST = "(PARTITION BY o_custkey ORDER BY month)"


def _div(a: str, b: str) -> str:
    # IEEE division gives signed infinities by itself; only 0 / 0 has to become NULL.
    return f"(CASE WHEN NOT (({a}) = 0 AND ({b}) = 0) THEN ({a})::DOUBLE / ({b})::DOUBLE END)"


def _rint(x: str, digits: int = 2) -> str:
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"(CASE WHEN isinf({x}) THEN {x} ELSE round_even(({x}) * {scale}, 0) / {scale} + 0.0::DOUBLE END)"


def _pct(cur: str, prev: str) -> str:
    return _rint(f"{_div(f'{cur} - {prev}', prev)} * 100.0::DOUBLE")


def _ffill(x: str, window: str) -> str:
    """``window`` is ``(PARTITION BY ... ORDER BY ...)`` without a frame."""
    return f"last_value({x} IGNORE NULLS) OVER {window[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _bfill(x: str, window: str) -> str:
    return f"first_value({x} IGNORE NULLS) OVER {window[:-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _returns(name: str, source: str, window: str, value: str, key: str) -> str:
    return f"""{name}_pad AS (SELECT {key}, month, {value} AS raw, {_ffill(value, window)} AS level FROM {source}),
{name}_lag AS (SELECT *, lag(level) OVER {window} AS prev FROM {name}_pad),
{name} AS (SELECT {key}, month, raw, {_div('level', 'prev')} - 1.0::DOUBLE AS ret FROM {name}_lag)"""


PR = PM + ", " + _returns("pr", "pm", W_PRIO, "price", "o_orderpriority")
WR = WM + ", " + _returns("wr", "wm", W_CUST, "price", "o_custkey")
WY = WM + f""", wy AS (SELECT o_custkey, month, price,
  {_pct('price', 'p12')} AS yoy FROM (SELECT *, lag(price, 12) OVER {W_CUST} AS p12 FROM wm))"""
DC = DM + f""", dp AS (SELECT *, lag(discount) OVER (PARTITION BY l_suppkey ORDER BY month) AS previous FROM dm),
dc AS (SELECT *, {_pct('discount', 'previous')} AS chg FROM dp)"""

_MONTHS = "months AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders)"


# The supervised frame.

_IND_NAMES = list(INDICATORS.values())
_TICK_NAMES = list(TICKERS.values())
_CHANGES = [f"{n}_YOY" for n in _IND_NAMES] + [f"{n}_MOM" for n in _IND_NAMES]
_LAG_COLS = [f"{t}_Return_Prev{k}M" for t in _TICK_NAMES for k in (1, 2, 3)]
_TARGETS = [f"Next_Month_{t}" for t in _TICK_NAMES]
_VALUES = [*_IND_NAMES, *_CHANGES, *_LAG_COLS, *_TARGETS]
_MONTH_FLAGS = [f"Month_{m:02d}" for m in range(1, 13)]
_QUARTER_FLAGS = [f"Quarter_{q}" for q in range(1, 5)]


def _q(name: str) -> str:
    return f'"{name}"'


def _indicator_source(grain: str) -> str:
    months = _DAILY + f""", ind AS (
  SELECT l_returnflag, date_trunc('{grain}', day)::DATE AS month, arg_max(revenue, day) AS revenue
  FROM daily GROUP BY 1, 2)"""
    return months + ", " + _grid("im", "ind", "l_returnflag", "revenue")


def _indicator_wide(grain: str = "month") -> str:
    window = "(PARTITION BY l_returnflag ORDER BY month)"
    cells = []
    for sid, name in INDICATORS.items():
        at = f"FILTER (l_returnflag = '{sid}')"
        cells += [f"max(revenue) {at} AS {_q(name)}", f"max(yoy) {at} AS {_q(name + '_YOY')}",
                  f"max(mom) {at} AS {_q(name + '_MOM')}"]
    return f"""{_indicator_source(grain)}, ilag AS (
  SELECT *, lag(revenue, 12) OVER {window} AS p12, lag(revenue, 1) OVER {window} AS p1 FROM im),
ifeat AS (SELECT l_returnflag, month, revenue, {_pct('revenue', 'p12')} AS yoy, {_pct('revenue', 'p1')} AS mom FROM ilag),
iwide AS (SELECT month, {', '.join(cells)} FROM ifeat GROUP BY month)"""


def _supervised() -> str:
    cells = []
    for sid, name in TICKERS.items():
        at = f"FILTER (o_orderpriority = '{sid}')"
        cells += [f"max(lag{k}) {at} AS {_q(f'{name}_Return_Prev{k}M')}" for k in (1, 2, 3)]
        cells.append(f"max(next1) {at} AS {_q(f'Next_Month_{name}')}")
    w = "(ORDER BY month)"
    percent = [*_LAG_COLS, *_TARGETS]
    return f"""{_indicator_wide()}, {PR}, pfeat AS (
  SELECT o_orderpriority, month, lag(ret, 1) OVER {W_PRIO} AS lag1, lag(ret, 2) OVER {W_PRIO} AS lag2,
         lag(ret, 3) OVER {W_PRIO} AS lag3, lead(ret, 1) OVER {W_PRIO} AS next1 FROM pr),
pwide AS (SELECT month, {', '.join(cells)} FROM pfeat GROUP BY month),
outer_joined AS (SELECT coalesce(i.month, p.month) AS month, i.* EXCLUDE (month), p.* EXCLUDE (month)
  FROM iwide i FULL OUTER JOIN pwide p ON i.month = p.month),
carried AS (SELECT month, {', '.join(f'{_ffill(_q(c), w)} AS {_q(c)}' for c in _VALUES)} FROM outer_joined),
sup AS (SELECT month AS period, year(month)::INT AS "Year", month(month)::INT AS "Month", quarter(month)::INT AS "Quarter",
  {', '.join(f"{_rint(_q(c) + ' * 100.0::DOUBLE')} AS {_q(c)}" if c in percent else _q(c) for c in _VALUES)}
  FROM carried WHERE month < (SELECT max(month) FROM carried))"""


def _clean(x: str) -> str:
    return f"(CASE WHEN NOT isinf({x}) THEN {x} END)"


def _matrix(keep_targets: bool) -> str:
    flags = [f'("Month" = {i})::INT AS {_q(n)}' for i, n in enumerate(_MONTH_FLAGS, 1)]
    flags += [f'("Quarter" = {i})::INT AS {_q(n)}' for i, n in enumerate(_QUARTER_FLAGS, 1)]
    w = "(ORDER BY period)"
    filled = [f"coalesce({_ffill(_q(c), w)}, {_bfill(_q(c), w)}) AS {_q(c)}" for c in _IND_NAMES]
    filled += [f"coalesce({_q(c)}, 0.0::DOUBLE) AS {_q(c)}" for c in _CHANGES]
    filled += [f"coalesce({_q(c)}, median({_q(c)}) OVER ()) AS {_q(c)}" for c in _LAG_COLS]
    imputed = [*_IND_NAMES, *_CHANGES, *_LAG_COLS]
    targets = [f"coalesce({_q(c)}, median({_q(c)}) OVER ()) AS {_q(c)}" for c in _TARGETS] if keep_targets else []
    last = [f"coalesce({_q(c)}, median({_q(c)}) OVER ()) AS {_q(c)}" for c in imputed]
    lags = [f"{_rint(_q(c), 9)} AS {_q(c)}" for c in _LAG_COLS]
    angle = '2 * pi() * "Month" / 12'
    return f"""{_supervised()},
filled AS (SELECT period, "Year", "Month", {', '.join(flags)}, {', '.join([*filled, *targets])} FROM sup),
finite AS (SELECT * REPLACE ({', '.join(f'{_clean(_q(c))} AS {_q(c)}' for c in imputed)}) FROM filled),
complete AS (SELECT * REPLACE ({', '.join(last)}) FROM finite),
matrix AS (SELECT * EXCLUDE ("Month") REPLACE ({', '.join(lags)}),
  {_rint(f'sin({angle})', 9)} AS "Month_Sin", {_rint(f'cos({angle})', 9)} AS "Month_Cos" FROM complete)"""


_FEATURES = ["Year", *_MONTH_FLAGS, *_QUARTER_FLAGS, "Month_Sin", "Month_Cos", *_IND_NAMES, *_CHANGES, *_LAG_COLS]


_SHARED = [*_IND_NAMES, *_CHANGES]
_OWN_LAGS = ["Own_Return_Prev1M", "Own_Return_Prev2M", "Own_Return_Prev3M"]


def _own(returns: str, key: str) -> str:
    """Per series: own lagged returns and target, carried forward, in percent; and the newest month."""
    w = f"(PARTITION BY {key} ORDER BY month)"
    cells = ["lag1", "lag2", "lag3", "next1"]
    return f"""own AS (
  SELECT {key}, month, lag(ret, 1) OVER {w} AS lag1, lag(ret, 2) OVER {w} AS lag2,
         lag(ret, 3) OVER {w} AS lag3, lead(ret, 1) OVER {w} AS next1 FROM {returns}),
ownc AS (SELECT {key}, month, {', '.join(f'{_ffill(c, w)} AS {c}' for c in cells)},
  max(month) OVER (PARTITION BY {key}) AS newest FROM own),
ownp AS (SELECT {key}, month, {', '.join(f"{_rint(c + ' * 100.0::DOUBLE')} AS {_q(n)}"
                                         for c, n in zip(cells, [*_OWN_LAGS, 'Next_Month_Own']))}
  FROM ownc WHERE month < newest)"""


def _calendar() -> str:
    """As-of values of every indicator column on the months of both sides."""
    w = "(ORDER BY month)"
    return f"""cal AS (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month
  FROM (SELECT min(month) AS lo, max(month) AS hi FROM (SELECT month FROM iwide UNION ALL SELECT month FROM own))),
icar AS (SELECT month, {', '.join(f'{_ffill(_q(c), w)} AS {_q(c)}' for c in _SHARED)}
  FROM cal LEFT JOIN iwide USING (month))"""


def _panel(grain: str = "month") -> str:
    """Per customer: own lagged returns and target next to the shared indicators."""
    return f"""WITH {_indicator_wide(grain)}, {WR}, {_own('wr', 'o_custkey')}, {_calendar()}
SELECT o_custkey, month AS period, year(month)::INT AS "Year", month(month)::INT AS "Month", quarter(month)::INT AS "Quarter",
  {', '.join(_q(c) for c in [*_SHARED, *_OWN_LAGS, 'Next_Month_Own'])} FROM ownp LEFT JOIN icar USING (month)"""


def _panel_matrix() -> str:
    """Features of the customer panel; lags without any value in their series take the overall median."""
    w, whole = "(ORDER BY month)", "(PARTITION BY o_custkey)"
    flags = [f'(month(month) = {i})::INT AS {_q(n)}' for i, n in enumerate(_MONTH_FLAGS, 1)]
    flags += [f'(quarter(month) = {i})::INT AS {_q(n)}' for i, n in enumerate(_QUARTER_FLAGS, 1)]
    levels = [f"coalesce({_ffill(_q(c), w)}, {_bfill(_q(c), w)}) AS {_q(c)}" for c in _IND_NAMES]
    levels += [f"coalesce({_q(c)}, 0.0::DOUBLE) AS {_q(c)}" for c in _CHANGES]
    angle = '2 * pi() * month(month) / 12'
    lag_out = [f"coalesce({_q(c)}, (SELECT median({_q(c)}) FROM lags3))" for c in _OWN_LAGS]
    return f"""WITH {_indicator_wide()}, {WR}, {_own('wr', 'o_custkey')}, {_calendar()},
i1 AS (SELECT month, {', '.join(levels)} FROM icar),
i2 AS (SELECT month, {', '.join(f'{_clean(_q(c))} AS {_q(c)}' for c in _SHARED)} FROM i1),
i3 AS (SELECT month, {', '.join(f'coalesce({_q(c)}, median({_q(c)}) OVER ()) AS {_q(c)}' for c in _SHARED)} FROM i2),
lags1 AS (SELECT o_custkey, month, {', '.join(f'coalesce({_q(c)}, median({_q(c)}) OVER {whole}) AS {_q(c)}' for c in _OWN_LAGS)} FROM ownp),
lags2 AS (SELECT o_custkey, month, {', '.join(f'{_clean(_q(c))} AS {_q(c)}' for c in _OWN_LAGS)} FROM lags1),
lags3 AS (SELECT o_custkey, month, {', '.join(f'coalesce({_q(c)}, median({_q(c)}) OVER {whole}) AS {_q(c)}' for c in _OWN_LAGS)} FROM lags2)
SELECT o_custkey, month AS period, year(month)::INT AS "Year", {', '.join(flags)},
  {_rint(f'sin({angle})', 9)} AS "Month_Sin", {_rint(f'cos({angle})', 9)} AS "Month_Cos", {', '.join(map(_q, _SHARED))},
  {', '.join(f'{_rint(x, 9)} AS {_q(c)}' for c, x in zip(_OWN_LAGS, lag_out))}
FROM lags3 LEFT JOIN i3 USING (month)"""


_PANEL_FEATURES = ["Year", *_MONTH_FLAGS, *_QUARTER_FLAGS, "Month_Sin", "Month_Cos", *_SHARED, *_OWN_LAGS]
_PRIO_KEYS = f"WITH {PM}, newest AS (SELECT o_orderpriority, max(month) AS last FROM pm GROUP BY 1) " + """
      SELECT pm.o_orderpriority, pm.month AS period, {flags} FROM pm JOIN newest USING (o_orderpriority) WHERE month < last"""


def _unpivot_counts(source: str, columns: list[str], test: str, out: str) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER ({test.format(c=_q(c))}) AS {out} FROM {source}"
             for c in columns]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE {out} > 0"


def _describe(table: str, columns: list[str]) -> str:
    stats = {"count": "count({c})::DOUBLE", "mean": "avg({c}::DOUBLE)", "std": "stddev_samp({c}::DOUBLE)",
             "min": "min({c})::DOUBLE", "25%": "quantile_cont({c}::DOUBLE, 0.25)",
             "50%": "quantile_cont({c}::DOUBLE, 0.5)", "75%": "quantile_cont({c}::DOUBLE, 0.75)",
             "max": "max({c})::DOUBLE"}
    return " UNION ALL ".join(
        f"SELECT '{s}' AS stat, '{c}' AS column_name, {_rint(e.format(c=c), 4)} AS value FROM {table}"
        for c in columns for s, e in stats.items())


_RANKED = """revenue AS (
  SELECT l_returnflag, l_partkey::VARCHAR AS feature, sum(l_extendedprice::DECIMAL(28, 2))::DOUBLE AS importance
  FROM lineitem GROUP BY 1, 2),
ranked AS (SELECT * FROM (SELECT l_returnflag,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY importance DESC, feature)::INT AS rank, feature, importance
  FROM revenue) WHERE rank <= 5)"""

_RECORD = "record AS (SELECT l_returnflag, " + ", ".join(
    f"max(feature) FILTER (rank = {i}) AS top{i}_feature, max(importance) FILTER (rank = {i}) AS top{i}_importance"
    for i in range(1, 6)) + " FROM ranked GROUP BY 1)"

_LO, _HI = "TIMESTAMP '1997-07-01'", "TIMESTAMP '2001-08-01'"

ORACLES: dict[str, str] = {
    "scan_prices": f"""SELECT o_orderpriority, o_orderkey, o_orderdate::DATE AS day, o_totalprice FROM orders
        WHERE o_orderpriority IN ({', '.join(f"'{t}'" for t in TICKERS)}) AND o_orderdate >= {_LO} AND o_orderdate < {_HI}""",
    "scan_indicators": f"""SELECT l_returnflag, l_orderkey, l_linenumber, l_shipdate::DATE AS day, l_extendedprice
        FROM lineitem WHERE l_shipdate >= {_LO} AND l_shipdate < {_HI}""",
    "lookback_window": " UNION ALL ".join(
        f"""SELECT {m}::INT AS months, DATE '{lo}' AS lo, DATE '2001-08-01' AS hi, count(*) AS n_rows FROM orders
        WHERE o_orderdate >= DATE '{lo}' AND o_orderdate < DATE '2001-08-01'"""
        for m, lo in ((2, "2000-05-01"), (36, "1997-07-01"))),
    "resample_last": f"WITH {_PRICE} SELECT * FROM price",
    "resample_daily": f"""WITH obs AS (
        SELECT event_type, ts::DATE AS day, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2),
      ends AS (SELECT event_type, min(day) AS lo, max(day) AS hi FROM obs GROUP BY 1),
      spine AS (SELECT event_type, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM ends),
      dense AS (SELECT s.event_type, s.day, o.value FROM spine s LEFT JOIN obs o ON o.event_type = s.event_type AND o.day = s.day),
      prev AS (SELECT *, lag(value, 7) OVER (PARTITION BY event_type ORDER BY day) AS p7 FROM dense)
      SELECT event_type, day, value, {_pct('value', 'p7')} AS wow FROM prev""",
    "calendar_spine": f"WITH {WM} SELECT * FROM wm",
    "period_return": f"WITH {PR} SELECT o_orderpriority, month, {_rint('ret', 6)} AS ret FROM pr",
    "yoy_change": f"WITH {WY} SELECT * FROM wy",
    "mom_change": f"""WITH {PM}, l AS (SELECT *, lag(price) OVER {W_PRIO} AS p1 FROM pm)
      SELECT o_orderpriority, month, price, {_pct('price', 'p1')} AS mom FROM l""",
    "zero_base_change": f"""WITH {DC} SELECT l_suppkey, month,
        CASE WHEN chg = 'inf'::DOUBLE THEN '+inf' WHEN chg = '-inf'::DOUBLE THEN '-inf' WHEN chg IS NOT NULL THEN 'finite'
             WHEN discount = 0 AND previous = 0 THEN 'zero over zero' ELSE 'unknown' END AS chg_class,
        {_clean('chg')} AS chg FROM dc""",
    "inf_to_null": f"WITH {DC} SELECT l_suppkey, month, {_clean('chg')} AS clean FROM dc",
    "lag_features": f"""WITH {PR}, l AS (SELECT *, lag(ret, 1) OVER {W_PRIO} AS a, lag(ret, 2) OVER {W_PRIO} AS b,
        lag(ret, 3) OVER {W_PRIO} AS c FROM pr)
      SELECT o_orderpriority, month, {_rint('a', 6)} AS prev1, {_rint('b', 6)} AS prev2, {_rint('c', 6)} AS prev3 FROM l""",
    "lead_target": f"""WITH {PR}, l AS (SELECT *, lead(ret) OVER {W_PRIO} AS a FROM pr)
      SELECT o_orderpriority, month, {_rint('a', 6)} AS next1 FROM l""",
    "percent_scale": f"WITH {PR} SELECT o_orderpriority, month, {_rint('ret * 100.0::DOUBLE')} AS pct FROM pr",
    "ffill": f"WITH {WM} SELECT *, {_ffill('price', W_CUST)} AS filled FROM wm",
    "ffill_bfill": f"WITH {WY} SELECT *, coalesce({_ffill('yoy', W_CUST)}, {_bfill('yoy', W_CUST)}) AS filled FROM wy",
    "fill_zero": f"WITH {WY} SELECT *, coalesce(yoy, 0.0::DOUBLE) AS filled FROM wy",
    "fill_median": f"""WITH {WM}, f AS (SELECT *, coalesce(price, median(price) OVER (PARTITION BY o_custkey)) AS v FROM wm)
      SELECT o_custkey, month, price, {_rint('v', 4)} AS filled FROM f""",
    "fill_expanding_median": f"""WITH {PM}, g AS (
        SELECT *, CASE WHEN month(month) % 3 <> 0 THEN price END AS v FROM pm), f AS (
        SELECT *, coalesce(v, median(v) OVER {W_PRIO[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS m FROM g)
      SELECT o_orderpriority, month, price, {_rint('m', 4)} AS filled FROM f""",
    "fill_global_median": f"""WITH {WM}, m AS (SELECT median(price) AS m FROM wm)
      SELECT o_custkey, month, price, {_rint('coalesce(price, m)', 4)} AS filled FROM wm, m""",
    "impute_chain": f"""WITH {WY}, {_returns('wr', 'wm', W_CUST, 'price', 'o_custkey')},
      joined AS (SELECT wy.*, wr.ret FROM wy JOIN wr ON wy.o_custkey = wr.o_custkey AND wy.month = wr.month),
      step1 AS (SELECT o_custkey, month, coalesce({_ffill('price', W_CUST)}, {_bfill('price', W_CUST)}) AS level,
        coalesce(yoy, 0.0::DOUBLE) AS yoy, coalesce(ret, median(ret) OVER (PARTITION BY o_custkey)) AS ret FROM joined),
      step2 AS (SELECT o_custkey, month, {_clean('level')} AS level, {_clean('yoy')} AS yoy, {_clean('ret')} AS ret FROM step1),
      step3 AS (SELECT o_custkey, month, coalesce(level, median(level) OVER (PARTITION BY o_custkey)) AS level,
        coalesce(yoy, median(yoy) OVER (PARTITION BY o_custkey)) AS yoy,
        coalesce(ret, median(ret) OVER (PARTITION BY o_custkey)) AS ret FROM step2)
      SELECT o_custkey, month, level, yoy, {_rint('ret', 6)} AS ret FROM step3""",
    "asof_carry": f"""WITH {PM}, q AS (
        SELECT o_orderpriority, date_trunc('quarter', o_orderdate)::DATE AS month,
               arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS q_price FROM orders GROUP BY 1, 2)
      SELECT pm.o_orderpriority, pm.month, exact.q_price, q.q_price AS carried
      FROM pm ASOF LEFT JOIN q ON pm.o_orderpriority = q.o_orderpriority AND pm.month >= q.month
      LEFT JOIN q exact ON exact.o_orderpriority = pm.o_orderpriority AND exact.month = pm.month""",
    "align_outer": f"""WITH {PM}, {IM},
      p AS (SELECT month, {', '.join(f"max(price) FILTER (o_orderpriority = '{s}') AS {_q(n)}" for s, n in TICKERS.items())} FROM pm GROUP BY 1),
      i AS (SELECT month, {', '.join(f"max(revenue) FILTER (l_returnflag = '{s}') AS {_q(n)}" for s, n in INDICATORS.items())} FROM im GROUP BY 1)
      SELECT coalesce(p.month, i.month) AS month, p.* EXCLUDE (month), i.* EXCLUDE (month)
      FROM p FULL OUTER JOIN i ON p.month = i.month""",
    "calendar_parts": f"""WITH {_MONTHS} SELECT month, year(month)::INT AS year, month(month)::INT AS month_no,
        quarter(month)::INT AS quarter, last_day(month) AS month_end FROM months""",
    "format_period": f"""WITH {_MONTHS} SELECT strftime(month, '%Y-%m') AS ym, month, strftime(month, '%Y_%m') AS ym_us,
        strftime(month, '%Y-%m-%d') AS ymd FROM months""",
    "onehot_month": f"""WITH {_MONTHS} SELECT month AS period, {', '.join(f'(month(month) = {i})::INT AS {_q(n)}' for i, n in enumerate(_MONTH_FLAGS, 1))} FROM months""",
    "onehot_quarter": f"""WITH {_MONTHS} SELECT month AS period, {', '.join(f'(quarter(month) = {i})::INT AS {_q(n)}' for i, n in enumerate(_QUARTER_FLAGS, 1))} FROM months""",
    "cyclic_month": f"""WITH {_MONTHS} SELECT month AS period, {_rint('sin(2 * pi() * month(month) / 12)', 12)} AS m_sin,
        {_rint('cos(2 * pi() * month(month) / 12)', 12)} AS m_cos FROM months""",
    "supervised_frame": f"WITH {_supervised()} SELECT * FROM sup",
    "supervised_panel": _panel(),
    "supervised_panel_quarterly": _panel("quarter"),
    "feature_panel": _panel_matrix(),
    "select_by_pattern": f"WITH {_supervised()} SELECT period, {', '.join(map(_q, _CHANGES))} FROM sup",
    "feature_matrix": f"WITH {_matrix(False)} SELECT period, {', '.join(map(_q, _FEATURES))} FROM matrix",
    "training_frame": f"""WITH {_matrix(True)} SELECT period, {', '.join(map(_q, _FEATURES))},
        {', '.join(f'{_rint(_q(c), 9)} AS {_q(c)}' for c in _TARGETS)}, '2001-08-15' AS "Processing_Date",
        (row_number() OVER (ORDER BY period) - 1)::INT AS row_idx FROM matrix""",
    "drop_last_period": f"""WITH {PM} SELECT pm.* FROM pm
        WHERE month < (SELECT max(month) FROM pm x WHERE x.o_orderpriority = pm.o_orderpriority)""",
    "latest_row": f"""WITH {_WIDE} SELECT o_custkey, max(month) AS month, arg_max(price, month) AS price FROM wide GROUP BY 1""",
    "missing_profile": f"WITH {_supervised()} " + _unpivot_counts(
        "sup", ["Year", "Month", "Quarter", *_VALUES], "{c} IS NULL", "n_missing"),
    "inf_profile": f"WITH {DC} " + _unpivot_counts("dc", ["discount", "previous", "chg"], "isinf({c})", "n_inf"),
    "series_coverage": f"""WITH {WM}, n AS (SELECT o_custkey, count(price) AS n_obs, count(*) AS n_grid FROM wm GROUP BY 1)
      SELECT c_custkey AS o_custkey, coalesce(n_obs, 0) AS n_obs, coalesce(n_grid, 0) AS n_grid,
             coalesce(n_obs, 0) = 0 AS is_empty FROM customer LEFT JOIN n ON n.o_custkey = c_custkey""",
    "column_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_rint(f'median({c})', 4)} AS median FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "quality_gate": f"""WITH {_matrix(False)}, g AS (SELECT count(*) AS n_rows,
        sum({' + '.join(f'({_q(c)} IS NULL)::INT' for c in _FEATURES)})::BIGINT AS n_missing,
        sum({' + '.join(f'coalesce(isinf({_q(c)}::DOUBLE), false)::INT' for c in _FEATURES)})::BIGINT AS n_inf FROM matrix)
      SELECT *, n_missing = 0 AND n_inf = 0 AS passed FROM g""",
    "describe": _describe("orders", ["o_orderkey", "o_custkey", "o_totalprice"]) + " UNION ALL " + _describe(
        "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax"]),
    "standardize": f"""WITH {_WIDE}, s AS (SELECT avg(price) AS m, stddev_pop(price) AS sd FROM wide)
      SELECT o_custkey, month, {_rint('(price - m) / sd', 6)} AS z, 0.0::DOUBLE AS z_const FROM wide, s""",
    "r2_score": f"""WITH {WM}, c AS (SELECT *, {_ffill('price', W_CUST)} AS carried FROM wm),
      g AS (SELECT *, lag(carried) OVER {W_CUST} AS guess FROM c),
      s AS (SELECT o_custkey, sum(power(price - guess, 2)) AS sse, var_pop(price) * count(*) AS sst
            FROM g WHERE price IS NOT NULL AND guess IS NOT NULL GROUP BY 1)
      SELECT o_custkey, {_rint('CASE WHEN sst <> 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END', 6)} AS r2 FROM s""",
    "kfold_ids": f"WITH {PM} SELECT o_orderpriority, month, (ntile(5) OVER {W_PRIO} - 1)::INT AS fold FROM pm",
    "calendar_kfold_ids": f"""WITH {WM}, m AS (SELECT month, (ntile(5) OVER (ORDER BY month) - 1)::INT AS fold
        FROM (SELECT DISTINCT month FROM wm))
      SELECT o_custkey, month, fold FROM wm JOIN m USING (month)""",
    "carry_ticks": """SELECT event_id, ts, event_type, value,
        last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM events""",
    "carry_series_ticks": """WITH e AS (SELECT event_id, ts, event_type, value, CASE WHEN event_id % 3 = 0 THEN value END AS known FROM events)
      SELECT event_id, ts, event_type, value, coalesce(
        last_value(known IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(known IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM e""",
    "asof_ticks": """WITH p AS (SELECT ts, arg_max(value, event_id) AS value FROM events
        WHERE event_type = 'purchase' AND value IS NOT NULL GROUP BY ts)
      SELECT e.event_id, e.ts, p.value AS carried, p.ts AS carried_from
      FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN p ON e.ts >= p.ts""",
    "number_ticks": """SELECT event_id, ts, event_type, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_idx,
        row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS type_idx FROM events""",
    "fold_ticks": """WITH f AS (SELECT ts, (ntile(5) OVER (ORDER BY ts) - 1)::INT AS fold FROM (SELECT DISTINCT ts FROM events))
      SELECT event_id, ts, fold FROM events JOIN f USING (ts)""",
    "ensemble_band": f"""WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS vote FROM embeddings),
      a AS (SELECT vec_id, avg(vote) AS m, stddev_pop(vote) AS s, quantile_cont(vote, 0.25) AS lo,
            quantile_cont(vote, 0.75) AS hi FROM v GROUP BY 1)
      SELECT vec_id, {_rint('m', 9)} AS mean, {_rint('s', 9)} AS std, {_rint('lo', 9)} AS p25, {_rint('hi', 9)} AS p75 FROM a""",
    "stamp_version": "SELECT strftime(o_orderdate, '%Y_%m') AS version, count(*) AS n FROM orders GROUP BY 1",
    "list_versions": "SELECT DISTINCT strftime(o_orderdate, '%Y_%m') AS version FROM orders",
    "latest_version": """SELECT strftime(o_orderdate, '%Y_%m') AS version, o_orderkey, o_custkey, o_orderpriority, o_totalprice
        FROM orders WHERE strftime(o_orderdate, '%Y_%m') = (SELECT max(strftime(o_orderdate, '%Y_%m')) FROM orders)""",
    "append_if_absent": f"""SELECT o_orderkey, o_custkey, o_orderpriority,
        CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN o_totalprice ELSE {_rint('o_totalprice * 2')} END AS o_totalprice,
        o_orderdate::DATE AS day FROM orders""",
    "append_repeated_keys": """WITH o AS (
        SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS k, o_orderkey, o_totalprice FROM orders),
      known AS (SELECT * FROM o WHERE o_orderkey % 5 = 0 AND k IS NOT NULL),
      fresh AS (SELECT k, min(o_orderkey) AS o_orderkey FROM o WHERE o_orderkey % 5 <> 0 GROUP BY k)
      SELECT * FROM known UNION ALL
      SELECT o.* FROM o JOIN fresh ON o.o_orderkey = fresh.o_orderkey AND o.k IS NOT DISTINCT FROM fresh.k
      WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.k IS NOT DISTINCT FROM fresh.k)""",
    "forest_fit_predict": _PRIO_KEYS.format(flags="true AS within_labels, true AS better_than_mean"),
    "forest_band": _PRIO_KEYS.format(flags="true AS mean_is_prediction, true AS band_in_order, true AS spread_known"),
    "feature_importance": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, true AS is_share, true AS total_is_one, true AS ranks_complete" for c in _PANEL_FEATURES),
    "cv_scores": " UNION ALL ".join(
        f"SELECT 'Next_Month_Own' AS target, {i}::INT AS fold, true AS is_score, true AS mean_holds, true AS std_holds"
        for i in range(5)),
    "model_metrics": " UNION ALL ".join(
        f"SELECT 'Next_Month_Own' AS target, '{m}' AS metric, true AS holds" for m in ("r2", "cv_mean", "cv_std")),
    "forest_panel": f"""WITH {WM}, newest AS (SELECT o_custkey, max(month) AS last FROM wm GROUP BY 1)
      SELECT wm.o_custkey, wm.month AS period, true AS within_labels FROM wm JOIN newest USING (o_custkey) WHERE month < last""",
    "fold_scores": f"""WITH {PM}, c AS (SELECT *, {_ffill('price', W_PRIO)} AS carried FROM pm),
      g AS (SELECT *, lag(carried) OVER {W_PRIO} AS guess FROM c),
      m AS (SELECT month, (ntile(5) OVER (ORDER BY month) - 1)::INT AS fold FROM (SELECT DISTINCT month FROM pm)),
      s AS (SELECT fold, 1 - sum(power(price - guess, 2)) / (var_pop(price) * count(*)) AS r2
            FROM g JOIN m USING (month) WHERE price IS NOT NULL AND guess IS NOT NULL GROUP BY 1)
      SELECT fold, {_rint('r2', 6)} AS r2, {_rint('(SELECT avg(r2) FROM s)', 6)} AS fold_mean,
             {_rint('(SELECT stddev_pop(r2) FROM s)', 6)} AS fold_std FROM s""",
    "topk_importance": f"WITH {_RANKED} SELECT l_returnflag, rank, feature, importance FROM ranked",
    "prediction_record": f"WITH {_RANKED}, {_RECORD} SELECT * FROM record",
    "unpivot_topk": f"WITH {_RANKED}, {_RECORD} " + " UNION ALL ".join(
        f"SELECT l_returnflag, {i}::INT AS rank, top{i}_feature AS feature, top{i}_importance AS importance FROM record"
        for i in range(1, 6)),
    "report_lines": f"""WITH {_IND}, {_RANKED},
      digits AS (SELECT *, power(10.0, 5 - floor(log10(importance))) AS scale FROM ranked),
      said AS (SELECT l_returnflag AS target, avg(l_discount::DECIMAL(18, 4))::DOUBLE AS mean, min(l_tax) AS p25,
        max(l_tax) AS p75, max(l_discount) AS r2 FROM lineitem GROUP BY 1),
      lines AS (
        SELECT 1 AS section, target AS grp, 0 AS pos, '- **' || target || ' expected return**: ' || printf('%.2f', mean) || '%' AS line FROM said
        UNION ALL SELECT 1, target, 1, '  - Inter-quartile band: ' || printf('%.2f', p25) || '% to ' || printf('%.2f', p75) || '%' FROM said
        UNION ALL SELECT 2, target, 0, '- ' || target || ' model R2 score: ' || printf('%.4f', r2) FROM said
        UNION ALL SELECT DISTINCT 3 AS section, l_returnflag AS grp, -3 AS pos, '### ' || l_returnflag || ' key factors' AS line FROM ranked
        UNION ALL SELECT DISTINCT 3, l_returnflag, -2, '|  | feature | importance |' FROM ranked
        UNION ALL SELECT DISTINCT 3, l_returnflag, -1, '|---|---|---|' FROM ranked
        UNION ALL SELECT 3, l_returnflag, rank, '| ' || (rank - 1)::VARCHAR || ' | ' || feature || ' | ' ||
          regexp_replace((round_even(importance * scale, 0) / scale)::DECIMAL(30, 6)::VARCHAR, '\\.?0+$', '') || ' |' FROM digits
        UNION ALL SELECT 4, l_returnflag, 0, '- ' || l_returnflag || ': ' || printf('%.2f', arg_max(revenue, month))
          FROM ind GROUP BY l_returnflag)
      SELECT row_number() OVER (ORDER BY section, grp, pos)::INT AS line_no, line FROM lines""",
}
