"""Independent DuckDB SQL for every query of the catalog.

Written from the semantics, not from our Spark code: each string runs on the
driver tables registered as views (``orders``, ``events``, ``lineitem``...).
Float features are compared at 8 decimals (averages of prices and forecasts at 6); ``+ 0.0`` turns a
rounded -0.0 into 0.0 so both engines print the same value.
"""

from __future__ import annotations

# Fixed values shared with the catalog.
RUN_TS = "2026-01-01 00:00:00"
RUN_DATE = "2001-06-01"


def r8(expr: str) -> str:
    return f"(round({expr}, 8) + 0.0)"


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def mean6(expr: str) -> str:
    """Averages of cents at 6 decimals; exact ties (of 32 or 64 amounts) go up."""
    return f"round({expr} + 0.000000001, 6)"


RATES = """
rates AS (
  SELECT CAST(o_orderdate AS DATE) AS ingestion_date,
         o_orderpriority AS base_currency,
         o_orderstatus AS target_currency,
         o_totalprice AS rate,
         'orders' AS source,
         CAST(o_orderdate AS TIMESTAMP) AS ingested_at,
         o_orderkey AS record_id
  FROM orders
)"""

BRONZE = """
bronze AS (
  SELECT ingestion_date, base_currency, target_currency, rate, source, ingested_at
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY ingestion_date, base_currency, target_currency
      ORDER BY ingested_at DESC, record_id DESC) AS rn
    FROM rates)
  WHERE rn = 1
)"""

VALID = """
valid AS (
  SELECT * FROM bronze
  WHERE rate IS NOT NULL AND rate BETWEEN 0.000001 AND 1000000000.0
)"""

VALID_DEFAULT = """
valid AS (
  SELECT * FROM bronze
  WHERE rate IS NOT NULL AND rate BETWEEN 0.000001 AND 100000.0
)"""

SILVER = """
silver AS (
  SELECT date, currency_pair, base_currency, target_currency, rate,
         lag(rate) OVER (PARTITION BY currency_pair ORDER BY date) AS prev_rate,
         CASE WHEN lag(rate) OVER (PARTITION BY currency_pair ORDER BY date) <> 0
              THEN rate / lag(rate) OVER (PARTITION BY currency_pair ORDER BY date) - 1.0 END AS daily_return
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY currency_pair, date
      ORDER BY ingested_at DESC, base_currency DESC, target_currency DESC) AS rn
    FROM (
      SELECT ingestion_date AS date, concat_ws('_', base_currency, target_currency) AS currency_pair,
             base_currency, target_currency, rate, ingested_at
      FROM valid))
  WHERE rn = 1
)"""


def gold_cte(windows=(7, 30, 90), vol=30, source="silver", name="gold") -> str:
    w = "PARTITION BY currency_pair ORDER BY date ROWS BETWEEN {} PRECEDING AND CURRENT ROW"
    mas = ",\n         ".join(f"avg(rate) OVER ({w.format(n - 1)}) AS ma_{n}" for n in windows)
    return f"""
{name} AS (
  SELECT date, currency_pair, rate, daily_return,
         {mas},
         stddev_samp(daily_return) OVER ({w.format(vol - 1)}) AS volatility_{vol},
         (rate - avg(rate) OVER (PARTITION BY currency_pair))
           / nullif(stddev_samp(rate) OVER (PARTITION BY currency_pair), 0) AS rate_z_score
  FROM {source}
)"""


GOLD = gold_cte()


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


CHAIN_BRONZE = with_(RATES, BRONZE)
CHAIN_SILVER = with_(RATES, BRONZE, VALID, SILVER)
CHAIN_GOLD = with_(RATES, BRONZE, VALID, SILVER, GOLD)

GOLD_COLS_R8 = ", ".join(
    [
        "date",
        "currency_pair",
        "rate",
        r8("daily_return") + " AS daily_return",
        mean6("ma_7") + " AS ma_7",
        mean6("ma_30") + " AS ma_30",
        mean6("ma_90") + " AS ma_90",
        r8("volatility_30") + " AS volatility_30",
        r8("rate_z_score") + " AS rate_z_score",
    ]
)


SQL: dict[str, str] = {}

SQL["dedup_latest"] = CHAIN_BRONZE + "SELECT * FROM bronze"

SQL["filter_valid"] = with_(RATES, BRONZE, VALID_DEFAULT) + "SELECT * FROM valid"

SQL["daily_return"] = CHAIN_SILVER + f"""
SELECT date, currency_pair, rate, prev_rate, {r8('daily_return')} AS daily_return FROM silver"""

SQL["ma_7"] = CHAIN_SILVER + f"""
SELECT date, currency_pair, rate,
       {mean6('avg(rate) OVER (PARTITION BY currency_pair ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS ma_7
FROM silver"""

SILVER_SELECT = f"""
SELECT date, currency_pair, base_currency, target_currency, rate, prev_rate,
       {r8('daily_return')} AS daily_return FROM silver"""

SQL["silver_rates"] = with_(RATES, BRONZE, VALID_DEFAULT, SILVER) + SILVER_SELECT

SQL["silver_rates_split"] = CHAIN_SILVER + SILVER_SELECT

SQL["rejected_rates"] = CHAIN_BRONZE + """
SELECT *, CASE WHEN rate IS NULL THEN 'null_rate' WHEN isnan(rate) THEN 'nan_rate'
               WHEN rate < 0.000001 THEN 'below_min' ELSE 'above_max' END AS reason
FROM bronze WHERE rate IS NULL OR isnan(rate) OR rate < 0.000001 OR rate > 100000.0"""

SQL["gold_rates"] = CHAIN_GOLD + f"SELECT {GOLD_COLS_R8} FROM gold"

SQL["gold_rates_split"] = SQL["gold_rates"]

SQL["dedup_ties"] = """
SELECT CAST(l_shipdate AS DATE) AS ingestion_date, l_returnflag AS base_currency, l_linestatus AS target_currency,
       max(l_extendedprice) AS rate, 'lineitem' AS source, CAST(max(l_shipdate) AS TIMESTAMP) AS ingested_at
FROM lineitem GROUP BY ALL"""

# ---- landing / sources ------------------------------------------------------

SQL["explode_rates"] = """
SELECT event_id, CAST(ts AS DATE) AS date, k AS target_currency,
       TRY_CAST(json_extract_string(props, '$."' || k || '"') AS DOUBLE) AS rate
FROM events, unnest(json_keys(props)) AS t(k)"""

SQL["row_counts"] = with_(RATES, BRONZE, VALID, SILVER, GOLD) + """
SELECT 'raw' AS layer, count(*) AS n_rows FROM rates
UNION ALL SELECT 'bronze', count(*) FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM gold"""

EARLY = """
early AS (
  SELECT ingestion_date, base_currency, target_currency, rate
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY ingestion_date, base_currency, target_currency
      ORDER BY ingested_at DESC, record_id ASC) AS rn
    FROM rates)
  WHERE rn = 1 AND ingestion_date <= DATE '1999-12-31'
)"""

LATE = """
late AS (SELECT ingestion_date, base_currency, target_currency, rate FROM bronze WHERE ingestion_date >= DATE '1999-07-01')"""

SQL["upsert_insert_only"] = with_(RATES, BRONZE, EARLY, LATE) + """
SELECT base_currency AS base, ingestion_date AS date, target_currency, rate FROM early
UNION ALL
SELECT base_currency, ingestion_date, target_currency, rate FROM late l
WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.base_currency = l.base_currency AND e.ingestion_date = l.ingestion_date)"""

SQL["upsert_force"] = with_(RATES, BRONZE, EARLY, LATE) + """
SELECT base_currency AS base, ingestion_date AS date, target_currency, rate FROM late
UNION ALL
SELECT base_currency, ingestion_date, target_currency, rate FROM early e
WHERE NOT EXISTS (SELECT 1 FROM late l WHERE e.base_currency = l.base_currency AND e.ingestion_date = l.ingestion_date)"""

# ---- projections --------------------------------------------------------------

SQL["enforce_schema"] = with_(RATES) + """
SELECT ingestion_date, base_currency, target_currency, rate, source, ingested_at FROM rates"""

SQL["currency_pair"] = with_(RATES) + """
SELECT record_id, base_currency, target_currency, concat_ws('_', base_currency, target_currency) AS currency_pair
FROM rates"""

SQL["rename_date"] = CHAIN_BRONZE + """
SELECT ingestion_date AS date, base_currency, target_currency, rate, source, ingested_at FROM bronze"""

SQL["parse_dates"] = """
SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE) AS ingestion_date,
       CAST(o_orderdate AS TIMESTAMP) AS ingested_at
FROM orders"""

SQL["bronze_rates"] = CHAIN_BRONZE + "SELECT * FROM bronze"

SQL["landing_bronze"] = SQL["bronze_rates"]

SQL["latest_stream"] = CHAIN_BRONZE + """
SELECT base_currency || '_' || target_currency AS currency_pair, base_currency, target_currency, ingestion_date AS date, rate, source, ingested_at,
       rate BETWEEN 0.000001 AND 1e9 AS valid
FROM (SELECT *, row_number() OVER (PARTITION BY base_currency, target_currency ORDER BY ingestion_date DESC) AS rn FROM bronze)
WHERE rn = 1"""

SQL["quarantine_counts"] = """
SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'malformed_json' WHEN '2' THEN 'missing_base' WHEN '3' THEN 'bad_date'
            WHEN '4' THEN 'bad_timestamp' ELSE 'bad_rate' END AS reason, count(*) AS n_rows
FROM orders GROUP BY 1"""

SQL["chart_returns"] = CHAIN_GOLD + f"""
SELECT date, currency_pair, {r8('daily_return * 100.0')} AS daily_return_pct
FROM gold WHERE daily_return IS NOT NULL"""

# ---- filters ------------------------------------------------------------------------

SQL["rejected_counts"] = CHAIN_BRONZE + f"""
SELECT CASE WHEN rate IS NULL THEN 'null_rate'
            WHEN isnan(rate) THEN 'nan_rate'
            WHEN rate < 0.000001 THEN 'below_min'
            WHEN rate > 100000.0 THEN 'above_max'
            ELSE 'valid' END AS outcome,
       count(*) AS n_rows
FROM bronze GROUP BY 1"""

SELECTED_PAIRS = ("1-URGENT_F", "3-MEDIUM_O", "5-LOW_P")
_pairs_sql = ", ".join(f"'{p}'" for p in SELECTED_PAIRS)

SQL["pair_selection"] = CHAIN_GOLD + f"SELECT {GOLD_COLS_R8} FROM gold WHERE currency_pair IN ({_pairs_sql})"

SQL["nonnull_returns"] = CHAIN_SILVER + f"""
SELECT date, currency_pair, rate, {r8('daily_return')} AS daily_return FROM silver WHERE daily_return IS NOT NULL"""

SQL["outliers"] = CHAIN_GOLD + f"""
SELECT date, currency_pair, rate, {r8('rate_z_score')} AS rate_z_score FROM gold WHERE abs(rate_z_score) > 1.5"""

SQL["weekday_filter"] = CHAIN_BRONZE + """
SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS weekday
FROM (SELECT DISTINCT ingestion_date AS date FROM bronze)
WHERE isodow(date) <= 5"""

EXPECTED_TARGETS = ("F", "O", "P")
_expected_sql = ", ".join(f"('{t}')" for t in EXPECTED_TARGETS)

SQL["missing_targets"] = CHAIN_BRONZE + f"""
SELECT k.base, k.date, e.t AS missing_target
FROM (SELECT DISTINCT base_currency AS base, ingestion_date AS date FROM bronze) k,
     (VALUES {_expected_sql}) e(t)
WHERE NOT EXISTS (SELECT 1 FROM bronze b WHERE b.base_currency = k.base AND b.ingestion_date = k.date
                  AND b.target_currency = e.t)"""

# ---- planning ---------------------------------------------------------------------

SPINE = """
spine AS (
  SELECT CAST(unnest(generate_series(min(ingestion_date), max(ingestion_date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM bronze
)"""

SQL["date_spine"] = with_(RATES, BRONZE, SPINE) + "SELECT date FROM spine"

SQL["weekday_spine"] = with_(RATES, BRONZE, SPINE) + "SELECT date FROM spine WHERE isodow(date) <= 5"

SQL["spine_summary"] = with_(RATES, BRONZE, SPINE) + """
SELECT count(*) AS n_days, count(*) FILTER (WHERE isodow(date) <= 5) AS n_weekdays,
       count(*) FILTER (WHERE isodow(date) > 5) AS n_skipped FROM spine"""

SQL["dates_to_load"] = CHAIN_BRONZE + """
, req AS (
  SELECT base, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT base_currency AS base, min(ingestion_date) AS lo, max(ingestion_date) AS hi FROM bronze GROUP BY 1)
)
SELECT base, date FROM req r
WHERE isodow(date) <= 5
  AND NOT EXISTS (SELECT 1 FROM bronze b WHERE b.base_currency = r.base AND b.ingestion_date = r.date)"""

SQL["recent_days"] = CHAIN_BRONZE + """
, req AS (
  SELECT base, CAST(unnest(generate_series(hi - INTERVAL 29 DAY, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT base_currency AS base, max(ingestion_date) AS hi FROM bronze GROUP BY 1)
)
SELECT base, date FROM req r
WHERE NOT EXISTS (SELECT 1 FROM bronze b WHERE b.base_currency = r.base AND b.ingestion_date = r.date)"""

SQL["fetch_label"] = CHAIN_BRONZE + f"""
SELECT date, CASE WHEN date >= DATE '{RUN_DATE}' THEN 'latest' ELSE strftime(date, '%Y-%m-%d') END AS label
FROM (SELECT DISTINCT ingestion_date AS date FROM bronze)"""

# ---- joins ---------------------------------------------------------------------------

LATEST_COLS_R8 = ", ".join(
    ["currency_pair", "date", "rate"]
    + [(mean6 if c.startswith("ma_") else r8)(c) + f" AS {c}" for c in ("ma_7", "ma_30", "ma_90", "volatility_30", "rate_z_score")]
)

SQL["latest_rates"] = CHAIN_GOLD + f"""
SELECT {LATEST_COLS_R8} FROM gold WHERE date = (SELECT max(date) FROM gold)"""

SQL["latest_rates_5_20"] = with_(RATES, BRONZE, VALID, SILVER, gold_cte((5, 20), 10)) + f"""
SELECT currency_pair, date, rate, {mean6('ma_5')} AS ma_5, {mean6('ma_20')} AS ma_20,
       {r8('volatility_10')} AS volatility_10, {r8('rate_z_score')} AS rate_z_score
FROM gold WHERE date = (SELECT max(date) FROM gold)"""

SQL["rate_z_score_join"] = CHAIN_SILVER + f"""
SELECT s.date, s.currency_pair, s.rate,
       {r8('(s.rate - st.m) / nullif(st.sd, 0)')} AS rate_z_score
FROM silver s JOIN (SELECT currency_pair, avg(rate) AS m, stddev_samp(rate) AS sd FROM silver GROUP BY 1) st
  USING (currency_pair)"""

# ---- aggregates -------------------------------------------------------------------

SQL["max_date"] = CHAIN_GOLD + "SELECT max(date) AS max_date FROM gold"

SQL["return_stats"] = CHAIN_GOLD + """
SELECT currency_pair,
       round_even(avg(daily_return * 100.0), 4) AS mean_pct,
       round_even(stddev_samp(daily_return * 100.0), 4) AS std_pct,
       round_even(min(daily_return * 100.0), 4) AS min_pct,
       round_even(max(daily_return * 100.0), 4) AS max_pct
FROM gold WHERE daily_return IS NOT NULL GROUP BY 1"""

SQL["avg_volatility"] = CHAIN_GOLD + f"""
SELECT currency_pair, {r8('avg(volatility_30)')} AS avg_vol
FROM gold WHERE volatility_30 IS NOT NULL GROUP BY 1"""

DAILY = """
daily AS (
  SELECT CAST(ts AS DATE) AS date, event_type AS currency_pair, round(avg(value), 8) AS rate
  FROM events GROUP BY 1, 2
),
daily_silver AS (
  SELECT date, currency_pair, rate,
         CASE WHEN lag(rate) OVER (PARTITION BY currency_pair ORDER BY date) <> 0
              THEN rate / lag(rate) OVER (PARTITION BY currency_pair ORDER BY date) - 1.0 END AS daily_return
  FROM daily
)"""

CHAIN_DAILY_GOLD = with_(DAILY, gold_cte(source="daily_silver", name="dgold"))

SQL["daily_outliers"] = CHAIN_DAILY_GOLD + f"""
SELECT date, currency_pair, rate, {r8('rate_z_score')} AS rate_z_score FROM dgold WHERE abs(rate_z_score) > 2.0"""


def _cells(date: str) -> str:
    """Every (date, pair) cell of the volatility matrix, empty ones too."""
    return CHAIN_DAILY_GOLD + f"""
, cells AS (SELECT date, currency_pair, avg(volatility_30) AS v FROM dgold WHERE volatility_30 IS NOT NULL GROUP BY 1, 2)
SELECT {date} AS date, p.currency_pair, {r8('c.v')} AS avg_vol
FROM (SELECT DISTINCT date FROM cells) d CROSS JOIN (SELECT DISTINCT currency_pair FROM cells) p
LEFT JOIN cells c ON c.date = d.date AND c.currency_pair = p.currency_pair"""


SQL["volatility_pivot"] = _cells("d.date")
SQL["volatility_pivot_by_pair"] = _cells("strftime(d.date, '%Y-%m-%d')")

SQL["distinct_pairs"] = CHAIN_GOLD + "SELECT DISTINCT currency_pair FROM gold"

SQL["latest_per_pair"] = CHAIN_GOLD + f"""
SELECT {LATEST_COLS_R8} FROM (
  SELECT *, row_number() OVER (PARTITION BY currency_pair ORDER BY date DESC) AS rn FROM gold)
WHERE rn = 1"""

SQL["training_counts"] = CHAIN_GOLD + """
SELECT currency_pair, count(*) AS n_rows, count(rate) AS n_valid, min(date) AS first_date,
       max(date) AS last_date, count(*) >= 30 AS eligible
FROM gold GROUP BY 1"""

# ---- windows -------------------------------------------------------------------

SQL["prev_rate"] = CHAIN_SILVER + "SELECT date, currency_pair, rate, prev_rate FROM silver"

SQL["moving_averages"] = CHAIN_GOLD + f"""
SELECT date, currency_pair, {mean6('ma_7')} AS ma_7, {mean6('ma_30')} AS ma_30, {mean6('ma_90')} AS ma_90 FROM gold"""

SQL["volatility_30"] = CHAIN_GOLD + f"SELECT date, currency_pair, {r8('volatility_30')} AS volatility_30 FROM gold"

SQL["rate_z_score"] = CHAIN_GOLD + f"SELECT date, currency_pair, rate, {r8('rate_z_score')} AS rate_z_score FROM gold"

SQL["latest_change"] = CHAIN_GOLD + f"""
, last2 AS (
  SELECT currency_pair, date, rate,
         row_number() OVER (PARTITION BY currency_pair ORDER BY date DESC) AS rn FROM gold)
SELECT a.currency_pair, a.date AS latest_date, a.rate AS latest_rate,
       {r8('(a.rate - coalesce(b.rate, a.rate)) / nullif(coalesce(b.rate, a.rate), 0) * 100.0')} AS change_pct
FROM last2 a LEFT JOIN last2 b ON a.currency_pair = b.currency_pair AND b.rn = 2
WHERE a.rn = 1"""

SQL["tail_90"] = CHAIN_GOLD + """
SELECT currency_pair, date, rate FROM (
  SELECT *, row_number() OVER (PARTITION BY currency_pair ORDER BY date DESC) AS rn FROM gold)
WHERE rn <= 90"""

SQL["order_key"] = CHAIN_SILVER + """
SELECT date, currency_pair, CAST(date_diff('day', DATE '1970-01-01', date) AS BIGINT) AS order_key FROM silver"""

SQL["ma_calendar_days"] = CHAIN_SILVER + f"""
SELECT date, currency_pair, rate,
       {mean6("avg(rate) OVER (PARTITION BY currency_pair ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)")} AS ma_30d,
       {r8("stddev_samp(daily_return) OVER (PARTITION BY currency_pair ORDER BY date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)")} AS volatility_30d
FROM silver"""

# ---- sorts / sets -----------------------------------------------------------------

SQL["ma_calendar_days_split"] = SQL["ma_calendar_days"]

SQL["training_set"] = CHAIN_GOLD + "SELECT currency_pair, date AS ds, rate AS y FROM gold WHERE rate IS NOT NULL"

SQL["top_outliers"] = CHAIN_GOLD + f"""
SELECT date, currency_pair, rate, {r8('rate_z_score')} AS rate_z_score FROM gold
WHERE abs(rate_z_score) > 1.5
ORDER BY abs(rate_z_score) DESC, date, currency_pair LIMIT 20"""

SQL["table_preview"] = CHAIN_GOLD + f"SELECT {GOLD_COLS_R8} FROM gold ORDER BY date, currency_pair LIMIT 10"

LINE_RATES = """
line_rates AS (
  SELECT CAST(l_shipdate AS DATE) AS ingestion_date, l_returnflag AS base_currency, l_linestatus AS target_currency,
         l_extendedprice AS rate, 'lineitem' AS source, CAST(l_shipdate AS TIMESTAMP) AS ingested_at,
         l_orderkey * 8 + l_linenumber AS record_id
  FROM lineitem
),
line_bronze AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY ingestion_date, base_currency, target_currency
      ORDER BY ingested_at DESC, record_id DESC) AS rn
    FROM line_rates)
  WHERE rn = 1
)"""

LINE_CHAIN = with_(
    LINE_RATES,
    VALID.replace("valid AS", "line_valid AS").replace("FROM bronze", "FROM line_bronze"),
    SILVER.replace("silver AS", "line_silver AS").replace("FROM valid", "FROM line_valid"),
    gold_cte(source="line_silver", name="line_gold"),
)

SQL["line_gold_rates"] = LINE_CHAIN + f"SELECT {GOLD_COLS_R8} FROM line_gold"

SUPPLIER_RATES = LINE_RATES.replace("l_returnflag AS base_currency", "'S' || l_suppkey AS base_currency")

SQL["supplier_gold_rates"] = LINE_CHAIN.replace(LINE_RATES, SUPPLIER_RATES) + f"SELECT {GOLD_COLS_R8} FROM line_gold"

SQL["union_pairs"] = with_(RATES, BRONZE, LINE_RATES) + """
SELECT ingestion_date AS date, concat_ws('_', base_currency, target_currency) AS currency_pair, rate, 'orders' AS series
FROM bronze
UNION ALL
SELECT ingestion_date, concat_ws('_', base_currency, target_currency), rate, 'lineitem' FROM line_bronze"""

# ---- forecast -------------------------------------------------------------------

FC = CHAIN_GOLD + """
, cnt AS (
  SELECT currency_pair, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
  FROM gold GROUP BY 1 HAVING count(*) >= 30
),
pts AS (
  SELECT g.currency_pair, g.rate, CAST(date_diff('day', c.first_date, g.date) AS DOUBLE) AS t,
         isodow(g.date) - 1 AS wd
  FROM gold g JOIN cnt c USING (currency_pair) WHERE g.rate IS NOT NULL
),
line AS (
  SELECT currency_pair, regr_intercept(rate, t) AS a, regr_slope(rate, t) AS b FROM pts GROUP BY 1
),
resid AS (
  SELECT p.currency_pair, p.wd, p.rate - (l.a + l.b * p.t) AS e0 FROM pts p JOIN line l USING (currency_pair)
),
prof AS (SELECT currency_pair, wd, avg(e0) AS s_w FROM resid GROUP BY 1, 2),
sig AS (
  SELECT r.currency_pair, stddev_samp(r.e0 - p.s_w) AS sigma
  FROM resid r JOIN prof p USING (currency_pair, wd) GROUP BY 1
),
model AS (
  SELECT * FROM cnt JOIN line USING (currency_pair) JOIN sig USING (currency_pair)
  WHERE b IS NOT NULL AND sigma IS NOT NULL
),
days AS (
  SELECT m.*, CAST(unnest(generate_series(last_date + 1, last_date + 30, INTERVAL 1 DAY)) AS DATE) AS forecast_date
  FROM model m
),
fc AS (
  SELECT d.currency_pair, d.forecast_date,
         d.a + d.b * CAST(date_diff('day', d.first_date, d.forecast_date) AS DOUBLE) + coalesce(p.s_w, 0.0) AS yhat,
         d.sigma, d.n_rows
  FROM days d LEFT JOIN prof p ON p.currency_pair = d.currency_pair AND p.wd = isodow(d.forecast_date) - 1
),
fc2 AS (
  SELECT currency_pair, forecast_date, yhat,
         yhat - 1.959963984540054 * sigma AS yhat_lower,
         yhat + 1.959963984540054 * sigma AS yhat_upper,
         CAST(n_rows AS INTEGER) AS training_rows
  FROM fc
)
"""

SQL["forecast"] = FC + f"""
SELECT currency_pair, forecast_date, {r6('yhat')} AS yhat, {r6('yhat_lower')} AS yhat_lower,
       {r6('yhat_upper')} AS yhat_upper, training_rows FROM fc2"""

SQL["forecast_split"] = SQL["forecast"]

#: Normal equations of 16 columns (level, slope, 4 hinges, 6 weekdays, 2 harmonics), solved by Gauss-Jordan steps.
SEASONAL_COLUMNS = """[1.0, t, greatest(t - 0.2, 0), greatest(t - 0.4, 0), greatest(t - 0.6, 0), greatest(t - 0.8, 0),
    (wd = 1)::DOUBLE, (wd = 2)::DOUBLE, (wd = 3)::DOUBLE, (wd = 4)::DOUBLE, (wd = 5)::DOUBLE, (wd = 6)::DOUBLE,
    sin(d * (2 * pi() / 365.25)), cos(d * (2 * pi() / 365.25)), sin(d * (4 * pi() / 365.25)), cos(d * (4 * pi() / 365.25))]"""

SEASONAL = CHAIN_GOLD.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, bounds AS (
  SELECT min(date) AS lo, greatest(max(date) - min(date), 1) AS span FROM gold WHERE rate IS NOT NULL
),
sized AS (
  SELECT currency_pair, count(*) AS n_rows, count(rate) AS n_fit, max(date) AS last_date FROM gold GROUP BY 1
  HAVING count(*) >= 30 AND min(date) FILTER (rate IS NOT NULL) < max(date) FILTER (rate IS NOT NULL)
),
timed AS (
  SELECT currency_pair, rate, (date - lo)::DOUBLE / span AS t, (date - DATE '1970-01-01')::DOUBLE AS d, isodow(date) - 1 AS wd
  FROM gold, bounds WHERE rate IS NOT NULL
),
x AS (SELECT currency_pair, list_append({SEASONAL_COLUMNS}, rate) AS x FROM timed),
prod AS (
  SELECT currency_pair, i, j, sum(x[i] * x[j]) AS m
  FROM x, range(1, 18) a(i), range(1, 18) b(j) GROUP BY ALL
),
cells AS (
  SELECT currency_pair, i, j, m + CASE WHEN i <> j OR i <= 2 OR i > 16 THEN 0.0 WHEN i <= 6 THEN 1.0 ELSE 0.1 END AS v FROM prod WHERE i <= 16
  UNION ALL
  SELECT currency_pair, i, 17 + k, (i = k)::DOUBLE FROM (SELECT DISTINCT currency_pair FROM prod), range(1, 17) a(i), range(1, 17) b(k)
),
gauss(currency_pair, k, a) AS (
  SELECT currency_pair, 0, list(v ORDER BY i, j) FROM cells GROUP BY 1
  UNION ALL
  SELECT currency_pair, k + 1, list_transform(range(0, 528), lambda e: CASE
      WHEN e // 33 = k THEN a[e + 1] / a[k * 33 + k + 1]
      ELSE a[e + 1] - a[(e // 33) * 33 + k + 1] * (a[k * 33 + e % 33 + 1] / a[k * 33 + k + 1]) END)
  FROM gauss WHERE k < 16
),
solved AS (
  SELECT s.*, a, list_transform(range(0, 16), lambda i: a[i * 33 + 17]) AS beta FROM gauss JOIN sized s USING (currency_pair) WHERE k = 16
),
xy AS (
  SELECT currency_pair, list(m ORDER BY i) FILTER (i <= 16) AS xy, max(m) FILTER (i = 17) AS yy FROM prod WHERE j = 17 GROUP BY 1
),
smodel AS (
  SELECT solved.*, sqrt(greatest(yy - list_dot_product(beta, xy), 0) / greatest(n_fit - 6, 1)) AS sigma FROM solved JOIN xy USING (currency_pair)
),
ahead AS (
  SELECT m.*, CAST(unnest(generate_series(last_date + 1, last_date + 30, INTERVAL 1 DAY)) AS DATE) AS forecast_date FROM smodel m
),
atimed AS (
  SELECT ahead.*, (forecast_date - lo)::DOUBLE / span AS t, (forecast_date - DATE '1970-01-01')::DOUBLE AS d, isodow(forecast_date) - 1 AS wd
  FROM ahead, bounds
),
ax AS (SELECT *, {SEASONAL_COLUMNS} AS x FROM atimed),
sfc AS (
  SELECT currency_pair, forecast_date, list_dot_product(beta, x) AS yhat, n_rows,
         1.959963984540054 * sigma * sqrt(1 + list_sum(list_transform(range(0, 36), lambda c: a[(c // 6) * 33 + 18 + c % 6] * x[c // 6 + 1] * x[c % 6 + 1]))) AS w
  FROM ax
)
"""

SQL["forecast_seasonal"] = SEASONAL + """
SELECT currency_pair, forecast_date, round(yhat, 4) + 0.0 AS yhat, round(yhat - w, 4) + 0.0 AS yhat_lower,
       round(yhat + w, 4) + 0.0 AS yhat_upper, CAST(n_rows AS INTEGER) AS training_rows FROM sfc"""

SQL["forecast_skipped"] = CHAIN_DAILY_GOLD + """
SELECT currency_pair, count(*) AS n_rows, 'too_few_rows' AS reason FROM dgold GROUP BY 1 HAVING count(*) < 31"""

SQL["forecast_model"] = FC + f"""
SELECT currency_pair, n_rows, first_date, last_date, {r6('a')} AS a, {r6('b')} AS b, {r6('sigma')} AS sigma FROM model"""

SQL["forecast_summary"] = FC + f"""
SELECT currency_pair, forecast_date, {r6('yhat')} AS forecast_rate, {r6('yhat_lower')} AS lower_bound,
       {r6('yhat_upper')} AS upper_bound, {r6('yhat_upper - yhat_lower')} AS uncertainty_range FROM fc2"""

SQL["forecast_display"] = FC + """
SELECT currency_pair, forecast_date AS "Date", round(yhat, 5) + 0.0 AS "Forecast",
       round(yhat_lower, 5) + 0.0 AS "Lower (95%)", round(yhat_upper, 5) + 0.0 AS "Upper (95%)" FROM fc2"""

SQL["history_and_forecast"] = FC + f"""
SELECT currency_pair, date, 'history' AS kind, {r6('rate')} AS value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
FROM (SELECT *, row_number() OVER (PARTITION BY currency_pair ORDER BY date DESC) AS rn FROM gold) WHERE rn <= 90
UNION ALL
SELECT currency_pair, forecast_date, 'forecast', {r6('yhat')}, {r6('yhat_lower')}, {r6('yhat_upper')} FROM fc2"""

# ---- serving --------------------------------------------------------------------

SQL["adhoc_sql"] = CHAIN_GOLD + """
SELECT currency_pair, CAST(year(date) AS INTEGER) AS year, count(*) AS days, count(*) FILTER (abs(daily_return) > 0.5) AS large_moves
FROM gold GROUP BY 1, 2"""

SQL["chart_rates"] = CHAIN_GOLD + "SELECT date, currency_pair, rate FROM gold"

SQL["chart_rates_ma"] = CHAIN_GOLD + f"""
SELECT date, currency_pair, rate, {mean6('ma_7')} AS ma_7, {mean6('ma_30')} AS ma_30, {mean6('ma_90')} AS ma_90 FROM gold"""

# ---- scalar functions ------------------------------------------------------------

SQL["fn_string"] = with_(RATES) + """
SELECT record_id,
       concat_ws('_', base_currency, target_currency) AS currency_pair,
       string_split(concat_ws('_', base_currency, target_currency), '_')[1] AS base_part,
       string_split(concat_ws('_', base_currency, target_currency), '_')[2] AS target_part,
       trim('  ' || base_currency || '  ') AS trimmed,
       CAST(length(base_currency) AS INTEGER) AS base_len
FROM rates"""

SQL["fn_datetime"] = """
SELECT o_orderkey AS record_id,
       CAST(o_orderdate AS DATE) AS d,
       CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS unix_day,
       CAST(epoch(o_orderdate) AS BIGINT) AS unix_seconds,
       strftime(o_orderdate, '%Y-%m-%d') AS iso_date,
       CAST(o_orderdate AS DATE) + 30 AS plus_30,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
       CAST(o_orderdate AS DATE) >= DATE '2001-06-01' AS is_recent
FROM orders"""

SQL["fn_math"] = CHAIN_SILVER + f"""
SELECT date, currency_pair,
       {r8('rate / prev_rate - 1.0')} AS simple_return,
       {r8('abs(daily_return) * 100.0')} AS abs_return_pct,
       round(rate, 2) + 0.0 AS rate_2dp,
       round_even(rate / 1000.0, 1) + 0.0 AS rate_k_even
FROM silver"""

SQL["fn_null"] = CHAIN_SILVER + """
SELECT date, currency_pair,
       coalesce(prev_rate, rate) AS prev_or_rate,
       prev_rate IS NOT NULL AS has_prev,
       rate BETWEEN 10000.0 AND 50000.0 AS mid_band,
       CASE WHEN prev_rate IS NULL THEN 'first' WHEN rate <> prev_rate THEN 'moved' ELSE 'flat' END AS state,
       nullif(target_currency, 'F') AS open_target
FROM silver"""

SQL["fn_json_map"] = """
SELECT event_id,
       CAST(json_array_length(json_keys(props)) AS INTEGER) AS n_keys,
       json_keys(props)[1] AS first_key,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_value
FROM events"""
