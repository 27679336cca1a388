"""DuckDB statements of the p queries that SQL can express."""

from marketloom.functions.fundamentals import METRIC_ALIASES


def _p3(table: str, field: str, source: str, at: str, level: bool) -> str:
    bad = f"isinf(x) OR x {'<= 0' if level else '< 0'}"
    far = (
        "(NOT bad AND b IS NOT NULL AND a IS NOT NULL AND least(abs(x / b - 1), abs(x / a - 1)) > 20 * scale)"
        if level
        else "(NOT bad AND x > 25 * scale)"
    )
    near = "" if not level else """,
  inside AS (SELECT s, t, list_median(list(x) OVER (PARTITION BY s ORDER BY t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) AS b,
                    list_median(list(x) OVER (PARTITION BY s ORDER BY t ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)) AS a
             FROM judged WHERE NOT bad)"""
    scale = "median(abs(x / p - 1)) FILTER (x <> p)" if level else "median(x) FILTER (x <> 0)"
    return f"""
SELECT '{table}' AS table_name, '{field}' AS field_name, load_seq FROM (
  WITH raw AS (SELECT {source} AS s, {at} AS t, load_seq, {field} AS x, coalesce({bad.replace("x ", field + " ").replace("(x)", f"({field})")}, false) AS bad FROM {table} WHERE {field} IS NOT NULL AND NOT isnan({field}) AND {at} IS NOT NULL),
  judged AS (SELECT s, t, arg_min(x, load_seq) AS x, arg_min(bad, load_seq) AS bad FROM raw GROUP BY s, t),
  good AS (SELECT *, lag(x) OVER (PARTITION BY s ORDER BY t) AS p FROM judged WHERE NOT bad),
  scales AS (SELECT s, {scale} AS scale FROM good GROUP BY s),
  reps AS (SELECT *, coalesce(x = lag(x) OVER (PARTITION BY s ORDER BY t), false) AS rep FROM judged),
  runs AS (SELECT *, sum(CASE WHEN rep THEN 0 ELSE 1 END) OVER (PARTITION BY s ORDER BY t) AS run FROM reps),
  stuck AS (SELECT s, t, x AS jx, rep AND count(*) OVER (PARTITION BY s, run) >= 8 AND avg(CASE WHEN rep THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY s) < 0.2 AS stuck FROM runs){near}
  SELECT load_seq FROM raw JOIN stuck USING (s, t) LEFT JOIN scales USING (s){" LEFT JOIN inside USING (s, t)" if level else ""}
  WHERE x = jx AND (bad OR coalesce({far}, false) OR stuck))"""


# The ways a NAV date is written, for DuckDB.
_NAV_DAY = """coalesce(
  CASE WHEN regexp_full_match(d, '[0-9]{13}') THEN CAST((CAST(d AS BIGINT) * 1000 + 19800000000) // 86400000000 AS INTEGER) + DATE '1970-01-01' END,
  CASE WHEN d LIKE '%T%' AND regexp_matches(d, '^[0-9]{4}-') THEN CAST((epoch_us(TRY_CAST(d AS TIMESTAMPTZ)) + 19800000000) // 86400000000 AS INTEGER) + DATE '1970-01-01' END,
  CASE WHEN regexp_matches(d, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') AND d NOT LIKE '%T%' THEN TRY_CAST(d[1:10] AS DATE) END,
  CAST(try_strptime(d, ['%d-%m-%Y', '%d/%m/%Y', '%d-%b-%Y', '%d %b %Y', '%d %B %Y']) AS DATE),
  CASE WHEN regexp_full_match(d, '[0-9]{8}') THEN CAST(try_strptime(d, '%Y%m%d') AS DATE) END)"""

P1_KINDS = """
WITH r AS (SELECT feed_id, file_no, payload, unnest(json_keys(payload)) AS field FROM screener_files WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
k AS (SELECT feed_id, file_no, field, json_type(payload, '$."' || field || '"') AS t FROM r)
SELECT feed_id, file_no, field, CASE t WHEN 'VARCHAR' THEN 'text' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind, count(*) AS n
FROM k WHERE t <> 'NULL' GROUP BY ALL"""
P2_NAV_DATES = f"SELECT load_seq, strftime({_NAV_DAY}, '%Y-%m-%d') AS day FROM (SELECT load_seq, trim(nav_date) AS d FROM nav_history)"

P3_FOUND = (
    f"WITH nav_history AS (SELECT load_seq, scheme_code, nav, {_NAV_DAY} AS day FROM (SELECT load_seq, scheme_code, nav, trim(nav_date) AS d FROM nav_history))\n"
    + "\nUNION ALL\n".join([
        _p3("hourly_prices", "close", "(symbol, feed_id)", "timestamp", True),
        _p3("hourly_prices", "volume", "(symbol, feed_id)", "timestamp", False),
        _p3("nav_history", "nav", "scheme_code", "day", True),
    ])
)

P4_FOUND = """
WITH v AS (SELECT * FROM market_returns WHERE day_return IS NOT NULL AND NOT isnan(day_return) AND series_name IN ('nifty', 'usdinr', 'nasdaq'))
SELECT event_id,
       CASE series_name WHEN 'nifty' THEN 'nifty_day_return' WHEN 'usdinr' THEN 'usdinr_day_return' ELSE 'nasdaq_overnight_return' END AS field_name,
       arg_max(obs_id, (trade_date, known_at, obs_id)) AS obs_id
FROM gap_vector JOIN v ON known_at <= event_time
GROUP BY event_id, series_name
"""


def _rolled(table: str, measures: tuple[str, ...]) -> str:
    parts = []
    for m in measures:
        parts.append(f"""
SELECT '{m}' AS measure, symbol, feed_id, strftime(day, '%Y-%m-%d') AS for_day,
       CAST(coalesce(sum(n) OVER w7, 0) AS BIGINT) AS n_7d, CAST(coalesce(sum(s) OVER w7, 0) AS BIGINT) AS total_7d,
       CAST(coalesce(sum(n) OVER w30, 0) AS BIGINT) AS n_30d, CAST(coalesce(sum(s) OVER w30, 0) AS BIGINT) AS total_30d
FROM (
  SELECT c.symbol, c.feed_id, c.day, a.n, a.s
  FROM (SELECT symbol, feed_id, CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM {table}_days GROUP BY symbol, feed_id) c
  LEFT JOIN (SELECT symbol, feed_id, day, count({m}) AS n, sum(CAST(round({m} * 1000000) AS BIGINT)) AS s FROM {table}_days GROUP BY ALL) a
    ON a.symbol = c.symbol AND a.feed_id = c.feed_id AND a.day = c.day)
WINDOW w7 AS (PARTITION BY symbol, feed_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY symbol, feed_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
    return "\nUNION ALL\n".join(parts)


def _settled(table: str, measures: tuple[str, ...]) -> str:
    cols = ", ".join(f"CASE WHEN isnan({m}) THEN NULL ELSE {m} END AS {m}" for m in measures)
    return f"""{table}_days AS (
  SELECT symbol, feed_id, CAST(epoch_us(timestamp) // 86400000000 AS INTEGER) + DATE '1970-01-01' AS day, {cols}
  FROM {table}
  QUALIFY row_number() OVER (PARTITION BY symbol, feed_id, timestamp ORDER BY ingested_at DESC, load_seq DESC) = 1)"""


_PRICES, _FEATURES = ("fall_probability", "fall_q10"), ("ret_20d", "vol_20d")
P5_FOUND = f"WITH {_settled('hourly_prices', _PRICES)}, {_settled('features', _FEATURES)}\n{_rolled('hourly_prices', _PRICES)}\nUNION ALL\n{_rolled('features', _FEATURES)}"
P5_AVERAGES = f"""
SELECT measure, symbol, feed_id, for_day,
       round(total_7d / nullif(n_7d * 1000000, 0), 9) AS avg_7d, round(total_30d / nullif(n_30d * 1000000, 0), 9) AS avg_30d
FROM ({P5_FOUND})
"""

_ALIASES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in METRIC_ALIASES.items()) + "}"
_WS = r"[\s\x0B\x1C-\x1F\x85\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
P6_CELLS = rf"""
WITH a AS (
  SELECT table_name, upper(trim(symbol)) AS symbol, load_seq, ingested_at,
         upper(trim(regexp_replace(financial_period, '{_WS}+', ' ', 'g'))) AS p,
         lower(trim(regexp_replace(replace(metric_label, '+', ''), '{_WS}+', ' ', 'g'))) AS k,
         regexp_replace(translate(metric_text, '−–—,', '---'), '{_WS}+|%', '', 'g') AS n
  FROM screener_facts),
b AS (
  SELECT table_name, symbol, load_seq, ingested_at,
         CASE WHEN p = 'TTM' THEN 'TTM'
              WHEN regexp_full_match(p, '(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)[A-Z]*[ -]([0-9]{{4}}|[0-9]{{2}})')
                THEN p[1] || lower(p[2:3]) || ' ' || CASE WHEN regexp_matches(p, '[0-9]{{4}}$') THEN right(p, 4) ELSE '20' || right(p, 2) END
              WHEN regexp_full_match(p, '[0-9]{{4}}-(0[1-9]|1[0-2])')
                THEN ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][CAST(right(p, 2) AS INTEGER)] || ' ' || left(p, 4)
         END AS financial_period,
         coalesce(element_at({_ALIASES}, k)[1], coalesce(nullif(trim(regexp_replace(k, '[^a-z0-9]+', '_', 'g'), '_'), ''), 'metric')) AS metric,
         CAST(round(TRY_CAST(CASE WHEN n LIKE '(%)' THEN '-' || n[2:-2] ELSE ltrim(n, '+') END AS DECIMAL(30, 8)) * 100) AS BIGINT) AS hundredths
  FROM a WHERE k IS NOT NULL),
cells AS (
  SELECT table_name, symbol, financial_period, metric, arg_max(hundredths, (ingested_at, load_seq)) AS hundredths
  FROM b WHERE hundredths IS NOT NULL AND financial_period IS NOT NULL AND symbol <> '' GROUP BY ALL)
"""
P6_FOUND = P6_CELLS + "SELECT * FROM cells"
P6_SPREAD = P6_CELLS + "SELECT metric, count(*) AS cells, CAST(sum(hundredths) AS BIGINT) AS total FROM cells GROUP BY metric"
