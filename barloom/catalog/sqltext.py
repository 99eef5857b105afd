"""Reusable common table expressions for the SQL counterparts (DuckDB dialect).

Written independently of the DataFrame operators: ordered lists and ordered
aggregates where Spark uses packed keys, row_number where Spark aggregates.
"""

from __future__ import annotations

AS_OF = "2024-01-31"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def _closure(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for n in names:
        needs, _ = CTES[n]
        _closure(needs, seen)
        if n not in seen:
            seen.append(n)
    return seen


def query(body: str, *needs: str) -> str:
    """``WITH`` the named expressions and everything they build on."""
    parts = [f"{n} AS ({CTES[n][1]})" for n in _closure(needs, [])]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


def rounded(source: str, doubles: str, *needs: str, cols: str = "*", where: str = "") -> str:
    """All of ``source`` (or ``cols``) with the listed double columns nudged and rounded to 6 places."""
    wanted = doubles.split()
    if cols == "*":
        repl = ", ".join(f"ROUND({d} + 1e-9::DOUBLE, 6) AS {d}" for d in wanted)
        select = f"* REPLACE ({repl})" if wanted else "*"
    else:
        names = [c.strip() for c in cols.split(",")]
        select = ", ".join(f"ROUND({c} + 1e-9::DOUBLE, 6) AS {c}" if c in wanted else c for c in names)
    tail = f" WHERE {where}" if where else ""
    return query(f"SELECT {select} FROM {source}{tail}", *needs)


cte("event_prices", """
  SELECT event_id, user_id + 1 AS item_id, ts,
    CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 211 = 0 THEN 0
         ELSE CAST(FLOOR(value * 100) + 1000 AS BIGINT) END AS high,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 211 = 0 THEN 0
         WHEN event_id % 97 = 0 THEN -1 ELSE CAST(FLOOR(value * 95) + 900 AS BIGINT) END AS low,
    CASE WHEN event_type = 'view' THEN NULL
         ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS hv,
    CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_id % 40 END AS lv,
    ts + INTERVAL '1' HOUR * CAST(event_id % 5 AS INT) AS ing
  FROM events""")
cte("prices", """
  SELECT event_id, item_id, ts, high, low, hv, lv, ing FROM event_prices
  UNION ALL
  SELECT event_id, item_id, ts, high + 7, low, hv, lv, ing + INTERVAL '1' DAY
  FROM event_prices WHERE event_id % 20 = 0""", "event_prices")
cte("items", """
  SELECT p_partkey + 1 AS id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name, p_type AS examine,
    (p_size % 2 = 0) AS members,
    CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(FLOOR(p_retailprice * 0.4) AS BIGINT) END AS lowalch,
    CASE WHEN p_size % 11 = 0 THEN 0 ELSE CAST(FLOOR(p_retailprice * 0.6) AS BIGINT) END AS highalch,
    CAST(p_size AS BIGINT) * 500 AS buy_limit
  FROM part""")
cte("item_attrs", """
  SELECT id AS item_id, name, examine, members, lowalch AS low_alch_value, highalch AS high_alch_value,
    buy_limit AS trade_limit,
    IF(members IS TRUE, 'Members', 'Free-to-Play') AS membership_type,
    IF(highalch > 0, highalch - lowalch, NULL) AS alch_profit_potential,
    CASE WHEN lower(name) LIKE '%ring%' THEN 'Rings' WHEN lower(name) LIKE '%bolt%' THEN 'Bolts'
         WHEN lower(name) LIKE '%gear%' OR lower(name) LIKE '%widget%' THEN 'Parts'
         ELSE 'Other' END AS item_category
  FROM items""", "items")
cte("cleaned", """
  SELECT item_id, ts, IF(high < 0, NULL, high) AS ph, IF(low < 0, NULL, low) AS pl,
    IF(greatest(coalesce(hv, -1), coalesce(lv, -1)) >= 0, coalesce(hv, 0) + coalesce(lv, 0), NULL) AS volume,
    ing AS load_ts
  FROM prices""", "prices")
cte("silver", """
  SELECT item_id, ts, ph, pl, volume, load_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id, ts
      ORDER BY load_ts DESC, ph DESC NULLS LAST, pl DESC NULLS LAST, volume DESC NULLS LAST) AS pick
    FROM cleaned) WHERE pick = 1""", "cleaned")
cte("silver_named", """
  SELECT item_id, ts, ph AS price_high, pl AS price_low, ph AS price_avg_high, pl AS price_avg_low, volume,
    'price_api' AS source, load_ts FROM silver""", "silver")
cte("opens", """
  SELECT item_id, CAST(ts AS DATE) AS price_date, list(high ORDER BY ts, high) AS path
  FROM prices WHERE high IS NOT NULL GROUP BY ALL""", "prices")
cte("ranges", """
  SELECT item_id, CAST(ts AS DATE) AS price_date, max(high) AS high_price, min(low) AS low_price,
    avg(high) AS avg_price, CAST(sum(coalesce(hv, 0) + coalesce(lv, 0)) AS BIGINT) AS total_volume,
    count(*) AS data_points, min(ts) AS first_timestamp, max(ts) AS last_timestamp
  FROM prices WHERE high IS NOT NULL AND low IS NOT NULL GROUP BY ALL""", "prices")
cte("bars", """
  SELECT r.*, path[1] AS open_price, path[-1] AS close_price
  FROM ranges r JOIN opens o USING (item_id, price_date)""", "ranges", "opens")
cte("bars_ind", """
  SELECT price_date, item_id, high_price, low_price, avg_price, total_volume, data_points, first_timestamp,
    last_timestamp, open_price, close_price,
    close_price - lag(close_price) OVER s AS price_change,
    avg(close_price) OVER s7 AS ma_7d, stddev_samp(close_price) OVER s7 AS volatility_7d
  FROM bars
  WINDOW s AS (PARTITION BY item_id ORDER BY price_date),
    s7 AS (PARTITION BY item_id ORDER BY price_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", "bars")
cte("day_obs", """
  SELECT item_id, CAST(ts AS DATE) AS date, min(pl) AS min_price, max(ph) AS max_price,
    CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS observation_count,
    last(ph ORDER BY ts) AS latest_price_high, last(pl ORDER BY ts) AS latest_price_low
  FROM silver GROUP BY ALL""", "silver")
cte("day_price", """
  SELECT *, (latest_price_high + latest_price_low) / 2.0::DOUBLE AS latest_price,
    IF(latest_price_high + latest_price_low > 0,
       2.0::DOUBLE * (latest_price_high - latest_price_low) / (latest_price_high + latest_price_low), NULL)
      AS volatility_proxy
  FROM day_obs""", "day_obs")
cte("day_return", """
  SELECT *, avg(latest_price) OVER (PARTITION BY item_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
      AS price_7d_ma,
    latest_price / nullif(lag(latest_price) OVER (PARTITION BY item_id ORDER BY date), 0) - 1.0 AS daily_return
  FROM day_price""", "day_price")
cte("return_stats", """
  SELECT item_id, avg(daily_return) AS mu, nullif(stddev_samp(daily_return), 0) AS sigma
  FROM day_return GROUP BY item_id""", "day_return")
cte("day_scored", """
  SELECT d.*, abs((daily_return - mu) / sigma) AS return_zscore
  FROM day_return d JOIN return_stats USING (item_id)""", "day_return", "return_stats")
cte("features", """
  SELECT item_id, date, latest_price, latest_price_high, latest_price_low, price_7d_ma, daily_return,
    volatility_proxy,
    coalesce(return_zscore > 2.5, FALSE) OR coalesce(volatility_proxy > 0.5, FALSE) AS is_outlier,
    total_volume, observation_count, min_price, max_price
  FROM day_scored""", "day_scored")
cte("metrics", f"""
  SELECT m.item_id, name, item_category, membership_type, trading_days_30d, avg_price_30d, price_volatility_30d,
    min_price_30d, max_price_30d, avg_volume_30d, total_volume_30d, path[-1] AS latest_price, latest_date,
    (path[-1] - path[1]) / nullif(path[1], 0) * 100.0 AS price_change_pct_30d,
    CASE WHEN trading_days_30d < 10 THEN 'Low' WHEN trading_days_30d < 20 THEN 'Medium' ELSE 'High' END
      AS data_quality,
    trading_days_30d >= 15 AND avg_volume_30d > 100 AS suitable_for_forecasting
  FROM (SELECT item_id, count(*) AS trading_days_30d, avg(close_price) AS avg_price_30d,
      stddev_samp(close_price) AS price_volatility_30d, min(close_price) AS min_price_30d,
      max(close_price) AS max_price_30d, avg(total_volume) AS avg_volume_30d,
      CAST(sum(total_volume) AS BIGINT) AS total_volume_30d, list(close_price ORDER BY price_date) AS path,
      max(price_date) AS latest_date
    FROM bars WHERE price_date >= DATE '{AS_OF}' - 30 GROUP BY item_id) m
  JOIN item_attrs USING (item_id)""", "bars", "item_attrs")
cte("model_features", """
  SELECT price_date, item_id, close_price, nxt AS target_price_1d, p1 AS price_lag_1d, p2 AS price_lag_2d,
    p3 AS price_lag_3d, p7 AS price_lag_7d, ma_7d, ma_14d, close_price / nullif(ma_7d, 0) AS price_to_ma7_ratio,
    total_volume, v1 AS volume_lag_1d, volume_ma_7d, volatility_7d,
    100.0 * volatility_7d / nullif(close_price, 0) AS volatility_pct,
    (close_price - p3)::DOUBLE / nullif(p3, 0) AS momentum_3d,
    sin(pi() * 2 * dayofweek(price_date) / 7) AS day_of_week_sin,
    cos(pi() * 2 * dayofweek(price_date) / 7) AS day_of_week_cos,
    p1::DOUBLE * v1 AS price_volume_interaction,
    CASE WHEN close_price > 1.05 * ma_7d AND ma_7d <> 0 THEN 'Strong_Up'
         WHEN close_price > 1.02 * ma_7d AND ma_7d <> 0 THEN 'Mild_Up'
         WHEN close_price < 0.95 * ma_7d AND ma_7d <> 0 THEN 'Strong_Down'
         WHEN close_price < 0.98 * ma_7d AND ma_7d <> 0 THEN 'Mild_Down' ELSE 'Neutral' END AS trend_signal
  FROM (SELECT *, lead(close_price) OVER s AS nxt, lag(close_price, 1) OVER s AS p1, lag(close_price, 2) OVER s AS p2,
      lag(close_price, 3) OVER s AS p3, lag(close_price, 7) OVER s AS p7, lag(total_volume) OVER s AS v1,
      avg(close_price) OVER (s ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS ma_14d,
      avg(total_volume) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volume_ma_7d
    FROM bars_ind WINDOW s AS (PARTITION BY item_id ORDER BY price_date))
  WHERE p1 IS NOT NULL AND nxt IS NOT NULL""", "bars_ind")

# ---- selection -----------------------------------------------------------------
cte("stats", f"""
  SELECT s.item_id, i.name, median_units_per_day, avg_units_per_day, total_units, median_price, days_with_data,
    30 AS total_possible_days, days_with_data / 30.0::DOUBLE * 100 AS coverage_pct, avg_price, price_volatility,
    avg_obs_per_day, last_trade_date, median_units_per_day * median_price AS median_turnover_gp,
    log10(1 + median_units_per_day) * (days_with_data / 30.0::DOUBLE) AS ranking_score
  FROM (SELECT item_id, quantile_cont(units, 0.5) AS median_units_per_day, avg(units) AS avg_units_per_day,
      sum(units) AS total_units, quantile_cont(price, 0.5) AS median_price, count(*) AS days_with_data,
      avg(price) AS avg_price, stddev_samp(price) AS price_volatility, avg(obs) AS avg_obs_per_day,
      max(day) AS last_trade_date
    FROM (SELECT item_id, CAST(ts AS DATE) AS day, sum(volume)::DOUBLE AS units, count(*) AS obs,
        avg((ph + pl) / 2.0::DOUBLE) AS price
      FROM silver WHERE volume > 0 AND ts >= TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL '30' DAY GROUP BY ALL)
    GROUP BY item_id) s
  JOIN items i ON i.id = s.item_id WHERE days_with_data >= 5""", "silver", "items")
cte("manual_ids", """
  SELECT 4::BIGINT AS item_id UNION SELECT 5 UNION
  SELECT id FROM items WHERE name IN ('old ring 90', 'no such thing')""", "items")
cte("excluded_ids", """
  SELECT 76::BIGINT AS item_id UNION SELECT id FROM items WHERE name = 'cold gizmo 89'""", "items")
cte("gated", """
  SELECT s.*, m.item_id IS NOT NULL AS by_hand
  FROM stats s LEFT JOIN manual_ids m USING (item_id)
  WHERE s.item_id NOT IN (SELECT item_id FROM excluded_ids) AND days_with_data >= 24 AND coverage_pct >= 85""",
    "stats", "manual_ids", "excluded_ids")
cte("auto_pick", """
  SELECT item_id FROM gated WHERE median_units_per_day >= 120 ORDER BY ranking_score DESC, item_id LIMIT 10""", "gated")


def selected(condition: str) -> str:
    return f"""
  SELECT item_id AS id, name, median_units_per_day, median_price, median_turnover_gp, coverage_pct AS coverage,
    days_with_data, avg_price, ranking_score, last_trade_date,
    IF(by_hand, 'manual_include', 'auto_selected') AS selection_reason
  FROM gated WHERE {condition}"""


IN_AUTO = "item_id IN (SELECT item_id FROM auto_pick)"
cte("pick_auto", selected(IN_AUTO), "gated", "auto_pick")
cte("pick_hybrid", selected(f"{IN_AUTO} OR (by_hand AND median_units_per_day >= 120)"), "gated", "auto_pick")
cte("pick_force", selected(f"{IN_AUTO} OR by_hand"), "gated", "auto_pick")
cte("pick_manual", selected("by_hand"), "gated")
cte("discovered", """
  SELECT id AS item_id, buy_limit FROM items WHERE buy_limit >= 10000 ORDER BY buy_limit DESC, id LIMIT 10""", "items")

# ---- daily series and walk-forward splits --------------------------------------------
cte("supplier_days", """
  SELECT l_suppkey AS item_id, CAST(l_shipdate AS DATE) AS date, 
    sum(CAST(round(l_extendedprice * 100) AS BIGINT))::DOUBLE / (sum(l_quantity) * 100.0::DOUBLE) AS price
  FROM lineitem GROUP BY ALL""")
cte("series", """
  SELECT item_id, date, latest_price AS price FROM features
  UNION ALL SELECT item_id, price_date, close_price FROM bars
  WHERE item_id NOT IN (SELECT item_id FROM features)""", "features", "bars")
cte("feature_series", "SELECT item_id, price_date AS date, close_price::DOUBLE AS price FROM model_features", "model_features")


def split_ctes(tag: str, source: str, train: int, horizon: int, max_splits: int | None = None, expanding: bool = False,
               latest: bool = False) -> None:
    """``<tag>_splits``: numbered origins; ``<tag>_scores``: both flat forecasters with errors."""
    reach = 7 if expanding else min(7, train)
    start = "min(date) OVER (PARTITION BY item_id)" if expanding else f"lag(date, {train}) OVER s"
    size = "rn - 1" if expanding else str(train)
    actuals = ", ".join(f"lead(price, {j}) OVER s AS y{j}" for j in range(horizon))
    cte(f"{tag}_numbered", f"""
  SELECT *, row_number() OVER s AS rn, count(*) OVER (PARTITION BY item_id) AS n, lag(price) OVER s AS last_value,
    avg(price) OVER (s ROWS BETWEEN {reach} PRECEDING AND 1 PRECEDING) AS moving_average,
    lag(date) OVER s AS train_end, {start} AS train_start, lead(date, {horizon - 1}) OVER s AS test_end, {actuals}
  FROM {source} WINDOW s AS (PARTITION BY item_id ORDER BY date)""", source)
    first = f"greatest(n - {horizon} + 1 - {max_splits}, {train})" if latest else f"{train}"
    most = f" AND rn - {first} <= {max_splits}" if max_splits else ""
    cte(f"{tag}_splits", f"""
  SELECT *, CAST(rn - {first} AS INTEGER) AS split, CAST({size} AS INTEGER) AS train_size FROM {tag}_numbered
  WHERE rn > {first} AND rn <= n - {horizon} + 1{most}""", f"{tag}_numbered")
    y = [f"y{j}" for j in range(horizon)]
    err = " + ".join(f"abs({c} - p)" for c in y)
    sm = " + ".join(f"abs({c} - p) / IF(abs({c}) + abs(p) = 0, 1e-8::DOUBLE, (abs({c}) + abs(p)) / 2.0::DOUBLE)" for c in y)
    cte(f"{tag}_scores", f"""
  SELECT item_id, date, split, method, ({err}) / {horizon}.0::DOUBLE AS mae, ({sm}) / {horizon}.0::DOUBLE * 100.0::DOUBLE AS smape,
    y0 AS actual, p AS predicted, {horizon} AS horizon, {train} AS window_size
  FROM (SELECT *, 'last_value' AS method, last_value AS p FROM {tag}_splits
        UNION ALL SELECT *, 'moving_average', moving_average FROM {tag}_splits)""", f"{tag}_splits")


split_ctes("roll", "supplier_days", 28, 1)
split_ctes("head", "supplier_days", 28, 1, 50)
split_ctes("tail", "supplier_days", 28, 1, 50, latest=True)
split_ctes("grow", "supplier_days", 14, 1, expanding=True)
split_ctes("sprout", "supplier_days", 14, 1, 30, expanding=True)
split_ctes("short", "series", 10, 1)
split_ctes("three", "series", 10, 3)
split_ctes("feat", "feature_series", 14, 1, expanding=True)
cte("item_results", """
  SELECT item_id, method, count(*) AS n_splits, count(mae) AS n_predictions, avg(mae) AS mae, avg(smape) AS smape,
    stddev_pop(mae) AS mae_std, stddev_pop(smape) AS smape_std
  FROM feat_scores GROUP BY item_id, method HAVING count(mae) > 0""", "feat_scores")
cte("run_stats", """
  SELECT item_id, method, count(*) AS n_forecasts, avg(mae) AS mean_mae, quantile_cont(mae, 0.5) AS median_mae,
    stddev_pop(mae) AS std_mae, avg(smape) AS mean_smape, quantile_cont(smape, 0.5) AS median_smape,
    stddev_pop(smape) AS std_smape
  FROM short_scores WHERE mae IS NOT NULL GROUP BY item_id, method""", "short_scores")
cte("board", f"""
  SELECT item_id, name, method, smape, mae, n FROM (
    SELECT item_id, method, avg(smape) AS smape, avg(mae) AS mae, count(*) AS n,
      row_number() OVER (PARTITION BY item_id ORDER BY avg(smape), avg(mae), method) AS place
    FROM short_scores WHERE mae IS NOT NULL AND date >= DATE '{AS_OF}' - 30 GROUP BY item_id, method)
  JOIN items ON id = item_id WHERE place = 1""", "short_scores", "items")
cte("early_prices", "SELECT * FROM prices WHERE ing < TIMESTAMP '2024-01-20 00:00:00'", "prices")
cte("holt_input", """
  SELECT item_id, price, row_number() OVER (PARTITION BY item_id ORDER BY date) AS rn,
    count(*) OVER (PARTITION BY item_id) AS n, lead(price) OVER (PARTITION BY item_id ORDER BY date) AS nxt
  FROM supplier_days""", "supplier_days")
cte("holt", """
  SELECT item_id, rn, n, price AS level, nxt - price AS trend FROM holt_input WHERE rn = 1 AND n >= 2
  UNION ALL
  SELECT i.item_id, i.rn, i.n, 0.6::DOUBLE * (level + trend) + 0.4::DOUBLE * price,
    0.92::DOUBLE * trend + 0.08::DOUBLE * (price - level)
  FROM holt h JOIN holt_input i ON i.item_id = h.item_id AND i.rn = h.rn + 1""", "holt_input")
cte("early_silver", "SELECT * FROM silver WHERE CAST(ts AS DATE) <= DATE '2024-01-20'", "silver")
cte("late_clean", """
  SELECT * FROM cleaned WHERE load_ts > (SELECT max(ing) FROM early_prices)""", "cleaned", "early_prices")
cte("late_silver", """
  SELECT item_id, ts, ph AS price_high, pl AS price_low, ph AS price_avg_high, pl AS price_avg_low, volume,
    'price_api' AS source, load_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id, ts ORDER BY load_ts DESC, ph DESC NULLS LAST,
    pl DESC NULLS LAST, volume DESC NULLS LAST) AS pick FROM late_clean) WHERE pick = 1""", "late_clean")
cte("restart_obs", """
  SELECT * REPLACE (CAST(NULL AS DOUBLE) AS price_7d_ma, CAST(NULL AS DOUBLE) AS daily_return),
    lag(latest_price) OVER s AS before, avg(latest_price) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma
  FROM day_return WHERE date > DATE '2024-01-20' WINDOW s AS (PARTITION BY item_id ORDER BY date)""", "day_return")
cte("restart_features", """
  SELECT item_id, date, latest_price, latest_price_high, latest_price_low, ma AS price_7d_ma, ret AS daily_return,
    volatility_proxy,
    coalesce(abs((ret - avg(ret) OVER (PARTITION BY item_id)) / nullif(stddev_samp(ret) OVER (PARTITION BY item_id), 0)) > 2.5,
             FALSE) OR coalesce(volatility_proxy > 0.5, FALSE) AS is_outlier,
    total_volume, observation_count, min_price, max_price
  FROM (SELECT *, latest_price / nullif(before, 0) - 1.0 AS ret FROM restart_obs)""", "restart_obs")
cte("tail_board", """
  SELECT item_id, name, method, smape, mae, n FROM (
    SELECT item_id, method, avg(smape) AS smape, avg(mae) AS mae, count(*) AS n,
      row_number() OVER (PARTITION BY item_id ORDER BY avg(smape), avg(mae), method) AS place
    FROM short_scores WHERE mae IS NOT NULL AND date >= DATE '2024-01-01' GROUP BY item_id, method)
  JOIN items ON id = item_id WHERE place = 1""", "short_scores", "items")
cte("batched", """
  SELECT item_id, ts, CAST(ts AS DATE) AS day, IF(high < 0, NULL, high) AS ph, IF(low < 0, NULL, low) AS pl,
    IF(greatest(coalesce(hv, -1), coalesce(lv, -1)) >= 0, coalesce(hv, 0) + coalesce(lv, 0), NULL) AS volume, ing AS load_ts,
    least(3, floor(date_diff('day', lo, CAST(ts AS DATE)) * 4 / (date_diff('day', lo, hi) + 1)) + IF(event_id % 7 = 0, 1, 0)) AS part
  FROM prices, (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events)""", "prices")
cte("accepted", """
  SELECT * EXCLUDE (pick) FROM (
    SELECT b.*, row_number() OVER (PARTITION BY item_id, ts ORDER BY load_ts DESC, ph DESC NULLS LAST, pl DESC NULLS LAST,
      volume DESC NULLS LAST) AS pick
    FROM batched b WHERE day > coalesce((SELECT max(day) FROM batched e WHERE e.item_id = b.item_id AND e.part < b.part),
      DATE '1900-01-01')) WHERE pick = 1""", "batched")
cte("frozen_obs", """
  SELECT item_id, day AS date, part, min(pl) AS min_price, max(ph) AS max_price, CAST(sum(volume) AS BIGINT) AS total_volume,
    count(*) AS observation_count, last(ph ORDER BY ts) AS latest_price_high, last(pl ORDER BY ts) AS latest_price_low
  FROM accepted GROUP BY ALL""", "accepted")
cte("frozen_paths", """
  SELECT *, avg(latest_price) OVER (PARTITION BY item_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS price_7d_ma,
    latest_price / nullif(lag(latest_price) OVER (PARTITION BY item_id ORDER BY date), 0) - 1.0 AS daily_return
  FROM (SELECT *, (latest_price_high + latest_price_low) / 2.0::DOUBLE AS latest_price,
      IF(latest_price_high + latest_price_low > 0,
        2.0::DOUBLE * (latest_price_high - latest_price_low) / (latest_price_high + latest_price_low), NULL) AS volatility_proxy
    FROM frozen_obs)""", "frozen_obs")
cte("frozen_features", """
  SELECT item_id, date, latest_price, latest_price_high, latest_price_low, price_7d_ma, daily_return, volatility_proxy,
    coalesce(abs((daily_return - avg(daily_return) OVER s) / nullif(stddev_samp(daily_return) OVER s, 0)) > 2.5, FALSE)
      OR coalesce(volatility_proxy > 0.5, FALSE) AS is_outlier,
    total_volume, observation_count, min_price, max_price
  FROM frozen_paths
  WINDOW s AS (PARTITION BY item_id ORDER BY part RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "frozen_paths")


# ---- fitted smoothing -------------------------------------------------------------------
# The squared error of a window under given parameters, with the best start state, is a quadratic form z'Qz: the grid is
# searched with one matrix per candidate. Parameters are whole numbers of 1/1280, the last step of the refinement.
UNIT = 1280.0
ETS_SCORES = """
  SELECT item_id, date, 'ets' AS method, abs(actual - p) AS mae,
    200.0::DOUBLE * abs(actual - p) / IF(abs(actual) + abs(p) = 0, 2e-8::DOUBLE, abs(actual) + abs(p)) AS smape,
    actual, p AS predicted, 1 AS horizon, 28 AS window_size
  FROM (SELECT item_id, date, actual, centre + scale * (lev + sl) AS p FROM {end})"""


def ets_ctes(tag: str, trend: bool, max_splits: int | None) -> None:
    """``<tag>_ets``: scores of the fitted smoother over windows of 28 days of ``supplier_days``."""
    most = f"AND rn <= 28 + {max_splits}" if max_splits else ""
    cte(f"{tag}_win", f"""
  SELECT row_number() OVER () AS k, item_id, date, actual, centre, scale, list_transform(w, lambda x: (x - centre) / scale) AS z
  FROM (SELECT *, coalesce(nullif(list_max(list_transform(w, lambda x: abs(x - centre))), 0), 1.0::DOUBLE) AS scale
    FROM (SELECT *, list_avg(w) AS centre
      FROM (SELECT item_id, date, price AS actual, row_number() OVER s AS rn,
          list(price) OVER (s ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS w
        FROM supplier_days WINDOW s AS (PARTITION BY item_id ORDER BY date)) WHERE rn > 28 {most}))""", "supplier_days")
    cte(f"{tag}_par", f"""
  SELECT i, j, i / {UNIT}::DOUBLE AS a, (i / {UNIT}::DOUBLE) * (j / {UNIT}::DOUBLE) AS g
  FROM range(0, 1281, {64 if trend else 1}) AS x(i), range(0, {"1281, 64" if trend else "1"}) AS y(j) WHERE j <= i""")
    # errors after an impulse (h), after a start level (el) and a start slope (eb) of one
    cte(f"{tag}_resp", f"""
  SELECT i, j, a, g, 0 AS t, 1.0::DOUBLE AS h, a AS lev, g AS sl, -1.0::DOUBLE AS el, 1.0::DOUBLE - a AS ll, -g AS ls,
    -{int(trend)}.0::DOUBLE AS eb, ({int(trend)}.0::DOUBLE) * (1.0::DOUBLE - a) AS bl, {int(trend)}.0::DOUBLE * (1.0::DOUBLE - g) AS bs
  FROM {tag}_par
  UNION ALL
  SELECT i, j, a, g, t + 1, -(lev + sl), (lev + sl) * (1 - a), sl - g * (lev + sl), -(ll + ls), (ll + ls) * (1 - a), ls - g * (ll + ls),
    -(bl + bs), (bl + bs) * (1 - a), bs - g * (bl + bs)
  FROM {tag}_resp WHERE t < 27""", f"{tag}_par")
    cte(f"{tag}_gram", f"""
  SELECT i, j, sum(el * el) AS sll, sum(el * eb) AS slb, sum(eb * eb) AS sbb FROM {tag}_resp GROUP BY i, j""", f"{tag}_resp")
    cte(f"{tag}_hit", f"""
  SELECT e.i, e.j, e.t, e.t - q.t AS s, q.h, e.el, e.eb FROM {tag}_resp e JOIN {tag}_resp q ON q.i = e.i AND q.j = e.j AND q.t <= e.t""",
        f"{tag}_resp")
    cte(f"{tag}_lin", f"""
  SELECT i, j, s, sum(h * el) AS ul, sum(h * eb) AS ub FROM {tag}_hit GROUP BY i, j, s""", f"{tag}_hit")
    solve = ("(x.ul * y.ul * sbb - (x.ul * y.ub + x.ub * y.ul) * slb + x.ub * y.ub * sll) / (sll * sbb - slb * slb)" if trend
             else "x.ul * y.ul / sll")
    cte(f"{tag}_form", f"""
  SELECT i, j, list(q ORDER BY s, r) AS q FROM (
    SELECT b.i, b.j, b.s, b.r, both_ - {solve} AS q
    FROM (SELECT x.i, x.j, x.s, y.s AS r, sum(x.h * y.h) AS both_ FROM {tag}_hit x JOIN {tag}_hit y
          ON x.i = y.i AND x.j = y.j AND x.t = y.t GROUP BY ALL) b
    JOIN {tag}_lin x ON x.i = b.i AND x.j = b.j AND x.s = b.s JOIN {tag}_lin y ON y.i = b.i AND y.j = b.j AND y.s = b.r
    JOIN {tag}_gram m ON m.i = b.i AND m.j = b.j)
  GROUP BY i, j""", f"{tag}_hit", f"{tag}_lin", f"{tag}_gram")
    cte(f"{tag}_quad", f"""
  SELECT k, flatten(list_transform(z, lambda x: list_transform(z, lambda y: x * y))) AS zz FROM {tag}_win""", f"{tag}_win")
    cte(f"{tag}_s0", f"""
  SELECT k, unnest(min_by({{'i': i, 'j': j, 'e': e}}, (e, i, j))) FROM (
    SELECT k, i, j, list_dot_product(zz, q) AS e FROM {tag}_quad, {tag}_form WHERE i % 64 = 0) GROUP BY k""", f"{tag}_quad", f"{tag}_form")
    for n, step in enumerate((32, 16, 8, 4, 2, 1), start=1):
        moves = "(VALUES (-1), (0), (1))"
        cte(f"{tag}_n{n}", f"""
  SELECT k, e AS e0, i AS i0, j AS j0, o * 3 + u AS place, i1 AS i, least(greatest(j + {step} * u, 0), i1) AS j
  FROM (SELECT *, least(greatest(i + {step} * o, 0), 1280) AS i1 FROM {tag}_s{n - 1}, {moves} AS a(o), {moves if trend else "(VALUES (0))"} AS b(u))""",
            f"{tag}_s{n - 1}")
        if trend:
            sweep_cte(f"{tag}_e{n}", f"SELECT k, place, i, j FROM {tag}_n{n}", f"{tag}_win", f"{tag}_n{n}")
            found, join = f"{tag}_e{n}", f"{tag}_n{n} JOIN {tag}_e{n} f USING (k, place)"
        else:
            found, join = f"{tag}_quad", f"{tag}_n{n} JOIN {tag}_quad USING (k) JOIN {tag}_form USING (i)"
        error = "f.e" if trend else "list_dot_product(zz, q)"
        cte(f"{tag}_s{n}", f"""
  SELECT k, IF(b.e < e0, b.i, i0) AS i, IF(b.e < e0, b.j, j0) AS j, least(b.e, e0) AS e
  FROM (SELECT k, any_value(e0) AS e0, any_value(i0) AS i0, any_value(j0) AS j0,
      min_by({{'i': i, 'j': j, 'e': e}}, (e, place)) AS b
    FROM (SELECT k, e0, i0, j0, place, {tag}_n{n}.i, {tag}_n{n}.j, {error} AS e FROM {join}) GROUP BY k)""",
            f"{tag}_n{n}", found, *([] if trend else [f"{tag}_form"]))
    sweep_cte(f"{tag}_end", f"SELECT k, 0 AS place, i, j FROM {tag}_s6", f"{tag}_win", f"{tag}_s6", trend)
    cte(f"{tag}_ets", ETS_SCORES.format(end=f"{tag}_end JOIN {tag}_win USING (k)"), f"{tag}_end", f"{tag}_win")


def sweep_cte(name: str, cells: str, windows: str, needs: str, trend: bool = True) -> None:
    """Error ``e`` and end state (lev, sl) of every cell (k, place, i, j), value by value."""
    cte(f"{name}_path", f"""
  SELECT k, place, 0 AS t, z, i / {UNIT}::DOUBLE AS a, (i / {UNIT}::DOUBLE) * (j / {UNIT}::DOUBLE) AS g, 0.0::DOUBLE AS lev, 0.0::DOUBLE AS sl,
    1.0::DOUBLE AS ll, 0.0::DOUBLE AS ls, 0.0::DOUBLE AS bl, {int(trend)}.0::DOUBLE AS bs, 0.0::DOUBLE AS ee, 0.0::DOUBLE AS el, 0.0::DOUBLE AS eb,
    0.0::DOUBLE AS sll, 0.0::DOUBLE AS slb, 0.0::DOUBLE AS sbb
  FROM ({cells}) JOIN {windows} USING (k)
  UNION ALL
  SELECT k, place, t + 1, z, a, g, lev + sl + a * (z[t + 1] - lev - sl), sl + g * (z[t + 1] - lev - sl), (ll + ls) * (1 - a), ls - g * (ll + ls),
    (bl + bs) * (1 - a), bs - g * (bl + bs), ee + (z[t + 1] - lev - sl) * (z[t + 1] - lev - sl), el - (z[t + 1] - lev - sl) * (ll + ls),
    eb - (z[t + 1] - lev - sl) * (bl + bs), sll + (ll + ls) * (ll + ls), slb + (ll + ls) * (bl + bs), sbb + (bl + bs) * (bl + bs)
  FROM {name}_path WHERE t < 28""", windows, needs)
    l0 = "(eb * slb - el * sbb) / (sll * sbb - slb * slb)" if trend else "-el / sll"
    b0 = "(el * slb - eb * sll) / (sll * sbb - slb * slb)" if trend else "0.0::DOUBLE"
    cte(name, f"""
  SELECT k, place, ee + l0 * el + b0 * eb AS e, lev + l0 * ll + b0 * bl AS lev, sl + l0 * ls + b0 * bs AS sl
  FROM (SELECT *, {l0} AS l0, {b0} AS b0 FROM {name}_path WHERE t = 28)""", f"{name}_path")


ets_ctes("level", False, None)
ets_ctes("first", True, 50)
ets_ctes("whole", True, None)
