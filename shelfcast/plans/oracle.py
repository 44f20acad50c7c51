"""Reference SQL of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

SALES = """
    SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey AS order_id,
           concat(p_brand, '/', p_type) AS product_id, p_type AS category,
           CAST(l_quantity AS BIGINT) AS quantity,
           l_extendedprice * (1 - l_discount) / l_quantity AS price,
           CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS promotion,
           l_discount AS discount,
           concat('STORE_', CAST(l_suppkey % 5 + 1 AS VARCHAR)) AS store,
           r_name AS region,
           CASE WHEN month(l_shipdate) * 100 + day(l_shipdate) IN (101, 704, 1225)
                THEN 1 ELSE 0 END AS holiday
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey
"""

RAW = """
    SELECT order_id,
           CASE WHEN order_id % 2400 = 6 THEN '2001-13-40'
                WHEN order_id % 2400 = 7 THEN '2026-01-15'
                WHEN order_id % 4800 = 8 THEN NULL
                ELSE CAST(date AS VARCHAR) END AS date,
           product_id, category,
           CAST(CASE WHEN order_id % 500 = 1 THEN NULL
                     WHEN order_id % 2000 = 3 THEN -quantity - 1
                     ELSE quantity END AS DOUBLE) AS quantity,
           CASE WHEN order_id % 500 = 2 THEN NULL
                WHEN order_id % 2000 = 4 THEN -price ELSE price END AS price,
           promotion, discount, store, region, holiday
    FROM sales
"""

CLEAN = """
    SELECT order_id, date, product_id, category, CAST(quantity AS BIGINT) AS quantity,
           coalesce(price, median(price) OVER (PARTITION BY product_id)) AS price,
           promotion, discount, store, region, holiday
    FROM (SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM (SELECT DISTINCT * FROM raw))
    WHERE date <= (SELECT max(date) FROM sales) AND quantity >= 0 AND (price >= 0 OR price IS NULL)
"""

DAILY = """
    SELECT product_id, category, date, CAST(sum(quantity) AS DOUBLE) AS quantity,
           avg(price) AS price, CAST(max(promotion) AS DOUBLE) AS promotion,
           avg(discount) AS discount, CAST(max(holiday) AS DOUBLE) AS holiday
    FROM sales GROUP BY ALL
"""

SPINE = """
    SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
    FROM sales
"""

GRID = """
    SELECT p.product_id, d.category, s.date, d.quantity, d.price, d.promotion, d.discount, d.holiday,
           last_value(d.category IGNORE NULLS) OVER w AS known_category,
           last_value(d.price IGNORE NULLS) OVER w AS known_price
    FROM (SELECT DISTINCT product_id FROM daily) p CROSS JOIN spine s
    LEFT JOIN daily d ON d.product_id = p.product_id AND d.date = s.date
    WINDOW w AS (PARTITION BY p.product_id ORDER BY s.date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

PANEL = """
    SELECT product_id, known_category AS category, date, coalesce(quantity, 0) AS quantity,
           known_price AS price, coalesce(promotion, 0) AS promotion,
           coalesce(discount, 0) AS discount, coalesce(holiday, 0) AS holiday
    FROM grid
"""


def _history(value: str, series: str, means: tuple[int, ...], stds: tuple[int, ...]) -> str:
    frame = (
        f"(PARTITION BY {series} ORDER BY date ROWS BETWEEN {{n}} PRECEDING AND 1 PRECEDING)"
    )
    parts = [
        f"lag({value}, {n}) OVER (PARTITION BY {series} ORDER BY date) AS lag_{n}"
        for n in (1, 7, 14, 28)
    ]
    for name, function, widths in (("mean", "avg", means), ("std", "stddev_samp", stds)):
        for n in widths:
            over = frame.format(n=n)
            parts.append(
                f"CASE WHEN count({value}) OVER {over} = {n} THEN {function}({value}) OVER {over} "
                f"END AS rolling_{name}_{n}"
            )
    return ", ".join(parts)


FEATURES = f"""
    SELECT *, {_history("quantity", "product_id", (7, 14, 28), (7, 14, 28))},
           isodow(date) - 1 AS day_of_week, month(date) AS month, week(date) AS week_of_year,
           CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend
    FROM panel
"""

FEATURE_NAMES = (
    [f"lag_{n}" for n in (1, 7, 14, 28)]
    + [f"rolling_mean_{n}" for n in (7, 14, 28)]
    + [f"rolling_std_{n}" for n in (7, 14, 28)]
    + ["day_of_week", "month", "week_of_year", "is_weekend"]
    + ["price", "promotion", "discount", "holiday"]
)

MODEL = "SELECT * FROM features WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)

HOLDOUT = """
    SELECT *, lag_7 AS prediction FROM model WHERE date > (SELECT max(date) FROM sales) - 60
"""

ERRORS = """
    SELECT *, quantity AS y_true, prediction AS y_pred, quantity - prediction AS error,
           abs(quantity - prediction) AS absolute_error,
           (quantity - prediction) * (quantity - prediction) AS squared_error
    FROM holdout
"""

OOF = """
    SELECT product_id, category, date, quantity, lag_7 AS prediction, quantity - lag_7 AS error,
           abs(quantity - lag_7) AS abs_error,
           4 - CAST(floor((m - 60 - date) / 60) AS INTEGER) AS fold
    FROM model, (SELECT max(date) AS m FROM sales)
    WHERE date <= m - 60 AND date > m - 300
"""

MONITORED = """
    SELECT product_id AS id, date, quantity AS demand, price, discount, promotion, holiday,
           lag_1, lag_7, lag_14, lag_28,
           CASE WHEN date > (SELECT max(date) FROM sales) - 28 THEN 1 ELSE 0 END AS is_final_test
    FROM features
"""

# The seasonal forecast repeats the last week before a window of 28 days.
NAIVE_STEPS = """
    SELECT f.id, f.date, f.demand, greatest(h.demand, 0) AS prediction
    FROM {source} f, {source} h, (SELECT max(date) AS m FROM {source})
    WHERE f.date > m - {horizon} AND h.id = f.id
      AND h.date = m - {horizon} - 6 + CAST((f.date - (m - {horizon}) - 1) % 7 AS INTEGER)"""

PREDICTIONS = f"SELECT *, 'Seasonal Naive' AS model FROM ({NAIVE_STEPS.format(source='bench', horizon=28)})"

BENCH_METRICS = """avg(abs(demand - prediction)) AS mae,
    sqrt(avg((demand - prediction) * (demand - prediction))) AS rmse,
    avg(CASE WHEN demand = 0 AND prediction = 0 THEN 0
        ELSE 2 * abs(demand - prediction) / (abs(demand) + abs(prediction)) END) * 100 AS smape_pct,
    sum(abs(demand - prediction)) / nullif(sum(abs(demand)), 0) * 100 AS wape_pct"""

CV = f"""
    SELECT k AS fold, t AS train_end, t + 1 AS validation_start, t + 28 AS validation_end,
           'Seasonal Naive' AS model, {BENCH_METRICS}
    FROM (SELECT w.k, w.t, f.demand, greatest(h.demand, 0) AS prediction
          FROM (SELECT k, max(date) - CAST(28 * k AS INTEGER) - 28 AS t
                FROM bench, (SELECT unnest([1, 2, 3, 4]) AS k) GROUP BY k) w
          JOIN bench f ON f.date BETWEEN w.t + 1 AND w.t + 28
          JOIN bench h ON h.id = f.id AND h.date = w.t - 6 + CAST((f.date - w.t - 1) % 7 AS INTEGER))
    GROUP BY ALL
"""

INTERVALS = """
    SELECT p.*, w.interval_width, greatest(0, prediction - interval_width) AS prediction_lower,
           prediction + interval_width AS prediction_upper,
           demand BETWEEN greatest(0, prediction - interval_width)
                      AND prediction + interval_width AS interval_covered
    FROM predictions p
    JOIN (SELECT model, max(rmse) AS interval_width FROM cv GROUP BY model) w USING (model)
"""

STATS = """
    SELECT product_id, stddev_samp(error) AS error_std, count(*) AS oof_rows
    FROM oof GROUP BY product_id
"""

SCENARIOS = """
    SELECT * FROM (VALUES
        ('A - Normal demand', 1.0, false, NULL, 1.65),
        ('B - Demand +10%', 1.1, false, NULL, 1.65),
        ('C - Demand +20%', 1.2, false, NULL, 1.65),
        ('D - Unexpected 3x five-day spike', 1.0, true, NULL, 1.65),
        ('E - Inventory capacity at 70% of target', 1.0, false, 0.7, 1.65)
    ) AS t(scenario, multiplier, spike, capacity_fraction, z_score)
"""

NORMAL = """
    SELECT 'A - Normal demand' AS scenario, 1.0 AS multiplier, false AS spike,
           CAST(NULL AS DOUBLE) AS capacity_fraction, 1.65 AS z_score
"""

Z_SET = """
    SELECT 'A - Normal demand' AS scenario, 1.0 AS multiplier, false AS spike,
           CAST(NULL AS DOUBLE) AS capacity_fraction, unnest([1.28, 1.65, 2.05]) AS z_score
"""

PARAMETERS = """
    SELECT p.*, s.scenario, CAST(s.multiplier AS DOUBLE) AS multiplier, s.spike,
           CAST(s.capacity_fraction AS DOUBLE) AS capacity_fraction,
           CAST(s.z_score AS DOUBLE) AS z_score, e.error_std, e.oof_rows,
           10 AS protection_period_days,
           CAST(s.z_score AS DOUBLE) * e.error_std * sqrt(10) AS safety_stock,
           p.avg_forecast * 10 + CAST(s.z_score AS DOUBLE) * e.error_std * sqrt(10)
               AS reorder_point,
           (p.avg_forecast * 10 + CAST(s.z_score AS DOUBLE) * e.error_std * sqrt(10))
               * CAST(s.capacity_fraction AS DOUBLE) AS capacity
    FROM (SELECT product_id, avg(prediction) AS avg_forecast, count(*) AS n_days
          FROM holdout GROUP BY product_id) p
    JOIN stats e USING (product_id) CROSS JOIN scenarios s
"""

DAYS = """
    SELECT product_id, date, quantity AS demand,
           row_number() OVER (PARTITION BY product_id ORDER BY date) - 1 AS i,
           count(*) OVER (PARTITION BY product_id) AS n
    FROM holdout
"""

# With a lead of 3 and a review of 7 days, an order has arrived before the next one is placed, so
# one open order is all the state a step needs.
FOLD = """
    SELECT product_id, scenario, z_score, CAST(-1 AS BIGINT) AS i,
           CASE WHEN capacity IS NULL THEN reorder_point ELSE least(reorder_point, capacity) END
               AS stock,
           CAST(0 AS DOUBLE) AS open_units, CAST(-1 AS BIGINT) AS arrives, 0 AS stockouts,
           CAST(0 AS DOUBLE) AS lost, CAST(0 AS DOUBLE) AS ordered, CAST(0 AS DOUBLE) AS levels
    FROM parameters
    UNION ALL
    SELECT product_id, scenario, z_score, i, remaining,
           CASE WHEN amount > 0 THEN amount ELSE still_open END,
           CASE WHEN amount > 0 THEN i + 3 ELSE arrives END,
           stockouts + CASE WHEN demand > available THEN 1 ELSE 0 END,
           lost + CASE WHEN demand > available THEN demand - available ELSE 0 END,
           ordered + amount, levels + remaining
    FROM (
        SELECT *, CASE WHEN i % 7 = 0 AND remaining + still_open < reorder_point THEN
                 least(greatest(reorder_point - remaining - still_open, 0),
                       CASE WHEN capacity IS NULL THEN 1e300
                            ELSE greatest(capacity - remaining - still_open, 0) END)
               ELSE 0 END AS amount
        FROM (
            SELECT *, greatest(available - demand, 0) AS remaining
            FROM (
                SELECT f.product_id, f.scenario, f.z_score, d.i, p.reorder_point, p.capacity,
                       f.stock + CASE WHEN f.arrives = d.i THEN f.open_units ELSE 0 END AS available,
                       CASE WHEN f.arrives = d.i THEN 0 ELSE f.open_units END AS still_open,
                       f.arrives, f.stockouts, f.lost, f.ordered, f.levels,
                       d.demand * p.multiplier
                         * CASE WHEN p.spike AND d.i >= d.n // 2 AND d.i < d.n // 2 + 5
                                THEN 3 ELSE 1 END AS demand
                FROM fold f
                JOIN parameters p ON p.product_id = f.product_id AND p.scenario = f.scenario
                                 AND p.z_score = f.z_score
                JOIN days d ON d.product_id = f.product_id AND d.i = f.i + 1
            )
        )
    )
"""


def offset(places: int) -> float:
    """What the comparison adds before rounding, far below the rounding step."""
    return 1.37 * 10.0 ** -(places + 3)


def fx(expression: str, places: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,{places + 3})), {places}) AS DOUBLE)"


KPIS = f"""
    SELECT p.product_id, p.scenario, p.z_score, p.capacity_fraction, p.error_std AS oof_error_std,
           p.oof_rows, f.levels / p.n_days AS avg_inventory, f.stockouts AS stockout_days,
           {fx("100 * (1 - f.stockouts / p.n_days)", 2)} AS service_level_pct,
           {fx("f.lost", 1)} AS lost_units, {fx("f.ordered", 1)} AS total_units_ordered,
           {fx("p.avg_forecast", 2)} AS avg_daily_forecast, p.protection_period_days,
           {fx("p.reorder_point", 1)} AS reorder_point, {fx("p.reorder_point", 1)} AS target_level,
           {fx("p.safety_stock", 1)} AS safety_stock, {fx("p.capacity", 1)} AS inventory_capacity
    FROM fold f JOIN parameters p ON p.product_id = f.product_id AND p.scenario = f.scenario
                                 AND p.z_score = f.z_score AND f.i = p.n_days - 1
"""


def portfolio(key: str) -> str:
    other = [c for c in ("z_score", "capacity_fraction") if c != key]
    return f"""
    SELECT {key}, count(*) AS products, 60 AS test_days, 3 AS lead_time_days,
           7 AS review_period_days, 10 AS protection_period_days,
           {", ".join(f"{fx(f'max({c})', 2)} AS {c}" for c in other)},
           {fx("avg(service_level_pct)", 2)} AS mean_service_level_pct,
           count(*) FILTER (service_level_pct < 90) AS products_below_90pct_service,
           count(*) FILTER (service_level_pct < 95) AS products_below_95pct_service,
           {fx("sum(lost_units)", 1)} AS total_lost_units,
           {fx("sum(total_units_ordered)", 1)} AS total_units_ordered,
           {fx("sum(avg_inventory)", 1)} AS total_average_inventory,
           {fx("avg(safety_stock)", 1)} AS mean_safety_stock,
           {fx("avg(reorder_point)", 1)} AS mean_reorder_point,
           {fx("avg(oof_error_std)", 2)} AS mean_oof_error_std
    FROM kpis GROUP BY {key}
    """


EVENT_DAYS = """
    SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS demand,
           CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM events) + 1 AS n
    FROM events GROUP BY ALL
"""

EVENT_LONG = """
    SELECT concat('U', CAST(u.user_id AS VARCHAR)) AS id, concat('d_', CAST(g.n AS VARCHAR)) AS d, g.n,
           CAST(coalesce(e.demand, 0) AS BIGINT) AS demand
    FROM (SELECT DISTINCT user_id FROM event_days) u
    CROSS JOIN (SELECT unnest(generate_series(1, (SELECT max(n) FROM event_days))) AS n) g
    LEFT JOIN event_days e ON e.user_id = u.user_id AND e.n = g.n
"""

METADATA = """
    SELECT concat('U', CAST(user_id AS VARCHAR)) AS id,
           concat('ITEM_', CAST(user_id % 40 AS VARCHAR)) AS item_id,
           concat('DEPT_', CAST(user_id % 7 AS VARCHAR)) AS dept_id,
           concat('CAT_', CAST(user_id % 3 AS VARCHAR)) AS cat_id,
           concat('STORE_', CAST(user_id % 10 AS VARCHAR)) AS store_id,
           (['CA', 'TX', 'WI', 'NY'])[user_id % 4 + 1] AS state_id
    FROM (SELECT DISTINCT user_id FROM events)
"""


def _calendar_columns(day: str) -> str:
    wday = f"((dayofweek({day}) + 1) % 7 + 1)"
    return f"""
           week({day}) AS wm_yr_wk, dayname({day}) AS weekday, {wday} AS wday,
           month({day}) AS month, year({day}) AS year,
           CASE WHEN day({day}) = 1 THEN 'MonthStart' END AS event_name_1,
           CASE WHEN day({day}) = 1 THEN 'Cultural' END AS event_type_1,
           CASE WHEN day({day}) = 15 THEN 'MidMonth' END AS event_name_2,
           CASE WHEN day({day}) = 15 THEN 'National' END AS event_type_2,
           CASE WHEN {wday} IN (1, 4) THEN 1 ELSE 0 END AS snap_CA,
           CASE WHEN {wday} IN (2, 5) THEN 1 ELSE 0 END AS snap_TX,
           CASE WHEN {wday} IN (3, 6) THEN 1 ELSE 0 END AS snap_WI
    """


CALENDAR = f"""
    SELECT date, concat('d_', CAST(date - a + 1 AS VARCHAR)) AS d, {_calendar_columns("date")}
    FROM (SELECT a, CAST(unnest(generate_series(a, b + 5, INTERVAL 1 DAY)) AS DATE) AS date
          FROM (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events))
"""

FLAGS = """
    SELECT *, CASE WHEN wday IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
           CASE WHEN event_name_1 IS NOT NULL OR event_name_2 IS NOT NULL THEN 1 ELSE 0 END
               AS has_event,
           CASE WHEN event_type_1 IS NOT NULL OR event_type_2 IS NOT NULL THEN 1 ELSE 0 END
               AS event_type_present,
           CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX WHEN 'WI' THEN snap_WI
                ELSE 0 END AS snap
    FROM {source}
"""

EVENT_DAILY = """
    SELECT m.*, c.date, l.d, CAST(l.demand AS DOUBLE) AS demand, c.* EXCLUDE (d, date)
    FROM event_long l
    LEFT JOIN metadata m USING (id) LEFT JOIN calendar c ON c.d = l.d
"""

BENCH_BASE = f"""
    SELECT product_id AS id, product_id AS item_id, split_part(product_id, '/', 1) AS dept_id,
           split_part(product_id, '/', 2) AS cat_id,
           concat('STORE_', CAST(nr % 10 AS VARCHAR)) AS store_id,
           (['CA', 'TX', 'WI', 'NY'])[nr % 4 + 1] AS state_id, date,
           concat('d_', CAST(date - DATE '1995-01-01' + 1 AS VARCHAR)) AS d, quantity AS demand,
           {_calendar_columns("date")}
    FROM (SELECT *, CAST(split_part(split_part(product_id, '#', 2), '/', 1) AS INTEGER) AS nr
          FROM panel)
"""

BENCH = f"""
    SELECT *, {_history("demand", "id", (7, 14, 28), (7, 28))},
           CASE WHEN date > (SELECT max(date) FROM sales) - 28 THEN 1 ELSE 0 END AS is_final_test
    FROM bench_flags
"""

# name: (tables it reads, text)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "sales": ((), SALES),
    "raw": (("sales",), RAW + " UNION ALL " + RAW + " WHERE order_id % 700 = 5"),
    "clean": (("raw", "sales"), CLEAN),
    "daily": (("sales",), DAILY),
    "spine": (("sales",), SPINE),
    "grid": (("daily", "spine"), GRID),
    "panel": (("grid",), PANEL),
    "features": (("panel",), FEATURES),
    "model": (("features",), MODEL),
    "holdout": (("model",), HOLDOUT),
    "errors": (("holdout",), ERRORS),
    "oof": (("model",), OOF),
    "monitored": (("features",), MONITORED),
    "predictions": (("bench",), PREDICTIONS),
    "cv": (("bench",), CV),
    "intervals": (("predictions", "cv"), INTERVALS),
    "stats": (("oof",), STATS),
    "five": ((), SCENARIOS),
    "normal": ((), NORMAL),
    "z_set": ((), Z_SET),
    "days": (("holdout",), DAYS),
    "event_days": ((), EVENT_DAYS),
    "event_long": (("event_days",), EVENT_LONG),
    "metadata": ((), METADATA),
    "calendar": ((), CALENDAR),
    "event_daily": (("event_long", "metadata", "calendar"), EVENT_DAILY),
    "event_flags": (("event_daily",), FLAGS.format(source="event_daily")),
    "bench_base": (("panel",), BENCH_BASE),
    "bench_flags": (("bench_base",), FLAGS.format(source="bench_base")),
    "bench": (("bench_flags",), BENCH),
}


def policy_tables(scenarios: str) -> dict[str, tuple[tuple[str, ...], str]]:
    return {
        "scenarios": ((scenarios,), f"SELECT * FROM {scenarios}"),
        "parameters": (("holdout", "stats", "scenarios"), PARAMETERS),
        "fold": (("parameters", "days"), FOLD),
        "kpis": (("fold",), KPIS),
    }


def with_tables(
    body: str, reads: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None
) -> str:
    """Put the tables a statement reads, and those they read, in front of it."""
    known = {**TABLES, **(extra or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in known[name][0]:
            visit(other)
        ordered.append(name)

    for name in reads.split():
        visit(name)
    if not ordered:
        return body
    steps = [
        f"{name} AS {'' if name == 'fold' else 'MATERIALIZED '}({known[name][1]})"
        for name in ordered
    ]
    return f"WITH {'RECURSIVE ' if 'fold' in ordered else ''}" + ", ".join(steps) + " " + body
