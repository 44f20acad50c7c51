"""The eleven sales questions as SQL text over the tables ``{sales}`` and ``{panel}``.

Report figures are rounded on their decimal digits, like those of the DataFrame forms.
"""

from __future__ import annotations


def _places(expression: str, places: int = 2) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,{places + 3})), {places}) AS DOUBLE)"


_UNITS = f"sum(quantity) AS total_units, {_places('sum(quantity * price)')} AS total_revenue"
_MONTH = "date_format(date, 'yyyy-MM') AS year_month"
_GROWTH = _places("try_divide(100.0D * (total_units - prev_month_units), prev_month_units)")

STATEMENTS = {
    "q1_monthly_sales": f"SELECT {_MONTH}, {_UNITS} FROM {{sales}} GROUP BY ALL ORDER BY year_month",
    "q2_top_products": f"""
        SELECT product_id, category, {_UNITS} FROM {{sales}} GROUP BY ALL
        ORDER BY total_units DESC, product_id LIMIT 10""",
    "q3_top_categories": f"""
        SELECT category, {_UNITS}, count(DISTINCT product_id) AS n_products FROM {{sales}} GROUP BY category
        ORDER BY total_revenue DESC""",
    "q4_demand_variance": f"""
        SELECT product_id, category, {_places("avg(quantity)")} AS avg_daily_units,
               {_places("var_pop(quantity)")} AS variance_daily_units
        FROM {{sales}} GROUP BY product_id, category ORDER BY variance_daily_units DESC, product_id LIMIT 10""",
    "q5_avg_daily_demand": f"""
        SELECT product_id, category, {_places("avg(quantity)")} AS avg_daily_units,
               min(quantity) AS min_daily_units, max(quantity) AS max_daily_units
        FROM {{sales}} GROUP BY product_id, category ORDER BY avg_daily_units DESC, product_id LIMIT 15""",
    "q6_monthly_growth": f"""
        WITH monthly AS (SELECT {_MONTH}, sum(quantity) AS total_units FROM {{sales}} GROUP BY ALL),
        pairs AS (SELECT *, lag(total_units) OVER (ORDER BY year_month) AS prev_month_units FROM monthly)
        SELECT *, {_GROWTH} AS mom_growth_pct FROM pairs ORDER BY year_month""",
    "q7_weekday_demand": f"""
        SELECT date_format(date, 'EEEE') AS weekday, dayofweek(date) - 1 AS weekday_num,
               {_places("avg(quantity)")} AS avg_units, sum(quantity) AS total_units
        FROM {{sales}} GROUP BY ALL ORDER BY weekday_num""",
    "q8_declining_products": f"""
        WITH edge AS (SELECT max(date) AS last FROM {{sales}}),
        means AS (
            SELECT product_id,
                   avg(quantity) FILTER (WHERE date < date_sub((SELECT last FROM edge), 90)) AS prior,
                   avg(quantity) FILTER (WHERE date >= date_sub((SELECT last FROM edge), 90)) AS recent
            FROM {{sales}} WHERE date >= date_sub((SELECT last FROM edge), 180) GROUP BY product_id)
        SELECT product_id, {_places("prior")} AS avg_daily_prior_90d, {_places("recent")} AS avg_daily_recent_90d,
               {_places("recent - prior")} AS change,
               {_places("try_divide(100.0D * (recent - prior), prior)")} AS pct_change
        FROM means WHERE prior IS NOT NULL AND recent IS NOT NULL ORDER BY pct_change, product_id LIMIT 10""",
    "q9_category_rank": f"""
        WITH totals AS (SELECT product_id, category, {_UNITS} FROM {{sales}} GROUP BY product_id, category)
        SELECT *, rank() OVER (PARTITION BY category ORDER BY total_units DESC) AS category_rank FROM totals""",
    "q10_rolling_7d": f"""
        SELECT date, product_id, quantity AS daily_units, {_places(
            "avg(quantity) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")}
               AS rolling_7d_avg_units
        FROM {{panel}}""",
    "q11_product_growth": f"""
        WITH monthly AS (SELECT {_MONTH}, product_id, category, sum(quantity) AS total_units FROM {{sales}} GROUP BY ALL),
        pairs AS (SELECT *, lag(total_units) OVER (PARTITION BY product_id ORDER BY year_month) AS prev_month_units FROM monthly)
        SELECT *, {_GROWTH} AS mom_growth_pct FROM pairs""",
}
