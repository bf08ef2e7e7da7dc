"""Rate series derived from the orders: mean order value per priority and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from aforo.fixed_values import RATE_CURRENCIES
from aforo.operators import rates
from workload.registry import query, rounded, table

AS_OF = date(2001, 12, 1)

# Priority -> currency; missing values are orders that are still pending.
PRIORITY_CODES = {
    "1-URGENT": "usd", "2-HIGH": "eur", "3-MEDIUM": "cad", "4-NOT SPECIFIED": "aud", "5-LOW": "clp",
}

RAW_SQL = """
  raw AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'usd' WHEN '2-HIGH' THEN 'eur'
      WHEN '3-MEDIUM' THEN 'cad' WHEN '4-NOT SPECIFIED' THEN 'aud' ELSE 'clp' END AS code,
    CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v
    FROM orders)
"""
DAILY_SQL = RAW_SQL + """,
  daily AS (SELECT code, day, avg(v) AS v FROM raw GROUP BY ALL),
  filled AS (SELECT code, day, last_value(v IGNORE NULLS) OVER (PARTITION BY code ORDER BY day
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM daily)
"""
CONVERTER_SQL = RAW_SQL + """,
  last AS (SELECT max(day) AS d FROM raw),
  grid AS (SELECT unnest(['usd', 'eur', 'cad', 'aud']) AS code, day, CAST(NULL AS DOUBLE) AS v
    FROM (SELECT CAST(unnest(generate_series(d, d + CASE WHEN d <= DATE '2001-12-01' - 45
      THEN 730 ELSE 30 END, INTERVAL 1 DAY)) AS DATE) AS day FROM last)),
  daily AS (SELECT code, day, avg(v) AS v FROM (FROM raw UNION ALL FROM grid) GROUP BY ALL),
  filled AS (SELECT code, day, last_value(v IGNORE NULLS) OVER (PARTITION BY code ORDER BY day
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM daily),
  converter AS (SELECT f.code, f.day, f.v AS to_clp, f.v / nullif(u.v, 0) AS to_usd,
      f.v / nullif(e.v, 0) AS to_eur, f.v / nullif(c.v, 0) AS to_cad, f.v / nullif(a.v, 0) AS to_aud
    FROM filled f JOIN filled u ON u.day = f.day AND u.code = 'usd'
    JOIN filled e ON e.day = f.day AND e.code = 'eur'
    JOIN filled c ON c.day = f.day AND c.code = 'cad'
    JOIN filled a ON a.day = f.day AND a.code = 'aud')
"""
RATE_COLUMNS = ("to_clp", "to_usd", "to_eur", "to_cad", "to_aud")


def raw_rates(spark, sf):
    code = F.lit(None).cast("string")
    for priority, currency in PRIORITY_CODES.items():
        code = F.when(F.col("o_orderpriority") == priority, F.lit(currency)).otherwise(code)
    return table(spark, sf, "orders").select(
        code.alias("currency_code"),
        F.to_date("o_orderdate").alias("currency_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("to_clp"),
    )


def converter(spark, sf):
    return rates.currency_converter(raw_rates(spark, sf), RATE_CURRENCIES, AS_OF)


@query(
    "daily_rates",
    f"""
    WITH {DAILY_SQL} SELECT code AS currency_code, CAST(day AS VARCHAR) AS currency_date,
      round(v, 4) AS to_clp FROM daily
    """,
)
def daily_rates(spark, sf):
    return rounded(rates.daily_mean(raw_rates(spark, sf)), 4, "to_clp")


@query(
    "rate_fill",
    f"""
    WITH {DAILY_SQL} SELECT code AS currency_code, CAST(day AS VARCHAR) AS currency_date,
      round(v, 4) AS to_clp FROM filled
    """,
)
def rate_fill(spark, sf):
    return rounded(rates.ffill(rates.daily_mean(raw_rates(spark, sf))), 4, "to_clp")


@query(
    "cross_rates",
    f"""
    WITH {DAILY_SQL},
    w AS (SELECT day, max(v) FILTER (code = 'usd') AS u, max(v) FILTER (code = 'eur') AS e
      FROM filled GROUP BY day
      HAVING count(*) FILTER (code = 'usd') > 0 AND count(*) FILTER (code = 'eur') > 0)
    SELECT code AS currency_code, CAST(day AS VARCHAR) AS currency_date, round(v, 4) AS to_clp,
      round(v / nullif(u, 0), 6) AS to_usd, round(v / nullif(e, 0), 6) AS to_eur
    FROM filled JOIN w USING (day)
    """,
)
def cross_rates(spark, sf):
    filled = rates.ffill(rates.daily_mean(raw_rates(spark, sf)))
    out = rates.cross_rates(filled, ["usd", "eur"])
    return rounded(rounded(out, 4, "to_clp"), 6, "to_usd", "to_eur")


@query(
    "rate_forecast",
    f"""
    WITH {CONVERTER_SQL} SELECT code AS currency_code, CAST(day AS VARCHAR) AS currency_date,
      round(to_clp, 4) AS to_clp, round(to_usd, 6) AS to_usd, round(to_eur, 6) AS to_eur,
      round(to_cad, 6) AS to_cad, round(to_aud, 6) AS to_aud
    FROM converter
    """,
)
def rate_forecast(spark, sf):
    return rounded(rounded(converter(spark, sf), 4, "to_clp"), 6, *RATE_COLUMNS[1:])


@query(
    "monthly_rates",
    f"""
    WITH {CONVERTER_SQL} SELECT code AS currency_code,
      CAST(CAST(date_trunc('month', day) AS DATE) AS VARCHAR) AS currency_month,
      round(avg(to_clp), 4) AS to_clp, round(avg(to_usd), 6) AS to_usd, round(avg(to_eur), 6)
      AS to_eur, round(avg(to_cad), 6) AS to_cad, round(avg(to_aud), 6) AS to_aud
    FROM converter GROUP BY ALL
    """,
)
def monthly_rates(spark, sf):
    monthly = rates.monthly_rates(converter(spark, sf), RATE_COLUMNS)
    return rounded(rounded(monthly, 4, "to_clp"), 6, *RATE_COLUMNS[1:])
