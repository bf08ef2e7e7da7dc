"""Column functions on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from aforo.functions import amounts, keys, text, timestamps
from workload.registry import query, rounded, table

# Amount text as declarations write it: decimal comma, a unit behind it, missing and malformed
# values among it.
AMOUNT_TEXT_SQL = """
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN ''
    WHEN 3 THEN '1.' || replace(CAST(l_extendedprice AS VARCHAR), '.', ',')
    WHEN 4 THEN '-' || replace(CAST(l_extendedprice AS VARCHAR), '.', ',')
    ELSE replace(CAST(l_extendedprice AS VARCHAR), '.', ',') || ' US' END
"""


def amount_lines(spark, sf):
    comma = F.translate(F.col("l_extendedprice").cast("string"), ".", ",")
    line = F.col("l_linenumber")
    written = (
        F.when(line == 1, F.lit(None).cast("string"))
        .when(line == 2, F.lit(""))
        .when(line == 3, F.concat(F.lit("1."), comma))
        .when(line == 4, F.concat(F.lit("-"), comma))
        .otherwise(F.concat(comma, F.lit(" US")))
    )
    return table(spark, sf, "lineitem").withColumn("amount", written)


CLEAN_SQL = r"""
  TRY_CAST(coalesce(nullif(regexp_replace(replace(amount, ',', '.'), '[^0-9.\-]', '', 'g'), ''), '0')
    AS DECIMAL(15,2))
"""


@query(
    "amount_clean",
    f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {AMOUNT_TEXT_SQL} AS amount FROM lineitem),
    c AS (SELECT *, {CLEAN_SQL} AS amount_mod FROM t)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(amount_mod AS DOUBLE) AS amount_mod FROM c
    """,
)
def amount_clean(spark, sf):
    df = amounts.clean_amounts(amount_lines(spark, sf), ["amount"], "_mod")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "amount_mod")


@query(
    "amount_unsigned",
    f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {AMOUNT_TEXT_SQL} AS amount FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey,
      CAST({CLEAN_SQL.replace(chr(92) + '-', '')} AS DOUBLE) AS amount_mod
    FROM t
    """,
)
def amount_unsigned(spark, sf):
    df = amounts.clean_amounts(amount_lines(spark, sf), ["amount"], "_mod", keep_sign=False)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "amount_mod")


@query(
    "amount_rejects",
    f"""
    WITH t AS (SELECT {AMOUNT_TEXT_SQL} AS amount FROM lineitem)
    SELECT count(*) FILTER ({CLEAN_SQL} IS NULL) AS amount_rejects FROM t
    """,
)
def amount_rejects(spark, sf):
    df = amounts.clean_amounts(amount_lines(spark, sf), ["amount"], "_mod")
    return amounts.amount_rejects(df, ["amount"], "_mod")


@query(
    "date_keys",
    """
    WITH k AS (
      SELECT o_orderkey, o_orderdate AS d, CASE WHEN o_orderstatus = 'P' THEN NULL
        WHEN o_orderpriority = '5-LOW' AND day(o_orderdate) > 28 THEN '3102' || year(o_orderdate)
        ELSE strftime(o_orderdate, '%d%m%Y') END AS digits
      FROM orders),
    p AS (SELECT o_orderkey, CAST(try_strptime(digits, '%d%m%Y') AS DATE) AS fecha FROM k)
    SELECT o_orderkey, CAST(fecha AS VARCHAR) AS fecha,
      year(fecha) || '-' || month(fecha) AS period_id,
      CAST(CAST(date_trunc('month', fecha) AS DATE) AS VARCHAR) AS fecha_month
    FROM p
    """,
)
def date_keys(spark, sf):
    day = F.col("o_orderdate")
    bad = (F.col("o_orderpriority") == "5-LOW") & (F.day(day) > 28)
    digits = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("int"))
        .when(bad, F.concat(F.lit("3102"), F.year(day).cast("string")).cast("int"))
        .otherwise(F.date_format(day, "ddMMyyyy").cast("int"))
    )
    df = table(spark, sf, "orders").select(
        "o_orderkey", keys.parse_ddmmyyyy(digits).alias("fecha")
    )
    return df.withColumns(
        {"period_id": keys.period_id("fecha"), "fecha_month": keys.month_start("fecha")}
    )


@query(
    "date_key_first_eight",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha FROM orders
    """,
)
def date_key_first_eight(spark, sf):
    # A stored number has no leading zero, so only two-digit days can carry digits behind the year.
    tail = F.when(F.day("o_orderdate") >= 10, F.lit("99")).otherwise(F.lit(""))
    stored = F.concat(F.date_format("o_orderdate", "ddMMyyyy"), tail)
    return table(spark, sf, "orders").select(
        "o_orderkey", keys.parse_ddmmyyyy(stored, first_eight=True).alias("fecha")
    )


@query(
    "code_fill",
    """
    SELECT l_orderkey, l_linenumber, coalesce(nullif(l_linenumber, 3), 999) AS medida,
      CASE l_linenumber WHEN 5 THEN NULL WHEN 3 THEN -1 ELSE l_linenumber END AS aduana,
      coalesce(CAST(nullif(l_orderkey, 0) AS VARCHAR), 'Unknown') || '-'
        || coalesce(CAST(nullif(l_linenumber, 4) AS VARCHAR), 'Unknown') AS reference_id
    FROM lineitem
    """,
)
def code_fill(spark, sf):
    line = F.col("l_linenumber")
    stored = F.nullif(line.cast("double"), F.lit(3.0)).cast("string")
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        stored.alias("medida"),
        F.when(line == 5, F.lit("n/a")).otherwise(stored).alias("aduana"),
        keys.reference_id("l_orderkey", F.nullif(line, F.lit(4))).alias("reference_id"),
    )
    return keys.fill_codes(df, {"medida": 999, "aduana": -1})


@query(
    "undated_dropped",
    """
    SELECT count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def undated_dropped(spark, sf):
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    df = table(spark, sf, "orders").withColumn("FECTRA", key)
    kept = keys.drop_undated(df, "FECTRA")
    return rounded(
        kept.agg(F.count("*").alias("rows"), F.sum("o_totalprice").alias("total")), 2, "total"
    )


@query(
    "numeric_customs",
    """
    SELECT l_orderkey, l_partkey, l_linenumber AS aduana FROM lineitem WHERE l_linenumber NOT IN (2, 3)
    """,
)
def numeric_customs(spark, sf):
    line = F.col("l_linenumber")
    code = F.when(line == 2, F.lit("A2")).when(line != 3, line.cast("string"))
    df = keys.fill_codes(table(spark, sf, "lineitem").withColumn("aduana", code), {"aduana": -1})
    return keys.numeric_aduana(df, "aduana").select("l_orderkey", "l_partkey", "aduana")


@query(
    "tariff_normalized",
    """
    SELECT p_partkey, lpad(CAST(1000000 + p_partkey AS VARCHAR), 8, '0') AS tariff FROM part
    """,
)
def tariff_normalized(spark, sf):
    stored = (F.lit(1000000) + F.col("p_partkey")).cast("double").cast("decimal(18,1)")
    return table(spark, sf, "part").select("p_partkey", keys.normalize_tariff(stored).alias("tariff"))


@query(
    "describe",
    """
    SELECT p_partkey,
      concat(p_name, ' ', nullif(p_brand, 'Brand#3'), ' ', nullif(p_type, 'PROMO'), ' ', p_size)
        AS desc_completa,
      concat(nullif(p_type, 'SMALL'), ' / ', nullif(p_brand, 'Brand#5')) AS pre_unit_uom
    FROM part
    """,
)
def describe(spark, sf):
    def gap(column, value):
        return F.nullif(F.col(column), F.lit(value))

    return table(spark, sf, "part").select(
        "p_partkey",
        text.full_description("p_name", gap("p_brand", "Brand#3"), gap("p_type", "PROMO"), "p_size").alias(
            "desc_completa"
        ),
        text.unit_label(gap("p_type", "SMALL"), gap("p_brand", "Brand#5")).alias("pre_unit_uom"),
    )


@query(
    "unit_price",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(l_extendedprice AS DOUBLE)
      / nullif(CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity END, 0), 9) AS pre_unit_cif
    FROM lineitem
    """,
)
def unit_price(spark, sf):
    quantity = F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("l_quantity"))
    price = amounts.unit_price_cif(
        amounts.clean_amount(F.col("l_extendedprice").cast("string")),
        amounts.clean_amount(quantity.cast("string")),
    )
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", price.alias("pre_unit_cif")
    )
    return rounded(df, 9, "pre_unit_cif")


@query(
    "currency_codes",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber WHEN 1 THEN 'cad' WHEN 2 THEN 'usd'
      WHEN 3 THEN 'aud' WHEN 4 THEN 'eur' WHEN 5 THEN 'clp' ELSE 'other' END AS currency_code
    FROM lineitem
    """,
)
def currency_codes(spark, sf):
    codes = {1: "cad", 2: "usd", 3: "aud", 4: "eur", 5: "clp"}
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", keys.currency_code("l_linenumber", codes).alias("currency_code")
    )


@query(
    "seed_flag",
    """
    SELECT p_partkey, CASE WHEN upper(d) LIKE '%RED RI%' OR upper(d) LIKE '%BOLT%' OR p_size < 10
      THEN 1 ELSE 0 END AS is_siembra
    FROM (SELECT p_partkey, nullif(p_name, 'hot gear') AS d, nullif(p_size, 9) AS p_size FROM part)
    """,
)
def seed_flag(spark, sf):
    flag = text.is_seed(
        F.nullif("p_name", F.lit("hot gear")), F.nullif("p_size", F.lit(9)), ["RED RI", "BOLT"], 10
    )
    return table(spark, sf, "part").select("p_partkey", flag.alias("is_siembra"))


@query(
    "oil_flag",
    """
    SELECT p_partkey, CASE WHEN upper(p_name) LIKE '%RING%' THEN 'aceite' ELSE 'otro' END AS tipo2
    FROM (SELECT p_partkey, nullif(p_name, 'red ring') AS p_name FROM part)
    """,
)
def oil_flag(spark, sf):
    flag = text.oil_flag(F.nullif("p_name", F.lit("red ring")), "RING", "aceite", "otro")
    return table(spark, sf, "part").select("p_partkey", flag.alias("tipo2"))


@query(
    "quintal_prices",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      round(l_extendedprice * l_tax * 100, 4) AS precio_fob_usd,
      round(l_extendedprice * l_discount * 100, 4) AS precio_fob_cad,
      round(l_quantity * l_tax * 100, 4) AS precio_cif_usd,
      round(l_quantity * l_discount * 100, 4) AS precio_cif_cad,
      round_even(l_quantity * 50 / 100, 0) AS quintal
    FROM lineitem
    """,
)
def quintal_prices(spark, sf):
    df = amounts.quintal_prices(
        table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", "l_tax", "l_discount"
    ).withColumn("quintal", amounts.to_quintal(F.col("l_quantity") * 50))
    prices = ["precio_fob_usd", "precio_fob_cad", "precio_cif_usd", "precio_cif_cad"]
    out = df.select("l_orderkey", "l_linenumber", "l_partkey", *prices, "quintal")
    return rounded(out, 4, *prices)


@query(
    "line_ends_trimmed",
    r"""
    SELECT doc_id, CAST(length(regexp_replace(text || chr(13) || chr(10) || ' ',
        '[ \t\n\x0B\f\r]+$', '')) AS INTEGER) AS kept_right,
      CAST(length(trim(replace(replace(text, chr(13), ''), chr(10), ''), ' ')) AS INTEGER) AS kept_both
    FROM documents
    """,
)
def line_ends_trimmed(spark, sf):
    ended = F.concat("text", F.lit("\r\n "))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.length(text.rstrip_ws(ended)).alias("kept_right"),
        F.length(text.strip_line_ends("text")).alias("kept_both"),
    )


@query(
    "text_columns",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR)
      AS c_nationkey, c_mktsegment
    FROM customer
    """,
)
def text_columns(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return text.all_to_string(df)


@query(
    "exclude",
    """
    WITH p AS (SELECT p_partkey, p_name, nullif(p_brand, 'Brand#3') AS brand,
      nullif(p_type, 'PROMO') AS tariff, p_size FROM part)
    SELECT p_partkey, brand, tariff FROM p
    WHERE p_size > 2 AND upper(p_name) NOT LIKE '%RING%' AND upper(p_name) NOT LIKE '%HOT%'
      AND upper(brand) NOT LIKE '%#12%' AND upper(brand) NOT LIKE '%#2%'
      AND tariff NOT IN ('SMALL', 'LARGE')
    """,
)
def exclude(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey",
        "p_name",
        F.nullif("p_brand", F.lit("Brand#3")).alias("brand"),
        F.nullif("p_type", F.lit("PROMO")).alias("tariff"),
        "p_size",
    )
    words = {"p_name": ["RING", "HOT"], "brand": ["#12", "#2"]}
    kept = text.exclude_codes(text.exclude_keywords(df, words), "tariff", ["SMALL", "LARGE"])
    return kept.filter("p_size > 2").select("p_partkey", "brand", "tariff")


@query(
    "tz_convert",
    """
    SELECT event_id, strftime(timezone('America/New_York', timezone('UTC', date_trunc('second', ts))),
      '%Y-%m-%d %H:%M:%S') AS local_time
    FROM events
    """,
)
def tz_convert(spark, sf):
    written = F.date_format("ts", timestamps.DATETIME_FORMAT)
    df = table(spark, sf, "events").select("event_id", written.alias("local_time"))
    return timestamps.convert_tz(
        df, ["local_time"], "UTC", "America/New_York", timestamps.DATETIME_FORMAT
    )


@query(
    "parse_two_formats",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL
      WHEN 'view' THEN strftime(ts, '%Y-%m-%d 00:00:00')
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
    FROM events
    """,
)
def parse_two_formats(spark, sf):
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", F.date_format("ts", "dd/MM/yyyy"))
        .when(kind == "view", F.date_format("ts", timestamps.DATE_FORMAT))
        .otherwise(F.date_format("ts", timestamps.DATETIME_FORMAT))
    )
    return table(spark, sf, "events").select("event_id", timestamps.parse_ts(written).alias("parsed"))


@query(
    "time_as_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id FROM events",
)
def time_as_text(spark, sf):
    return timestamps.timestamps_to_text(
        table(spark, sf, "events").select("event_id", "ts", "user_id")
    )
