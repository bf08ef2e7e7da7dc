"""Report views and price series, with order lines standing in for declarations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from aforo.fixed_values import ALL_COUNTRIES
from aforo.functions import keys
from aforo.operators import series
from aforo.operators.classify import ProductClass
from aforo.operators.joins import lookup_join
from aforo.operators.labels import Role
from aforo.plans import price_series as prices
from aforo.plans import reports
from aforo.plans.cleaned_tables import refresh_cleaned, version_of
from aforo.plans.monthly_load import incremental_load
from aforo.session import new_path, staged
from aforo.sinks.tables import append_table, replace_periods, spread_by
from workload.rates import CONVERTER_SQL, converter
from workload.registry import ORACLE, query, rounded, table
from workload.tables import with_unknown

CLASSES = (
    ProductClass("trigo", ("100",), ("BOLT", "ANVIL")),
    ProductClass("canola", ("1205",), ("RING", "GEAR")),
)
IMPORTS = replace(
    reports.IMPORTS,
    code_columns=("MONEDA", "PA_ORIG", "PA_ADQ", "VIA_TRAN", "MEDIDA"),
    amounts=("CIF_ITEM", "FOB", "CANT_MERC", "PRE_UNIT"),
    roles=(
        Role("PA_ORIG", "pais", "pais_nombre_origen"),
        Role("PA_ADQ", "pais", "pais_nombre_adquisicion"),
    ),
    description=("DNOMBRE", "DMARCA", "DVARIEDAD"),
    excluded_words={
        "DNOMBRE": ("HOT RING", "HOT GEAR"), "DESOBS1": ("#12", "#25"), "DMARCA": ("LARGE",),
    },
    excluded_tariffs=("12050001", "12050002", "10030003"),
    report_excluded_words={"DESOBS1": ("#7",)},
    min_value=("FOB_MOD", "to_usd", 10000),
    classes=CLASSES,
)
EXPORTS = replace(
    IMPORTS, trade="Exports", date_first_eight=True, min_value=None, report_excluded_words={}
)


def declarations(spark, sf):
    """Order lines with part and supplier, written the way declarations are: everything as text."""
    lines = table(spark, sf, "lineitem").drop("l_linestatus", "l_discount")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        suppliers, lines.l_suppkey == suppliers.s_suppkey
    )
    tax = F.round(F.col("l_tax") * 100).cast("int")
    money = (
        F.when(tax == 0, 13).when(tax == 1, 6).when(tax == 2, 36).when(tax == 3, 142)
        .when(tax == 4, 200).when(tax == 5, 999).otherwise(13)
    )
    chapter = F.when(F.col("p_type") == "PROMO", "1205").when(F.col("p_type") == "SMALL", "1003")
    nation = F.col("s_nationkey")

    def comma(c):
        return F.translate(F.col(c).cast("string"), ".", ",")

    return joined.select(
        (F.day("l_shipdate") * 1000000 + F.month("l_shipdate") * 10000 + F.year("l_shipdate")).alias(
            "FECTRA"
        ),
        F.col("l_orderkey").cast("string").alias("NUMENCRIPTADO"),
        F.col("l_linenumber").cast("string").alias("NUMITEM"),
        F.col("l_partkey").alias("parte"),
        F.col("l_suppkey").alias("proveedor"),
        F.upper("p_name").alias("DNOMBRE"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("DMARCA"),
        F.col("p_brand").alias("DVARIEDAD"),
        F.nullif("p_brand", F.lit("Brand#3")).alias("DESOBS1"),
        F.concat(
            F.coalesce(chapter, F.lit("9500")), F.lpad(F.col("p_size").cast("string"), 4, "0")
        ).alias("ARANC_NAC"),
        comma("l_extendedprice").alias("CIF_ITEM"),
        F.concat(comma("l_extendedprice"), F.lit(" US")).alias("FOB"),
        (F.col("l_quantity") * 150).cast("string").alias("CANT_MERC"),
        comma("l_quantity").alias("PRE_UNIT"),
        money.alias("MONEDA"),
        F.col("l_linenumber").alias("VIA_TRAN"),
        F.when(F.col("l_returnflag") == "N", 7).otherwise(6).alias("MEDIDA"),
        (F.col("l_returnflag") == "R").alias("devuelto"),
        F.when(nation == 4, None).when(nation == 9, 99).otherwise(nation).alias("PA_ORIG"),
        nation.alias("PA_ADQ"),
    )


BASE_SQL = """
  decl AS (SELECT l_orderkey, l_linenumber, l_partkey AS parte, l_suppkey AS proveedor,
      CAST(l_shipdate AS DATE) AS fecha, upper(p_name) AS dnombre, nullif(p_type, 'ECONOMY') AS dmarca,
      nullif(p_brand, 'Brand#3') AS desobs1,
      CASE p_type WHEN 'PROMO' THEN '1205' WHEN 'SMALL' THEN '1003' ELSE '9500' END
        || lpad(CAST(p_size AS VARCHAR), 4, '0') AS aranc,
      l_extendedprice AS cif, l_quantity * 150 AS cant, l_quantity AS pre_unit,
      l_linenumber AS via, CASE WHEN l_returnflag = 'N' THEN 7 ELSE 6 END AS medida,
      CASE CAST(round(l_tax * 100) AS INTEGER) WHEN 0 THEN 'usd' WHEN 1 THEN 'cad' WHEN 2 THEN 'aud'
        WHEN 3 THEN 'eur' WHEN 4 THEN 'clp' WHEN 5 THEN 'other' ELSE 'usd' END AS currency_code,
      CASE WHEN s_nationkey = 4 THEN 'DESCONOCIDO' WHEN s_nationkey = 9 THEN NULL ELSE n_name END
        AS origen, n_name AS adquisicion, l_returnflag, l_discount, l_tax, p_brand
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey),
  tagged AS (
    SELECT 'trigo' AS tipo, * FROM decl WHERE aranc LIKE '100%'
    UNION SELECT 'trigo', * FROM decl WHERE dnombre LIKE '%BOLT%' OR dnombre LIKE '%ANVIL%'
    UNION SELECT 'canola', * FROM decl WHERE aranc LIKE '1205%'
    UNION SELECT 'canola', * FROM decl WHERE dnombre LIKE '%RING%' OR dnombre LIKE '%GEAR%'),
  viewed AS (SELECT *, CAST(date_trunc('month', fecha) AS DATE) AS fecha_month FROM tagged
    WHERE cant > 2 AND dnombre NOT LIKE '%HOT RING%' AND dnombre NOT LIKE '%HOT GEAR%'
      AND upper(desobs1) NOT LIKE '%#12%' AND upper(desobs1) NOT LIKE '%#25%'
      AND dmarca NOT LIKE '%LARGE%' AND aranc NOT IN ('12050001', '12050002', '10030003')),
  scoped AS (SELECT *, CASE WHEN cant < 5000 THEN 1 ELSE 0 END AS is_siembra FROM viewed
    WHERE tipo = 'canola' AND via IN (7, 1) AND medida = 6 AND cant > 100)
"""
MONTHLY_SQL = CONVERTER_SQL + """,
  monthly AS (SELECT code, CAST(date_trunc('month', day) AS DATE) AS month, avg(to_usd) AS to_usd,
    avg(to_cad) AS to_cad FROM converter GROUP BY ALL)
"""
IMPORTS_SQL = f"""{MONTHLY_SQL}, {BASE_SQL},
  report AS (SELECT s.*, to_usd, to_cad FROM scoped s LEFT JOIN monthly
    ON currency_code = code AND fecha_month = month
    WHERE upper(desobs1) NOT LIKE '%#7%' AND cif * to_usd > 10000)
"""
REPORT_COLUMNS_SQL = """
  coalesce(CAST(nullif(l_orderkey, 0) AS VARCHAR), 'Unknown') || '-' || l_linenumber AS reference_id, parte, proveedor, origen AS pais_nombre_origen,
  currency_code, CAST(fecha_month AS VARCHAR) AS fecha_month, is_siembra, round(to_usd, 6) AS to_usd,
  round(to_cad, 6) AS to_cad
"""


def dims(spark, sf):
    return {"pais": with_unknown(table(spark, sf, "nation").select("n_nationkey", "n_name"))}


def raw_table(spark, sf, spec):
    return with_unit(reports.derive_keys(declarations(spark, sf), spec), dims(spark, sf), spec)


def with_unit(facts, countries, spec):
    """The cleaned rows with the unit price that the import table has."""
    return reports.cleaned(facts, countries, spec).withColumn(
        "PRE_UNIT_CIF", reports.amounts.unit_price_cif("CIF_ITEM_MOD", "CANT_MERC_MOD")
    )


def rate_table(spark, sf):
    """The daily converter is its own small table in a load, so it is staged here as well."""
    return staged(converter(spark, sf), "converter")


def report_rows(df):
    out = df.select(
        "reference_id", "parte", "proveedor", "pais_nombre_origen", "currency_code", "fecha_month",
        "is_siembra", "to_usd", "to_cad",
    )
    return rounded(out, 6, "to_usd", "to_cad")


def imports_report(spark, sf):
    view = reports.report_source(raw_table(spark, sf, IMPORTS), IMPORTS)
    return reports.trade_report(view, rate_table(spark, sf), IMPORTS)


@query(
    "load_rejects",
    """
    WITH d AS (SELECT coalesce(CAST(nullif(l_orderkey, 0) AS VARCHAR), 'Unknown') || '-' || l_linenumber AS reference_id, l_linenumber AS n, l_returnflag AS flag,
      l_quantity AS q FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
    SELECT reference_id, 'FECTRA' AS column_name, NULL AS raw, 'missing' AS reason, 1 AS row_dropped FROM d WHERE n = 6
    UNION ALL SELECT reference_id, 'FECTRA', '31022021', 'no date', 1 FROM d WHERE n = 7
    UNION ALL SELECT reference_id, 'MONEDA', 'n/a', 'no integer', 0 FROM d WHERE flag = 'R' AND n < 3
    UNION ALL SELECT reference_id, 'FOB', '1.234.5', 'no amount', 0 FROM d WHERE q = 13
    """,
)
def load_rejects(spark, sf):
    """Declarations with bad dates, currencies and amounts: what a load cannot use, value by value."""
    landed = declarations(spark, sf)
    line, text = F.col("NUMITEM").cast("int"), F.col("FECTRA").cast("string")
    landed = landed.withColumns(
        {
            "FECTRA": F.when(line == 7, "31022021").when(line != 6, text),
            "MONEDA": F.when(F.col("devuelto") & (line < 3), "n/a").otherwise(
                F.col("MONEDA").cast("string")
            ),
            "FOB": F.when(F.col("CANT_MERC").cast("double") == 13 * 150, "1.234.5").otherwise(F.col("FOB")),
        }
    )
    return reports.load_rejects(landed, IMPORTS)


CLEANED_SQL = """
    SELECT origen AS pais_nombre_origen, adquisicion AS pais_nombre_adquisicion,
      year(fecha) || '-' || month(fecha) AS period_id,
      round(sum(cif), 2) AS cif, sum(cant) AS cantidad, round(max(cif / cant), 9) AS unit,
      CAST(sum(length(concat(dnombre, ' ', dmarca, ' ', p_brand))) AS BIGINT) AS described
    FROM decl GROUP BY ALL
"""


def cleaned_sums(raw):
    out = raw.groupBy("pais_nombre_origen", "pais_nombre_adquisicion", "period_id").agg(
        F.sum("CIF_ITEM_MOD").alias("cif"),
        F.sum("CANT_MERC_MOD").cast("double").alias("cantidad"),
        F.max("PRE_UNIT_CIF").alias("unit"),
        F.sum(F.length("DESC_COMPLETA")).alias("described"),
    )
    return rounded(rounded(out, 2, "cif"), 9, "unit")


@query(
    "cleaned_table",
    f"WITH {BASE_SQL} {CLEANED_SQL}",
)
def cleaned_table(spark, sf):
    return cleaned_sums(raw_table(spark, sf, IMPORTS))


@query(
    "cleaned_incremental",
    f"""
    WITH {BASE_SQL}, cleaned AS ({CLEANED_SQL})
    SELECT *, CASE WHEN period_id IN ('1997-5', '1996-3') THEN 'build' END AS action FROM cleaned
    """,
)
def cleaned_incremental(spark, sf):
    """K-05 after I-04: a cleaned table follows its facts, of which one month was missing and one incomplete."""
    facts = staged(reports.derive_keys(declarations(spark, sf), IMPORTS), "facts")
    first, cleaned, countries = new_path(spark, "facts"), new_path(spark, "cleaned"), dims(spark, sf)
    cut = (F.col("period_id") == "1997-5") & (F.col("VIA_TRAN") > 3)
    append_table(facts.filter((F.col("period_id") != "1996-3") & ~cut), first)
    version = version_of(countries, IMPORTS)

    def refresh():
        return refresh_cleaned(spark, first, lambda rows: with_unit(rows, countries, IMPORTS), cleaned, version, spread=False)

    refresh()
    incremental_load(spark, {"imports": first}, {"imports": facts})
    changed = refresh()
    return lookup_join(cleaned_sums(spark.read.parquet(cleaned)), changed, [("period_id", "period_id")])


@query(
    "stored_view",
    f"""
    WITH {BASE_SQL}
    SELECT tipo, dnombre, aranc, desobs1, count(*) AS rows, sum(cant) AS cantidad FROM viewed
    GROUP BY ALL
    """,
)
def stored_view(spark, sf):
    """P-03 to P-06 and U-01 on a stored cleaned table, whose match columns the scan tests."""
    return view_sums(reports.trade_view(staged(raw_table(spark, sf, IMPORTS), "cleaned"), IMPORTS))


@query(
    "trade_view",
    f"""
    WITH {BASE_SQL}
    SELECT tipo, dnombre, aranc, desobs1, count(*) AS rows, sum(cant) AS cantidad FROM viewed
    GROUP BY ALL
    """,
)
def trade_view(spark, sf):
    return view_sums(reports.trade_view(raw_table(spark, sf, IMPORTS), IMPORTS))


def view_sums(view):
    return view.groupBy(
        F.col("TIPO").alias("tipo"), F.col("DNOMBRE").alias("dnombre"),
        F.col("ARANC_NAC").alias("aranc"), F.col("DESOBS1").alias("desobs1"),
    ).agg(
        F.count("*").alias("rows"), F.sum("CANT_MERC_MOD").cast("double").alias("cantidad")
    )


@query("report_imports", f"WITH {IMPORTS_SQL} SELECT {REPORT_COLUMNS_SQL} FROM report")
def report_imports(spark, sf):
    return report_rows(imports_report(spark, sf))


@query(
    "report_exports",
    f"""
    WITH {MONTHLY_SQL}, {BASE_SQL}
    SELECT {REPORT_COLUMNS_SQL} FROM scoped LEFT JOIN monthly
      ON currency_code = code AND fecha_month = month
    """,
)
def report_exports(spark, sf):
    view = reports.report_source(raw_table(spark, sf, EXPORTS), EXPORTS)
    return report_rows(reports.trade_report(view, rate_table(spark, sf), EXPORTS))


COUNTRY_SQL = IMPORTS_SQL + """,
  country AS (SELECT fecha_month, origen, sum(round_even(cant / 100, 0)) AS q,
      avg(pre_unit * to_usd * 100) AS fu, avg(pre_unit * to_cad * 100) AS fc,
      avg(cif / cant * to_usd * 100) AS cu, avg(cif / cant * to_cad * 100) AS cc
    FROM report WHERE is_siembra = 0 AND origen IS NOT NULL GROUP BY ALL)
"""
SERIES_SQL = """
  CAST(fecha_month AS VARCHAR) AS fecha_month, origen AS pais_nombre_origen, q AS cantidad_quintal,
  round(fu, 7) AS precio_fob_usd_quintal, round(fc, 7) AS precio_fob_cad_quintal,
  round(cu, 7) AS precio_cif_usd_quintal, round(cc, 7) AS precio_cif_cad_quintal
"""


def series_rows(df):
    out = df.select("fecha_month", "pais_nombre_origen", "cantidad_quintal", *series.PRICES)
    return rounded(out, 7, *series.PRICES)


@query("price_by_country", f"WITH {COUNTRY_SQL} SELECT {SERIES_SQL} FROM country")
def price_by_country(spark, sf):
    return series_rows(prices.country_prices(imports_report(spark, sf)))


ALL_SQL = COUNTRY_SQL + """,
  everything AS (SELECT fecha_month, 'TODOS' AS origen, sum(q) AS q,
      sum(fu * q) / nullif(sum(q), 0) AS fu, sum(fc * q) / nullif(sum(q), 0) AS fc,
      sum(cu * q) / nullif(sum(q), 0) AS cu, sum(cc * q) / nullif(sum(q), 0) AS cc
    FROM (SELECT fecha_month, q, coalesce(fu, 0) AS fu, coalesce(fc, 0) AS fc,
      coalesce(cu, 0) AS cu, coalesce(cc, 0) AS cc FROM country) GROUP BY ALL),
  months AS (SELECT CAST(unnest(generate_series(min(fecha_month), max(fecha_month),
    INTERVAL 1 MONTH)) AS DATE) AS fecha_month FROM country)
"""


@query("price_all", f"WITH {ALL_SQL} SELECT {SERIES_SQL} FROM everything")
def price_all(spark, sf):
    monthly = prices.country_prices(imports_report(spark, sf))
    return series_rows(series.monthly_all(monthly, ALL_COUNTRIES))


@query(
    "price_series",
    f"""
    WITH {ALL_SQL}, both_series AS (FROM country UNION ALL FROM everything),
    full_grid AS (SELECT fecha_month, origen FROM months, (SELECT DISTINCT origen FROM both_series))
    SELECT CAST(fecha_month AS VARCHAR) AS fecha_month, origen AS pais_nombre_origen,
      coalesce(q, 0) AS cantidad_quintal, round(fu, 7) AS precio_fob_usd_quintal,
      round(fc, 7) AS precio_fob_cad_quintal, round(cu, 7) AS precio_cif_usd_quintal,
      round(cc, 7) AS precio_cif_cad_quintal
    FROM full_grid LEFT JOIN both_series USING (fecha_month, origen)
    """,
)
def price_series(spark, sf):
    countries, everything = prices.price_series(imports_report(spark, sf))
    return series_rows(countries.unionByName(everything))


@query("series_incremental", ORACLE["price_series"])
def series_incremental(spark, sf):
    """A-03 and A-04 kept up to date: the series after one month was missing and one incomplete at first."""
    cleaned, sums, converter_table = new_path(spark, "cleaned"), new_path(spark, "sums"), rate_table(spark, sf)
    # Spread by period before the cleaning, which looks at one row at a time and makes rows twice as wide.
    facts = spread_by(reports.derive_keys(declarations(spark, sf), IMPORTS), "period_id")
    raw = with_unit(facts, dims(spark, sf), IMPORTS)
    cut = (F.col("period_id") == "1997-5") & (F.col("VIA_TRAN") > 3)
    version = version_of({"rates": converter_table}, IMPORTS)

    def report(rows):
        return reports.trade_report(reports.report_source(rows, IMPORTS), converter_table, IMPORTS)

    append_table(raw.filter((F.col("period_id") != "1996-3") & ~cut), cleaned, spread=False)
    prices.refresh_series(spark, cleaned, report, sums, version)
    replace_periods(raw.filter(F.col("period_id").isin("1996-3", "1997-5")), cleaned, spread=False)
    countries, everything = prices.refresh_series(spark, cleaned, report, sums, version)
    return series_rows(countries.unionByName(everything))


GRID_SQL = """
  lines AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha_month, n_name AS origen,
      l_quantity AS cant, l_extendedprice AS cif
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
  monthly AS (SELECT fecha_month, origen, round(sum(cant)) AS q, avg(round(cif)) AS p FROM lines
    GROUP BY ALL),
  sparse AS (SELECT * FROM monthly
    WHERE month(fecha_month) <> CAST(split_part(origen, '_', 2) AS INTEGER) % 12 + 1),
  grid AS (SELECT origen, CAST(unnest(generate_series((SELECT min(fecha_month) FROM sparse),
      (SELECT max(fecha_month) FROM sparse), INTERVAL 1 MONTH)) AS DATE) AS fecha_month
    FROM (SELECT DISTINCT origen FROM sparse))
"""


def monthly_series(spark, sf):
    """Monthly quantities and prices of all lines by nation."""
    lines = table(spark, sf, "lineitem")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    placed = lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    named = lookup_join(placed, nations, [("s_nationkey", "n_nationkey")], "inner")
    rows = named.select(
        keys.month_start("l_shipdate").alias("fecha_month"),
        F.col("n_name").alias("pais_nombre_origen"),
        "l_quantity",
        F.round("l_extendedprice").alias("price"),
    )
    return series.monthly_by_country(rows, "l_quantity", ["price"], names=["price"])


def sparse_series(spark, sf):
    """The monthly series with one month of the year missing, another one for each nation."""
    missing = F.split("pais_nombre_origen", "_")[1].cast("int") % 12 + 1
    return staged(monthly_series(spark, sf).filter(F.month("fecha_month") != missing), "sparse-series")


@query(
    "month_grid",
    f"""
    WITH {GRID_SQL}
    SELECT CAST(fecha_month AS VARCHAR) AS fecha_month, origen AS pais_nombre_origen,
      coalesce(q, 0) AS cantidad_quintal, round(p, 3) AS price
    FROM grid LEFT JOIN sparse USING (fecha_month, origen)
    """,
)
def month_grid(spark, sf):
    return rounded(series.fill_months(sparse_series(spark, sf)), 3, "price")


@query(
    "country_filter",
    f"""
    WITH {GRID_SQL}
    SELECT CAST(fecha_month AS VARCHAR) AS fecha_month, q AS cantidad_quintal FROM monthly
    WHERE origen = 'NATION_7'
    """,
)
def country_filter(spark, sf):
    df = series.by_country(monthly_series(spark, sf), "NATION_7")
    return df.select("fecha_month", "cantidad_quintal")


@query(
    "chart_feed",
    """
    WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha_month, n_name AS origen,
        sum(l_quantity) AS q, max(round(l_extendedprice)) AS p, min(round(l_extendedprice)) AS c
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      GROUP BY ALL)
    SELECT 'Pais: ' || CASE origen WHEN 'NATION_3' THEN 'All' ELSE split_part(origen, '_', 2) END
        AS title, CAST(fecha_month AS VARCHAR) AS fecha_month, q AS cantidad_quintal,
      format('{:,}', CAST(q AS BIGINT)) AS cantidad_label, p AS precio_fob_usd_quintal,
      '$' || CAST(p AS BIGINT) AS precio_fob_label, c AS precio_cif_usd_quintal,
      '$' || CAST(c AS BIGINT) AS precio_cif_label
    FROM m
    """,
)
def chart_feed(spark, sf):
    whole = F.round("l_extendedprice")
    month = keys.month_start("l_shipdate")
    # Added up per supplier and month first, so the join sees few rows of a busy supplier.
    per_supplier = table(spark, sf, "lineitem").groupBy("l_suppkey", month.alias("fecha_month")).agg(
        F.sum("l_quantity").alias("q"), F.max(whole).alias("p"), F.min(whole).alias("c")
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    placed = per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    named = lookup_join(placed, nations, [("s_nationkey", "n_nationkey")], "inner")
    monthly = named.groupBy("fecha_month", F.col("n_name").alias("pais_nombre_origen")).agg(
        F.sum("q").alias("cantidad_quintal"),
        F.max("p").alias("precio_fob_usd_quintal"),
        F.min("c").alias("precio_cif_usd_quintal"),
    )
    return series.chart_feed(monthly, all_label="NATION_3")
