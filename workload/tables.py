"""Labels, classes, ledgers, relational operators and events on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from aforo.fixed_values import OIL_TYPE, OTHER_TYPE
from aforo.functions import keys, text
from aforo.operators import catalogue, events, ledger, relational, series
from aforo.operators.classify import ProductClass, classify
from aforo.operators.labels import Role, label_codes
from workload.registry import query, table

# ---------------------------------------------------------------- labels and classes


def with_unknown(dim):
    """A dimension with the unknown member the code files carry."""
    unknown = dim.sparkSession.range(1).select(
        F.lit(-1).alias(dim.columns[0]), F.lit("DESCONOCIDO").alias(dim.columns[1])
    )
    return dim.unionByName(unknown)


def dimensions(spark, sf):
    return {
        "nation": with_unknown(table(spark, sf, "nation").select("n_nationkey", "n_name")),
        "region": with_unknown(table(spark, sf, "region")),
    }


@query(
    "multi_role_labels",
    """
    WITH d AS (SELECT n_nationkey AS code, n_name AS name FROM nation
      UNION ALL SELECT -1, 'DESCONOCIDO'),
    f AS (SELECT nullif(c_nationkey, 3) AS origin,
        CASE WHEN s_nationkey = 5 THEN 99 ELSE s_nationkey END AS consignor, l_quantity
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
    SELECT a.name AS origin_name, b.name AS consignor_name, count(*) AS rows,
      sum(l_quantity) AS quantity
    FROM f LEFT JOIN d a ON coalesce(origin, -1) = a.code
    LEFT JOIN d b ON coalesce(consignor, -1) = b.code GROUP BY ALL
    """,
)
def multi_role_labels(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    totals = [F.sum("rows").alias("rows"), F.sum("quantity").alias("quantity")]
    origins = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.nullif("c_nationkey", F.lit(3)).alias("origin")
    )
    # Lines are added up before each further join: a supplier with many lines is then few rows, and
    # labels, which only depend on the codes, are looked up once per pair of codes.
    per_supplier = (
        lines.join(origins, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("origin", "l_suppkey")
        .agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))
    )
    consignor = F.when(F.col("s_nationkey") == 5, F.lit(99)).otherwise(F.col("s_nationkey"))
    per_pair = (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("origin", consignor.alias("consignor"))
        .agg(*totals)
    )
    roles = [
        Role("origin", "nation", "origin_name"), Role("consignor", "nation", "consignor_name")
    ]
    labelled = label_codes(per_pair, dimensions(spark, sf), roles)
    return labelled.groupBy("origin_name", "consignor_name").agg(*totals)


@query(
    "row_labels",
    """
    SELECT c_custkey, coalesce(CASE WHEN c_nationkey = 3 THEN 'DESCONOCIDO' END, n_name) AS pais,
      CASE WHEN c_nationkey % 7 = 6 THEN NULL WHEN c_nationkey % 7 = 5 THEN 'DESCONOCIDO'
        ELSE r_name END AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON c_nationkey % 7 = r_regionkey
    """,
)
def row_labels(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("pais_code"),
        F.nullif(F.col("c_nationkey") % 7, F.lit(5)).alias("region_code"),
    )
    roles = [Role("pais_code", "nation", "pais"), Role("region_code", "region", "region")]
    return label_codes(df, dimensions(spark, sf), roles).select("c_custkey", "pais", "region")


CLASSES = (
    ProductClass("trigo", ("ECO", "SM"), ("RING", "BOLT")),
    ProductClass("canola", ("LAR", "ECO"), ("GEAR", "RING")),
)


@query(
    "classify_products",
    """
    WITH p AS (SELECT p_name, nullif(p_type, 'PROMO') AS p_type, p_brand, p_size FROM part),
    u AS (
      SELECT 'trigo' AS tipo, * FROM p WHERE p_type LIKE 'ECO%' OR p_type LIKE 'SM%'
      UNION SELECT 'trigo', * FROM p WHERE upper(p_name) LIKE '%RING%' OR upper(p_name) LIKE '%BOLT%'
      UNION SELECT 'canola', * FROM p WHERE p_type LIKE 'LAR%' OR p_type LIKE 'ECO%'
      UNION SELECT 'canola', * FROM p WHERE upper(p_name) LIKE '%GEAR%' OR upper(p_name) LIKE '%RING%')
    SELECT *, CASE WHEN upper(p_name) LIKE '%BOLT%' THEN 'aceite' ELSE 'otro' END AS tipo2 FROM u
    """,
)
def classify_products(spark, sf):
    df = table(spark, sf, "part").select(
        "p_name", F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "p_brand", "p_size"
    )
    out = classify(df, CLASSES, "p_type", "p_name", "tipo")
    return out.withColumn("tipo2", text.oil_flag("p_name", "BOLT", OIL_TYPE, OTHER_TYPE))


# ---------------------------------------------------------------- ledgers and load selection


def by_period(df, day):
    return df.withColumn("period_id", keys.period_id(day))


@query(
    "ledger",
    """
    SELECT 'imports' AS trade_type, year(l_shipdate) || '-' || month(l_shipdate) AS period_id,
      count(*) AS num_records FROM lineitem GROUP BY ALL
    UNION ALL
    SELECT 'exports', year(o_orderdate) || '-' || month(o_orderdate), count(*) FROM orders GROUP BY ALL
    """,
)
def loaded_ledger(spark, sf):
    lines = by_period(table(spark, sf, "lineitem"), "l_shipdate")
    orders = by_period(table(spark, sf, "orders"), "o_orderdate")
    return ledger.sorted_ledger(ledger.loaded_ledger({"imports": lines, "exports": orders}))


LOADED_SQL = """
  o AS (SELECT *, year(o_orderdate) || '-' || month(o_orderdate) AS period_id FROM orders),
  loaded AS (SELECT period_id, count(*) AS n FROM o WHERE period_id <> '1996-3'
    AND NOT (period_id = '1997-5' AND o_orderstatus = 'F') GROUP BY ALL),
  incoming AS (SELECT period_id, count(*) AS n FROM o WHERE period_id <> '1998-7' GROUP BY ALL)
"""


def loaded_and_incoming(spark, sf):
    """A table that lacks one period and part of another, and a source that lacks a third."""
    orders = by_period(table(spark, sf, "orders"), "o_orderdate")
    period = F.col("period_id")
    cut = (period == "1997-5") & (F.col("o_orderstatus") == "F")
    return orders.filter((period != "1996-3") & ~cut), orders.filter(period != "1998-7")


def compared(spark, sf):
    loaded, incoming = loaded_and_incoming(spark, sf)
    return ledger.compare_ledgers(
        ledger.loaded_ledger({"imports": loaded}), ledger.incoming_ledger({"imports": incoming})
    )


@query(
    "ledger_compare",
    f"""
    WITH {LOADED_SQL}
    SELECT 'imports' AS trade_type, period_id, l.n AS num_records_loaded,
      i.n AS num_records_incoming
    FROM loaded l FULL JOIN incoming i USING (period_id)
    """,
)
def ledger_compare(spark, sf):
    return compared(spark, sf)


@query(
    "load_plan",
    f"""
    WITH {LOADED_SQL},
    c AS (SELECT period_id, l.n AS a, i.n AS b FROM loaded l FULL JOIN incoming i USING (period_id))
    SELECT period_id, CASE WHEN a IS NULL THEN 'load' ELSE 'replace' END AS action
    FROM c WHERE a IS NULL OR a <> b
    """,
)
def load_plan(spark, sf):
    return ledger.load_plan(compared(spark, sf)).select("period_id", "action")


@query(
    "periods_to_load",
    f"""
    WITH {LOADED_SQL}
    SELECT 'imports' AS trade_type, period_id FROM incoming
    WHERE period_id NOT IN (SELECT period_id FROM loaded)
    """,
)
def periods_to_load(spark, sf):
    return ledger.periods_to_load(compared(spark, sf))


@query(
    "periods_to_replace",
    f"""
    WITH {LOADED_SQL}
    SELECT 'imports' AS trade_type, period_id FROM incoming i JOIN loaded l USING (period_id)
    WHERE i.n <> l.n
    """,
)
def periods_to_replace(spark, sf):
    return ledger.periods_to_replace(compared(spark, sf))


@query(
    "load_selection",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE year(o_orderdate) || '-' || month(o_orderdate) IN ('1996-3', '1997-5')
    """,
)
def load_selection(spark, sf):
    _, incoming = loaded_and_incoming(spark, sf)
    chosen = ledger.only_periods(incoming, ledger.load_plan(compared(spark, sf)), "imports")
    return chosen.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "latest_year",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
    """,
)
def latest_year(spark, sf):
    orders = table(spark, sf, "orders")
    return ledger.keep_latest_year(orders, F.year("o_orderdate")).select(
        "o_orderkey", "o_totalprice"
    )


# ---------------------------------------------------------------- relational operators


@query(
    "scan",
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
    ORDER BY c_acctbal DESC, c_custkey LIMIT 50
    """,
)
def scan(spark, sf):
    return relational.scan(
        table(spark, sf, "customer"),
        columns=["c_custkey", "c_name", "c_acctbal"],
        where="c_mktsegment = 'BUILDING'",
        top=50,
        order_by=[F.desc("c_acctbal"), "c_custkey"],
    )


@query(
    "top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_n(spark, sf):
    return relational.scan(
        table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
        top=100,
        order_by=[F.desc("o_totalprice"), "o_orderkey"],
    )


@query(
    "sample_head",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY ALL LIMIT 100",
)
def sample_head(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return relational.sample_head(df, F.struct(*df.columns))


@query(
    "named_query",
    """
    SELECT o_orderpriority, count(*) AS rows FROM orders WHERE o_totalprice > 100000 GROUP BY ALL
    """,
)
def named_query(spark, sf):
    return relational.run_query(
        spark,
        "SELECT o_orderpriority, count(*) AS rows FROM {orders} WHERE o_totalprice > :least "
        "GROUP BY o_orderpriority",
        orders=table(spark, sf, "orders"),
        least=100000,
    )


@query(
    "union_by_name",
    """
    SELECT 'customer' AS side, c_nationkey AS nation, c_mktsegment AS segment, count(*) AS rows
    FROM customer GROUP BY ALL
    UNION ALL SELECT 'supplier', s_nationkey, NULL, count(*) FROM supplier GROUP BY ALL
    """,
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))
    both = relational.union_all(
        ledger.with_trade(customers, "customer", "side"),
        ledger.with_trade(suppliers, "supplier", "side"),
    )
    return both.groupBy("side", "nation", "segment").agg(F.count("*").alias("rows"))


@query(
    "delete_where",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE NOT coalesce(nullif(o_orderpriority, '5-LOW') = '2-HIGH', false)
    """,
)
def delete_where(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return relational.delete_where(df, priority == "2-HIGH")


@query(
    "display_list",
    """
    SELECT DISTINCT c_nationkey AS nation_id, c_mktsegment AS segment FROM customer
    WHERE c_acctbal > 0 ORDER BY segment, nation_id
    """,
)
def display_list(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS nation_id", "c_mktsegment AS segment", "c_acctbal"
    )
    return relational.display_list(df, "nation_id", "segment", "c_acctbal > 0")


@query(
    "typed_columns",
    """
    SELECT l_orderkey, l_linenumber AS linea, CAST(l_shipdate AS DATE)::VARCHAR AS fecha,
      CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS monto
    FROM lineitem
    """,
)
def typed_columns(spark, sf):
    landed = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("double").cast("string").alias("linea"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("fecha"),
        F.when(F.col("l_returnflag") == "R", F.lit("s/i"))
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("monto"),
    )
    spec = {"linea": "int", "fecha": "date", "monto": "double"}
    return relational.enforce_types(landed, spec, not_null=["linea"])


@query(
    "type_rejects",
    """
    SELECT CAST(0 AS BIGINT) AS linea_rejects, count(*) FILTER (l_returnflag = 'R') AS monto_rejects FROM lineitem
    """,
)
def type_rejects(spark, sf):
    landed = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("double").cast("string").alias("linea"),
        F.when(F.col("l_returnflag") == "R", F.lit("s/i"))
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("monto"),
    )
    return relational.type_rejects(landed, {"linea": "int", "monto": "double"})


@query(
    "date_bounds",
    """
    SELECT CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS date_from,
      CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS date_to FROM lineitem
    """,
)
def date_bounds(spark, sf):
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return series.date_bounds(days, "day")


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, sf):
    return series.distinct_values(table(spark, sf, "part"), "p_brand")


@query(
    "country_list",
    "SELECT 'all' AS country UNION ALL SELECT DISTINCT lower(n_name) FROM nation",
)
def country_list(spark, sf):
    return series.country_list(table(spark, sf, "nation"), "n_name")


# ---------------------------------------------------------------- catalogue


def packages(spark, sf):
    """Documents as catalogue packages: one resource per line of the text."""
    lines = F.split("text", "\n")
    resources = F.transform(
        lines, lambda line, i: F.struct(i.cast("string").alias("id"), line.alias("name"))
    )
    doc = F.col("doc_id").cast("string")
    organization = F.struct(
        F.concat(F.lit("o-"), F.col("source")).alias("id"),
        F.col("source").alias("name"),
        F.upper("source").alias("title"),
    )
    return table(spark, sf, "documents").select(
        doc.alias("id"),
        F.concat(F.lit("doc-"), doc).alias("name"),
        F.col("lang").alias("title"),
        F.col("n_chars").cast("string").alias("notes"),
        F.when(F.col("lang") != "en", organization).alias("organization"),
        F.when(F.col("lang") == "fr", F.array().cast("array<struct<id:string,name:string>>"))
        .otherwise(resources)
        .alias("resources"),
    )


FLATTEN_SQL = """
WITH l AS (SELECT *, string_split(text, chr(10)) AS lines FROM documents WHERE lang <> 'fr'),
r AS (SELECT *, unnest(lines) AS name, generate_subscripts(lines, 1) - 1 AS pos FROM l)
SELECT CAST(pos AS VARCHAR) AS id, name, CAST(doc_id AS VARCHAR) AS package_id,
  'doc-' || doc_id AS package_name, lang AS package_title, CAST(n_chars AS VARCHAR) AS package_notes,
  CASE WHEN lang <> 'en' THEN upper(source) END AS inst_title,
  CASE WHEN lang <> 'en' THEN source END AS inst_name,
  CASE WHEN lang <> 'en' THEN 'o-' || source END AS inst_id
FROM r
"""


@query("flatten", FLATTEN_SQL)
def flatten(spark, sf):
    return catalogue.flatten_catalogue(packages(spark, sf))


# ---------------------------------------------------------------- device events

DEVICE_SQL = """
  d AS (SELECT c_custkey AS device, CASE c_mktsegment WHEN 'BUILDING' THEN 'view'
    WHEN 'MACHINERY' THEN 'click' WHEN 'FURNITURE' THEN 'error' WHEN 'HOUSEHOLD' THEN 'signup'
    ELSE 'purchase' END AS mac, c_mktsegment AS subtype, c_nationkey AS gate
    FROM customer WHERE c_acctbal > 0)
"""


def devices(spark, sf):
    """Customers as registered devices, the market segment standing for address and subtype."""
    segment = F.col("c_mktsegment")
    mac = (
        F.when(segment == "BUILDING", "view")
        .when(segment == "MACHINERY", "click")
        .when(segment == "FURNITURE", "error")
        .when(segment == "HOUSEHOLD", "signup")
        .otherwise("purchase")
    )
    return table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("device_source_id"),
        mac.alias("device_mac_address"),
        segment.alias("device_subtype"),
        F.col("c_nationkey").alias("gate_id"),
    )


def device_events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("device_source_id"),
        F.col("event_type").alias("device_mac_address"),
        "value",
    )


@query(
    "authorise",
    f"""
    WITH {DEVICE_SQL}
    SELECT event_id, CASE WHEN device IS NULL THEN 0 ELSE 1 END AS authorised,
      coalesce(subtype, 'Not Applicable') AS device_subtype
    FROM events LEFT JOIN d ON user_id = device AND event_type = mac
    """,
)
def authorise(spark, sf):
    out = events.authorise(device_events(spark, sf), devices(spark, sf))
    return out.select("event_id", "authorised", "device_subtype")


@query(
    "authorised_only",
    f"""
    WITH {DEVICE_SQL}
    SELECT event_id, value FROM events
    WHERE EXISTS (SELECT 1 FROM d WHERE user_id = device AND event_type = mac)
    """,
)
def authorised_only(spark, sf):
    out = events.only_authorised(device_events(spark, sf), devices(spark, sf))
    return out.select("event_id", "value")


@query(
    "gate_lookup",
    f"""
    WITH {DEVICE_SQL},
    g AS (SELECT device, min(gate) AS gate FROM d GROUP BY ALL)
    SELECT gate AS gate_id, count(*) AS rows FROM events LEFT JOIN g ON user_id = device GROUP BY ALL
    """,
)
def gate_lookup(spark, sf):
    out = events.with_gate(device_events(spark, sf), devices(spark, sf))
    return out.groupBy("gate_id").agg(F.count("*").alias("rows"))


PLATE_SQL = """
  v AS (SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'Unknown'
    ELSE event_type || '-' || user_id END AS plate FROM events)
"""


def plates(spark, sf):
    kind = F.col("event_type")
    plate = (
        F.when(kind == "view", F.lit(None).cast("string"))
        .when(kind == "click", F.lit("Unknown"))
        .otherwise(F.concat(kind, F.lit("-"), F.col("user_id").cast("string")))
    )
    return table(spark, sf, "events").select("event_id", plate.alias("plate"))


@query(
    "plate_filled",
    f"WITH {PLATE_SQL} SELECT event_id, coalesce(plate, 'Unknown') AS plate FROM v",
)
def plate_filled(spark, sf):
    return events.vehicle_events(plates(spark, sf), "plate")


@query(
    "plate_required",
    f"WITH {PLATE_SQL} SELECT event_id, plate FROM v WHERE plate <> 'Unknown'",
)
def plate_required(spark, sf):
    return events.vehicle_events(plates(spark, sf), "plate", plate_required=True)


def removed_users(spark, sf):
    in_debt = table(spark, sf, "customer").filter("c_acctbal < 0")
    return in_debt.select(F.col("c_custkey").alias("user_id"))


IN_DEBT = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


def audited(spark, sf):
    return events.delete_with_audit(
        table(spark, sf, "events").select("event_id", "user_id", "event_type"),
        removed_users(spark, sf),
        "user_id",
        schema_name="dbo",
        table_name="events",
        category="cleanup",
        reason="left",
        username="admin",
    )


@query(
    "audit_delete",
    f"""
    SELECT 'dbo' AS schema_name, 'events' AS table_name, 'user_id' AS id_column,
      CAST(user_id AS VARCHAR) AS id_value,
      '{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
        || '"}}' AS record_json,
      'cleanup' AS category, 'left' AS reason, 'admin' AS username
    FROM events WHERE user_id IN ({IN_DEBT})
    """,
)
def audit_delete(spark, sf):
    return audited(spark, sf)[0]


@query(
    "audit_remainder",
    f"SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN ({IN_DEBT})",
)
def audit_remainder(spark, sf):
    return audited(spark, sf)[1]


@query(
    "references_cleared",
    f"""
    WITH r AS ({IN_DEBT})
    SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN o_custkey END AS entrance_id,
      CASE WHEN c_custkey IS NULL THEN o_orderstatus END AS exit_id
    FROM orders LEFT JOIN r ON o_custkey = c_custkey
    """,
)
def references_cleared(spark, sf):
    vehicles = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey AS entrance_id", "o_orderstatus AS exit_id"
    )
    return events.clear_references(
        vehicles, removed_users(spark, sf), "entrance_id", "user_id", also=["exit_id"]
    )


@query(
    "cascade",
    f"""
    WITH i AS (SELECT doc_id AS image_name, doc_id % 1000 AS device, n_chars FROM documents),
    gone AS (SELECT c_custkey AS device FROM customer WHERE c_acctbal < 0)
    SELECT 'camera_event_detection' AS table_name, count(*) AS rows, CAST(sum(event_id) AS BIGINT)
      AS ids FROM events WHERE user_id NOT IN (SELECT device FROM gone)
    UNION ALL SELECT 'camera_event_images', count(*), CAST(sum(image_name) AS BIGINT) FROM i
      WHERE device NOT IN (SELECT device FROM gone)
    UNION ALL SELECT 'image_predictions', count(*), CAST(sum(doc_id) AS BIGINT) FROM labels
      WHERE doc_id NOT IN (SELECT image_name FROM i WHERE device IN (SELECT device FROM gone))
    """,
)
def cascade(spark, sf):
    tables = {
        "camera_event_detection": table(spark, sf, "events").selectExpr("event_id AS id", "user_id"),
        "camera_event_images": table(spark, sf, "documents").selectExpr(
            "doc_id AS id", "doc_id AS image_name", "doc_id % 1000 AS user_id"
        ),
        "image_predictions": table(spark, sf, "labels").selectExpr(
            "doc_id AS id", "doc_id AS image_name"
        ),
    }
    left = events.cascade_delete(tables, removed_users(spark, sf), "user_id")
    return relational.union_all(
        *[
            df.agg(F.count("*").alias("rows"), F.sum("id").alias("ids")).select(
                F.lit(name).alias("table_name"), "rows", "ids"
            )
            for name, df in left.items()
        ]
    )


@query(
    "link",
    """
    WITH r AS (SELECT l_orderkey, max(l_partkey) AS latest FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT o_orderkey AS reference_id,
      coalesce(latest, CASE WHEN o_orderstatus = 'F' THEN -o_custkey END) AS entrance_id
    FROM orders LEFT JOIN r ON o_orderkey = l_orderkey
    """,
)
def link(spark, sf):
    own = F.when(F.col("o_orderstatus") == "F", -F.col("o_custkey"))
    vehicles = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("reference_id"), own.alias("entrance_id")
    )
    registrations = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").selectExpr(
        "l_orderkey AS reference_id", "l_partkey AS entrance_id"
    )
    return events.link_registration(vehicles, registrations, "entrance_id")
