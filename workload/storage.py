"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.operators import catalogue, ledger, relational
from aforo.plans.monthly_load import incremental_load
from aforo.session import new_path, staged
from aforo.sinks import deletes
from aforo.sinks import files as file_sinks
from aforo.sinks import tables as table_sinks
from aforo.sources import files, reference, trade
from workload.rates import PRIORITY_CODES
from workload.registry import query, table
from workload.tables import FLATTEN_SQL, loaded_and_incoming, packages

CUSTOMER_NAMES = ["C Custkey", "C-Name", " C.Nationkey ", "C_Segment"]
CUSTOMER_SQL = """
  SELECT CAST(c_custkey AS VARCHAR) AS "C_Custkey", c_name AS "C_Name",
    CAST(c_nationkey AS VARCHAR) AS "C_Nationkey", c_mktsegment AS "C_Segment" FROM customer
"""


def customer_columns(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("delimited_files", CUSTOMER_SQL)
def delimited_files(spark, sf):
    """K-07 then S-02: ``;`` text without header, named by position."""
    path = new_path(spark, "customers-csv")
    file_sinks.write_csv(customer_columns(spark, sf), path)
    return trade.read_trade(spark, path, CUSTOMER_NAMES)


@query(
    "quoted_line_ends",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "C_Custkey", c_name || chr(10) || '"' || c_mktsegment || '";' || chr(10) AS "C_Name",
      CAST(c_nationkey AS VARCHAR) AS "C_Nationkey", split_bytes
    FROM customer, (VALUES (999), (65536)) AS s(split_bytes)
    """,
)
def quoted_line_ends(spark, sf):
    """S-02 with line ends, quotes and separators inside fields, from files cut into small and large splits."""
    path = new_path(spark, "customers-lines")
    name = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('";\n'))
    rows = table(spark, sf, "customer").select("c_custkey", name.alias("c_name"), "c_nationkey")
    # Spark's writer trims values unless told not to.
    file_sinks.write_csv(rows, path, ignoreTrailingWhiteSpace="false")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    out = []
    try:
        for size in (999, 65536):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            read = trade.read_trade(spark, path, CUSTOMER_NAMES[:3]).withColumn("split_bytes", F.lit(size))
            out.append(staged(read, "quoted"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return relational.union_all(*out)


@query("positional_header", CUSTOMER_SQL)
def positional_header(spark, sf):
    landed = customer_columns(spark, sf).select(
        *[F.col(c).cast("string") for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")]
    )
    return files.apply_manifest(landed, [*CUSTOMER_NAMES, " ", None])


def _zip_writer(system, inner: str, stem: str):
    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"{stem}_{part}.zip"
        with system.open_output_stream(f"{inner}/{name}") as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(f"Importaciones_{part}.txt", "w", force_zip64=True) as member:
                    for batch in batches:
                        member.write("".join(f"{v}\n" for v in batch["value"]).encode())
                archive.writestr(f"Exportaciones_{part}.txt", "9;not;an;import\n")
                archive.writestr("leame.pdf", "no text")
        yield pd.DataFrame({"name": [name]})

    return write


@query("archive_scan", CUSTOMER_SQL)
def archive_scan(spark, sf):
    """S-03, S-06 and S-07: zip archives of two years, found by name and read by member; the older year is left."""
    folder = new_path(spark, "archives")
    system, inner = trade.file_system(folder)
    system.create_dir(inner)
    lines = customer_columns(spark, sf).select(
        "c_custkey", F.concat_ws(";", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").alias("value")
    )
    for stem, part in (("import_2020", lines.where("c_custkey % 3 = 0")), ("import_2021", lines)):
        written = part.mapInPandas(_zip_writer(system, inner, stem), "name string")
        written.write.format("noop").mode("overwrite").save()
    found = files.latest_files(files.trade_paths(spark, folder))
    return trade.read_trade_archives(spark, found, "Import", CUSTOMER_NAMES)


@query(
    "dimension_file",
    "SELECT n_nationkey AS pais_codigo, n_name || ', \"X\"' AS pais_nombre FROM nation",
)
def dimension_file(spark, sf):
    path = new_path(spark, "dimension")
    quoted = table(spark, sf, "nation").select(
        "n_nationkey", F.concat("n_name", F.lit(', "X"')).alias("n_name")
    )
    file_sinks.write_csv(quoted, path, header="true")
    return reference.read_dimension(spark, path, "pais_codigo", "pais_nombre")


@query(
    "rate_files",
    """
    SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'usd' WHEN '2-HIGH' THEN 'eur'
        WHEN '3-MEDIUM' THEN 'cad' WHEN '4-NOT SPECIFIED' THEN 'aud' ELSE 'clp' END AS currency_code,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS currency_date,
      CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS to_clp
    FROM orders
    """,
)
def rate_files(spark, sf):
    """S-05: one folder of files per currency, the currency taken from the file name."""
    folder = new_path(spark, "rates")
    system, inner = trade.file_system(folder)
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_orderstatus") != "P", F.translate(F.col("o_totalprice").cast("string"), ".", ","))
        .alias("rate"),
        "o_orderpriority",
    )
    lines = rows.select(
        F.concat("day", F.lit(";"), F.coalesce("rate", F.lit(""))).alias("value"), "o_orderpriority"
    )
    system.create_dir(inner)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        streams = {}
        for batch in batches:
            for priority, group in batch.groupby("o_orderpriority"):
                if priority not in streams:
                    name = f"{inner}/Indicador_{PRIORITY_CODES[priority]}_{part}.csv"
                    streams[priority] = system.open_output_stream(name)
                    streams[priority].write("Banco Central;\n;\nSerie diaria;\nPeriodo;Valor\n".encode())
                streams[priority].write("".join(f"{v}\n" for v in group["value"]).encode())
        for stream in streams.values():
            stream.close()
        yield pd.DataFrame({"files": [len(streams)]})

    lines.mapInPandas(write, "files int").write.format("noop").mode("overwrite").save()
    return reference.read_rates(spark, folder, decimal_comma=True)


@query("catalogue_scan", FLATTEN_SQL)
def catalogue_scan(spark, sf):
    """S-10: search pages written as JSON lines, scanned and flattened."""
    path = new_path(spark, "catalogue")
    pages = packages(spark, sf).select(
        F.struct(F.array(F.struct("*")).alias("results")).alias("result")
    )
    pages.write.json(path)
    resource = T.StructType().add("id", T.StringType()).add("name", T.StringType())
    read = reference.read_catalogue(spark, path, resource, multiline=False)
    return catalogue.flatten_catalogue(read)


ORDER_COLUMNS = ("o_orderkey", "o_totalprice", "period_id")


@query(
    "period_replace",
    """
    SELECT year(o_orderdate) || '-' || month(o_orderdate) AS period_id, count(*) AS rows,
      round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL
    """,
)
def period_replace(spark, sf):
    """K-02, K-03 and I-01..I-04: a table behind its source is brought up to date, twice."""
    loaded, incoming = (df.select(*ORDER_COLUMNS) for df in loaded_and_incoming(spark, sf))
    path = new_path(spark, "orders")
    table_sinks.append_table(loaded, path)
    for _ in range(2):
        incremental_load(spark, {"imports": path}, {"imports": incoming})
    now = spark.read.schema(incoming.schema).parquet(path)
    return now.groupBy("period_id").agg(
        F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "appended_ledger",
    """
    SELECT 'imports' AS trade_type, year(o_orderdate) || '-' || month(o_orderdate) AS period_id,
      2 * count(*) AS num_records FROM orders GROUP BY ALL
    """,
)
def appended_ledger(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.concat(F.year("o_orderdate"), F.lit("-"), F.month("o_orderdate")).alias("period_id"),
    )
    path = new_path(spark, "appended")
    table_sinks.append_table(orders, path, text_times=True)
    table_sinks.append_table(orders, path, text_times=True)
    return ledger.loaded_ledger({"imports": spark.read.parquet(path)})


@query(
    "country_folders",
    """
    SELECT lower(c_mktsegment) AS serie, c_mktsegment AS pais_nombre_origen, count(*) AS rows
    FROM customer GROUP BY ALL
    UNION ALL SELECT 'all', 'TODOS', count(*) FROM customer
    """,
)
def country_folders(spark, sf):
    """K-09: one folder per country and one for all from a single write."""
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_mktsegment AS pais_nombre_origen"
    )
    root = new_path(spark, "countries")
    everything = customers.withColumn("pais_nombre_origen", F.lit("TODOS"))
    file_sinks.export_by_country(customers, everything, root)
    return folder_rows(spark.read.parquet(root))


@query(
    "country_folders_csv",
    """
    SELECT lower(c_mktsegment) AS serie, c_mktsegment AS pais_nombre_origen, count(*) AS rows
    FROM customer GROUP BY ALL
    UNION ALL SELECT 'all', 'TODOS', count(*) FROM customer
    """,
)
def country_folders_csv(spark, sf):
    """K-09 and K-08 as text: the same folders, and a report, as ``;`` files with a header."""
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "c_mktsegment AS pais_nombre_origen")
    root = new_path(spark, "countries")
    file_sinks.export_reports({"customers": customers}, root, fmt="csv")
    schema = "c_custkey long, pais_nombre_origen string"
    report = spark.read.schema(schema).options(sep=";", header="true").csv(f"{root}/customers")
    everything = report.withColumn("pais_nombre_origen", F.lit("TODOS"))
    file_sinks.export_by_country(report, everything, f"{root}/series", fmt="csv")
    return folder_rows(spark.read.schema(f"{schema}, serie string").options(sep=";", header="true").csv(f"{root}/series"))


def folder_rows(back):
    return back.groupBy("serie", "pais_nombre_origen").agg(F.count("*").alias("rows"))


@query(
    "report_export",
    """
    SELECT 'orders' AS report, o_orderkey AS id FROM orders
    UNION ALL SELECT 'parts', p_partkey FROM part
    """,
)
def report_export(spark, sf):
    """K-08: named reports to their folders."""
    root = new_path(spark, "reports")
    reports = {
        "orders": table(spark, sf, "orders").selectExpr("o_orderkey AS id"),
        "parts": table(spark, sf, "part").selectExpr("p_partkey AS id"),
    }
    file_sinks.export_reports(reports, root)
    return relational.union_all(
        *[
            ledger.with_trade(spark.read.parquet(f"{root}/{name}"), name, "report")
            for name in reports
        ]
    )


@query(
    "views_registered",
    "SELECT o_orderstatus, count(*) AS rows FROM orders WHERE o_totalprice > 200000 GROUP BY ALL",
)
def views_registered(spark, sf):
    """K-06 and S-09: a plan under a name, used from SQL."""
    big = table(spark, sf, "orders").filter("o_totalprice > 200000")
    table_sinks.register_views({"vw_big_orders": big})
    return relational.run_query(
        spark, "SELECT o_orderstatus, count(*) AS rows FROM vw_big_orders GROUP BY o_orderstatus"
    )


def new_table(name):
    return f"{name}_{uuid.uuid4().hex}"


@query("table_refresh", "SELECT s_suppkey, s_acctbal FROM supplier")
def table_refresh(spark, sf):
    """K-01 and K-05: loading a second time leaves the rows there once."""
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    name, path = new_table("supplier_copy"), new_path(spark, "supplier-copy")
    table_sinks.refresh_table(suppliers, name, path)
    return table_sinks.materialize(suppliers, name, path)


@query(
    "table_delete",
    """
    SELECT c_custkey, segment FROM (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment
      FROM customer) WHERE NOT coalesce(segment = 'BUILDING', false)
    """,
)
def table_delete(spark, sf):
    """K-04 on a partitioned catalog table: a NULL in the predicate keeps its row."""
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment")
    )
    name = new_table("customer_copy")
    table_sinks.refresh_table(customers, name, new_path(spark, "customer-copy"), ["segment"])
    deletes.delete_from(spark, name, "segment = 'BUILDING'")
    return spark.table(name)


@query(
    "path_delete",
    """
    SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
    WHERE NOT coalesce(nullif(c_nationkey, 5) % 7 = 3 AND c_mktsegment <> 'FURNITURE', false)
    """,
)
def path_delete(spark, sf):
    """K-04 on a partitioned path table: files and partitions without matching rows stay as they are."""
    path = new_path(spark, "customers")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    table_sinks.append_table(customers, path, "c_mktsegment")
    deletes.delete_rows(spark, path, "nullif(c_nationkey, 5) % 7 = 3 AND c_mktsegment <> 'FURNITURE'")
    return spark.read.schema(customers.schema).parquet(path)


@query(
    "country_list_file",
    "SELECT 'all' AS country UNION ALL SELECT DISTINCT lower(c_mktsegment) FROM customer",
)
def country_list_file(spark, sf):
    """K-10: the list as a JSON file."""
    path = new_path(spark, "country-list")
    file_sinks.write_country_list(table(spark, sf, "customer"), path, "c_mktsegment")
    return spark.read.schema("country string").json(path)


@query(
    "sample_file",
    """
    SELECT o_orderkey || ';' || o_orderpriority AS value FROM orders ORDER BY o_orderkey LIMIT 100
    """,
)
def sample_file(spark, sf):
    """K-11: the first records as a text file."""
    path = new_path(spark, "sample")
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("line_no"), F.concat_ws(";", "o_orderkey", "o_orderpriority").alias("value")
    )
    file_sinks.write_sample(records, path, "line_no")
    return spark.read.text(path)
