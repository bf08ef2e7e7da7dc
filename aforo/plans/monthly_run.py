"""The whole monthly run: archives in, tables, reports and series out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from aforo import fixed_values as fx
from aforo.operators.rates import currency_converter
from aforo.operators.series import chart_feed
from aforo.plans import reports
from aforo.plans.cleaned_tables import refresh_cleaned, version_of
from aforo.plans.monthly_load import LoadResult, load_periods, plan_load, refresh_reports_if
from aforo.plans.price_series import price_series
from aforo.session import drop_path, new_path, staged
from aforo.sinks.files import export_by_country, export_reports, write_country_list
from aforo.sinks.tables import materialize, register_path, replace_table
from aforo.sources import landing
from aforo.sources.files import latest_files, read_manifest, trade_paths
from aforo.sources.reference import rate_rejects, read_dimensions, read_rates
from aforo.sources.trade import read_trade_archives

EXPORTED_VIEWS = ("vw_imports_canola_trigo", "vw_exports_canola_trigo")
REPORT_VIEW = "vw_imports_canola_report"
SPECS = {"imports": reports.IMPORTS, "exports": reports.EXPORTS}


@dataclass(frozen=True)
class Layout:
    """Where a run reads and writes; ``database`` holds the catalog tables.

    With ``strict`` a date key that is no date fails the run instead of being rejected.
    """

    archives: str
    import_names: str
    export_names: str
    dimensions: str
    rates: str
    facts: str
    output: str
    database: str = "default"
    sample: bool = False
    decimal_comma: bool = False
    strict: bool = False

    def fact_paths(self) -> dict[str, str]:
        return {t: f"{self.facts}/{t}" for t in SPECS}

    def manifest(self) -> str:
        """Where it is written which archives were landed, and the rows of each period they hold."""
        return f"{self.facts}/manifest"

    def cleaned(self, trade: str) -> str:
        """Where the cleaned rows of ``imports`` or ``exports`` lie, by period."""
        return f"{self.output}/cleaned/{trade}_raw"

    def rejects(self, name: str) -> str:
        """Where the rejected values of ``imports``, ``exports`` or ``rates`` are written."""
        return f"{self.output}/rejects/{name}"


def land(spark: SparkSession, layout: Layout, folder: str, archives: DataFrame) -> dict[str, DataFrame]:
    """The declarations of the archives as text, written below ``folder``, with the archive in ``path``.

    A member of an archive can only be read from its start by one task, so the parsed text is
    staged as Parquet once. The ledger then reads the date key only, and filters on keys do not
    parse the records again.
    """
    out = {}
    for table, prefix, names in (
        ("imports", "Import", layout.import_names),
        ("exports", "Export", layout.export_names),
    ):
        # A zip may hold both kinds; the member name decides.
        landed = read_trade_archives(spark, archives, prefix, read_manifest(spark, names), keep=["path"])
        landed.write.parquet(f"{folder}/{table}")
        out[table] = spark.read.schema(landed.schema).parquet(f"{folder}/{table}")
    return out


def write_rejects(spark: SparkSession, layout: Layout, found: DataFrame, landed: dict[str, DataFrame]) -> None:
    """Every value of the present archives that the load drops or nulls, with its archive.

    Those of archives that were not landed this time are kept, those of archives that are gone or replaced are not.
    """
    for trade, df in landed.items():
        rejects = reports.load_rejects(df, SPECS[trade], ["path"])
        read = df.select("path").distinct()
        try:
            earlier = spark.read.schema(rejects.schema).parquet(layout.rejects(trade))
            earlier = earlier.join(found, "path", "left_semi").join(read, "path", "left_anti")
            rejects = rejects.unionByName(earlier)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        replace_table(rejects, layout.rejects(trade))
    rates = rate_rejects(spark, layout.rates, decimal_comma=layout.decimal_comma)
    rates.write.mode("overwrite").parquet(layout.rejects("rates"))


def load_archives(spark: SparkSession, layout: Layout, folder: str) -> LoadResult:
    """Bring the fact tables up to date with the archives of the latest year.

    The manifest tells which archives were landed before and what they hold, so a run unpacks those that are new or
    replaced and, of the others, those with rows of a period that is loaded. It is written last: a run that fails is
    repeated by the next one.
    """
    found = latest_files(trade_paths(spark, layout.archives, layout.sample)).select(*landing.VERSION)
    found = staged(found.distinct(), "archives")
    known = staged(landing.unchanged(found, landing.read_manifest_table(spark, layout.manifest())), "known")
    fresh = staged(landing.new_archives(found, known), "fresh")
    first = land(spark, layout, f"{folder}/fresh", fresh)
    facts = {t: reports.derive_keys(df, SPECS[t], layout.strict) for t, df in first.items()}
    counts = staged(landing.counted(fresh, facts), "counts")
    like = {t: df.drop("path") for t, df in facts.items()}
    periods = plan_load(spark, layout.fact_paths(), like, landing.manifest_ledger(known, counts))
    again = staged(landing.archives_of(known, periods), "again")
    landed = first
    if not again.isEmpty():
        more = land(spark, layout, f"{folder}/again", again)
        landed = {t: df.unionByName(more[t]) for t, df in first.items()}
    write_rejects(spark, layout, found, landed)
    whole = {t: reports.derive_keys(df, SPECS[t], layout.strict).drop("path") for t, df in landed.items()}
    result = load_periods(layout.fact_paths(), whole, periods)
    landing.write_manifest(known.unionByName(counts), layout.manifest())
    return result


def refresh_reference(
    spark: SparkSession, layout: Layout, as_of: date | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Reload the dimensions and the daily rates in place, so nothing is there twice."""
    dims = {
        name: materialize(dim, f"{layout.database}.aduana_codigos_{name}")
        for name, dim in read_dimensions(spark, layout.dimensions, fx.DIMENSIONS).items()
    }
    raw = read_rates(spark, layout.rates, decimal_comma=layout.decimal_comma)
    converter = currency_converter(
        raw,
        fx.RATE_CURRENCIES,
        as_of,
        horizon=fx.FORECAST_DAYS,
        short_horizon=fx.FORECAST_DAYS_SHORT,
        lag_days=fx.FORECAST_LAG_DAYS,
    )
    return dims, materialize(converter, f"{layout.database}.currency_converter")


def refresh_raw(
    spark: SparkSession, layout: Layout, trade: str, dims: dict[str, DataFrame]
) -> DataFrame:
    """The cleaned table ``imports_raw`` or ``exports_raw``, with the periods rebuilt that changed."""
    make = {"imports": reports.imports_raw, "exports": reports.exports_raw}[trade]
    facts, path = layout.fact_paths()[trade], layout.cleaned(trade)
    # The columns of the result stand for the rules that made them; a change of either rebuilds every period.
    version = version_of(dims, (SPECS[trade], make(spark.read.parquet(facts), dims).schema.simpleString()))
    refresh_cleaned(spark, facts, lambda rows: make(rows, dims), path, version, spread=False)
    return register_path(spark, f"{layout.database}.{trade}_raw", path)


def rebuild_reports(
    spark: SparkSession, layout: Layout, dims: dict[str, DataFrame], converter: DataFrame
) -> dict[str, DataFrame]:
    """Cleaned tables (their changed periods), the four views, their exports, the series and the country list."""
    raws = tuple(refresh_raw(spark, layout, trade, dims) for trade in SPECS)
    views = reports.register_report_views(*raws, converter)
    export_reports({name: views[name] for name in EXPORTED_VIEWS}, layout.output)

    # The report is a part of the view that was just written: no second pass over the cleaned table.
    view = spark.read.parquet(f"{layout.output}/vw_imports_canola_trigo")
    export_reports({REPORT_VIEW: reports.imports_report(view, converter)}, layout.output)

    report = spark.read.parquet(f"{layout.output}/{REPORT_VIEW}")
    countries, everything = price_series(report)
    export_by_country(countries, everything, f"{layout.output}/series")
    feed = chart_feed(countries.unionByName(everything), fx.ALL_COUNTRIES)
    export_reports({"charts": feed}, layout.output)
    write_country_list(countries, f"{layout.output}/imports_countries")
    return views


def monthly_run(
    spark: SparkSession, layout: Layout, as_of: date | None = None, always_rebuild: bool = False
) -> LoadResult:
    """Load what is new or incomplete, then rebuild the reports if anything was loaded.

    ``always_rebuild`` is for a run that follows one which failed between loading and reporting.
    What the load drops or nulls is below ``layout.rejects(...)``; the landed text is removed at the end.
    """
    dims, converter = refresh_reference(spark, layout, as_of)
    folder = new_path(spark, "landed")
    try:
        result = load_archives(spark, layout, folder)
    finally:
        drop_path(spark, folder)
    if always_rebuild:
        rebuild_reports(spark, layout, dims, converter)
    else:
        refresh_reports_if(result, lambda: rebuild_reports(spark, layout, dims, converter))
    return result
