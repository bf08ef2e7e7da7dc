"""From landed declarations to the cleaned tables and the four report views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo import fixed_values as fx
from aforo.functions import amounts, keys, text
from aforo.operators.classify import ProductClass, classify, in_any_class
from aforo.operators.labels import EXPORT_ROLES, IMPORT_ROLES, Role, label_codes
from aforo.operators.rates import with_monthly_rates
from aforo.operators.relational import enforce_types, typed
from aforo.sinks.tables import register_views

PRODUCT_CLASSES = (
    ProductClass(fx.WHEAT_CLASS, fx.WHEAT_PREFIXES, fx.WHEAT_WORDS),
    ProductClass(fx.CANOLA_CLASS, fx.CANOLA_PREFIXES, fx.CANOLA_WORDS),
)
# The 8-digit tariff that cleaned tables hold beside the written one.
TARIFF_KEY = "ARANCEL_8"
RATES = ("to_clp", *[f"to_{c}" for c in fx.RATE_CURRENCIES])


@dataclass(frozen=True)
class TradeSpec:
    """Column roles and rule lists of one trade table; the plans below hold no names themselves."""

    trade: str
    date_key: str
    date_first_eight: bool
    document: str
    item: str
    code_columns: tuple[str, ...]
    sentinels: Mapping[str, int]
    amounts: tuple[str, ...]
    roles: tuple[Role, ...]
    description: tuple[str, ...]
    tariff: str
    product: str
    quantity: str
    excluded_words: Mapping[str, Sequence[str]]
    excluded_tariffs: tuple[str, ...]
    transport: str
    unit: str
    numeric_code: str | None = None
    report_excluded_words: Mapping[str, Sequence[str]] = field(default_factory=dict)
    min_value: tuple[str, str, float] | None = None
    classes: tuple[ProductClass, ...] = PRODUCT_CLASSES
    min_quantity: float = fx.MIN_QUANTITY
    oil_word: str = fx.OIL_WORD
    report_class: str = fx.CANOLA_CLASS
    report_transports: tuple[int, ...] = fx.REPORT_TRANSPORTS
    report_unit: int = fx.REPORT_UNIT
    report_min_quantity: float = fx.REPORT_MIN_QUANTITY
    seed_patterns: tuple[str, ...] = fx.SEED_PATTERNS
    seed_quantity_below: float = fx.SEED_QUANTITY_BELOW

    def code_types(self) -> dict[str, str]:
        """Types of the codes without a sentinel; a date key may have more digits than an int holds."""
        plain = [c for c in self.code_columns if c not in self.sentinels]
        return {c: "bigint" if c == self.date_key else "int" for c in plain}


IMPORTS = TradeSpec(
    trade="Imports",
    date_key="FECTRA",
    date_first_eight=False,
    document="NUMENCRIPTADO",
    item="NUMITEM",
    code_columns=fx.IMPORT_CODES,
    sentinels=fx.IMPORT_SENTINELS,
    amounts=fx.IMPORT_AMOUNTS,
    roles=IMPORT_ROLES,
    description=fx.IMPORT_DESCRIPTION,
    tariff="ARANC_NAC",
    product="DNOMBRE",
    quantity="CANT_MERC_MOD",
    excluded_words=fx.IMPORT_EXCLUDED_WORDS,
    excluded_tariffs=fx.IMPORT_EXCLUDED_TARIFFS,
    transport="VIA_TRAN",
    unit="MEDIDA",
    report_excluded_words={"DESOBS1": fx.IMPORT_REPORT_EXCLUDED_WORDS},
    min_value=("FOB_MOD", "to_usd", fx.REPORT_MIN_FOB_USD),
)
EXPORTS = TradeSpec(
    trade="Exports",
    date_key="FECHAACEPT",
    date_first_eight=True,
    document="NUMEROIDENT",
    item="NUMEROITEM",
    code_columns=fx.EXPORT_CODES,
    sentinels=fx.EXPORT_SENTINELS,
    amounts=fx.EXPORT_AMOUNTS,
    roles=EXPORT_ROLES,
    description=fx.EXPORT_DESCRIPTION,
    tariff="CODIGOARANCEL",
    product="NOMBRE",
    quantity="CANTIDADMERCANCIA_MOD",
    excluded_words=fx.EXPORT_EXCLUDED_WORDS,
    excluded_tariffs=fx.EXPORT_EXCLUDED_TARIFFS,
    transport="VIATRANSPORTE",
    unit="UNIDADMEDIDA",
    numeric_code="ADUANA",
)


def match_columns(df: DataFrame, spec: TradeSpec) -> dict[str, Column]:
    """What the rules look at, to be stored in the cleaned table: the tariff as 8 digits and texts in upper case.

    Rules on bare columns reach the scan, so a stored table skips row groups by tariff prefix.
    """
    texts = {spec.product, *spec.excluded_words, *spec.report_excluded_words}
    tariff = keys.normalize_tariff(spec.tariff, keys.kind_of(spec.tariff, df.schema))
    return {TARIFF_KEY: tariff, **text.upper_columns(sorted(texts))}


def derive_keys(landed: DataFrame, spec: TradeSpec, strict: bool = False) -> DataFrame:
    """Landed text to the fact table: ``fecha``, ``period_id``, ``reference_id`` and integer codes.

    Rows without a date key or with one that is no date are dropped, or the latter fail the job with
    ``strict``; :func:`load_rejects` lists them with all other values that the load cannot use.
    """
    fecha = keys.parse_ddmmyyyy(spec.date_key, spec.date_first_eight, strict)
    df = landed.withColumn("fecha", fecha)
    df = keys.drop_undated(df, "fecha").withColumns(
        {
            "period_id": keys.period_id("fecha"),
            "reference_id": keys.reference_id(spec.document, spec.item, schema=landed.schema),
        }
    )
    df = enforce_types(keys.fill_codes(df, spec.sentinels), spec.code_types())
    return keys.numeric_aduana(df, spec.numeric_code) if spec.numeric_code else df


def undated_rejects(landed: DataFrame, spec: TradeSpec) -> DataFrame:
    """Landed rows that have a date key which is no date."""
    fecha = keys.parse_ddmmyyyy(spec.date_key, spec.date_first_eight)
    return keys.drop_undated(landed, spec.date_key).filter(fecha.isNull())


def load_rejects(landed: DataFrame, spec: TradeSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Every landed value that the load cannot use: record, column, text, reason, and if its row is dropped.
    ``keep`` names columns of the landed rows that go along.

    A date key that is missing or no date and a customs code without digits drop the row; a code that
    is no integer and an amount that is no number are NULL in it.
    """

    def fault(column: str, reason: str, failed: Column, dropped: bool = False) -> Column:
        return F.when(
            failed,
            F.struct(
                F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("raw"),
                F.lit(reason).alias("reason"),
                F.lit(dropped).alias("row_dropped"),
            ),
        )

    day = F.col(spec.date_key)
    dated = keys.parse_ddmmyyyy(spec.date_key, spec.date_first_eight).isNotNull()
    found = [
        fault(spec.date_key, "missing", day.isNull(), dropped=True),
        fault(spec.date_key, "no date", day.isNotNull() & ~dated, dropped=True),
    ]
    codes = {c: typed(F.col(c), t) for c, t in spec.code_types().items()}
    codes |= {c: keys.fill_code(c, value) for c, value in spec.sentinels.items()}
    if spec.numeric_code:
        digits = keys.only_digits(codes.pop(spec.numeric_code, F.col(spec.numeric_code)))
        found.append(fault(spec.numeric_code, "no digits", ~F.coalesce(digits, F.lit(False)), dropped=True))
    for c, value in codes.items():
        failed = F.col(c).isNotNull() & value.isNull()
        found.append(fault(c, "no integer", failed & dated if c == spec.date_key else failed))
    for c in spec.amounts:
        found.append(fault(c, "no amount", amounts.clean_amount(c).isNull()))
    return landed.select(
        keys.reference_id(spec.document, spec.item, schema=landed.schema).alias("reference_id"),
        # Not compacted first: the filter that Spark infers from it would repeat all rules in one method.
        F.explode(F.array(*found)).alias("fault"),
        *keep,
    ).filter(F.col("fault").isNotNull()).select(*keep, "reference_id", "fault.*")


def cleaned(facts: DataFrame, dims: Mapping[str, DataFrame], spec: TradeSpec) -> DataFrame:
    """The fact table with clean amounts, labels, month, full description and match columns; all columns stay."""
    matched = match_columns(facts, spec)
    df = amounts.clean_amounts(facts, list(spec.amounts))
    df = label_codes(df, dims, spec.roles)
    return df.withColumns(
        {
            "fecha_month": keys.month_start("fecha"),
            "DESC_COMPLETA": text.full_description(*spec.description),
            **matched,
        }
    )


def imports_raw(imports: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return cleaned(imports, dims, IMPORTS).withColumns(
        {
            "PRE_UNIT_UOM": text.unit_label("moneda_nombre", "unidad_nombre"),
            "PRE_UNIT_CIF": amounts.unit_price_cif("CIF_ITEM_MOD", "CANT_MERC_MOD"),
        }
    )


def exports_raw(exports: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return cleaned(exports, dims, EXPORTS)


def trade_view(
    raw: DataFrame, spec: TradeSpec, classes: Sequence[str] | None = None
) -> DataFrame:
    """Classified products without the excluded ones, with trade type and sub-type.

    All rules look at one row and stand before the distinct, the class test, which leaves few rows,
    first: only what passes everything is shuffled. They use the stored match columns of a cleaned table, which the
    view itself leaves out. ``classes`` names the product classes that are wanted; rows of no other class
    reach the distinct.
    """
    stored = [c for c in match_columns(raw, spec) if c in raw.columns]
    tariff = F.col(TARIFF_KEY) if TARIFF_KEY in stored else match_columns(raw, spec)[TARIFF_KEY]
    listed = [c.zfill(8) for c in spec.excluded_tariffs]
    wanted = [c for c in spec.classes if classes is None or c.name in classes]
    product, is_upper = text.match_column(raw, spec.product)
    df = raw.filter(in_any_class(wanted, tariff, F.col(product), is_upper))
    df = text.exclude_codes(text.exclude_keywords(df, spec.excluded_words), tariff, listed)
    df = df.filter(F.col(spec.quantity) > F.lit(spec.min_quantity)).withColumns(
        {
            "TRADE_TYPE": F.lit(spec.trade),
            "TIPO2": text.oil_flag(product, spec.oil_word, fx.OIL_TYPE, fx.OTHER_TYPE, is_upper),
        }
    )
    return classify(df, wanted, tariff, spec.product, "TIPO", leave_out=stored)


def report_source(raw: DataFrame, spec: TradeSpec) -> DataFrame:
    """The part of the trade view that the report looks at: its own product class, and of that only its scope.

    The scope looks at one row, so rows outside it are left out before the distinct, which is a shuffle.
    """
    return trade_view(raw.filter(_in_scope(spec)), spec, (spec.report_class,))


def _in_scope(spec: TradeSpec) -> Column:
    """The conditions of :func:`report_scope` on columns that the cleaned table has, too."""
    return (
        F.col(spec.transport).isin(*spec.report_transports)
        & (F.col(spec.unit) == spec.report_unit)
        & (F.col(spec.quantity) > spec.report_min_quantity)
    )


def report_scope(view: DataFrame, spec: TradeSpec) -> DataFrame:
    """The report class without oil, by the report transports, in its unit and above its quantity."""
    df = view.filter((F.col("TIPO") == spec.report_class) & (F.col("TIPO2") != fx.OIL_TYPE) & _in_scope(spec))
    words = spec.report_excluded_words
    return text.exclude_keywords(df, words) if words else df


def trade_report(view: DataFrame, converter: DataFrame, spec: TradeSpec) -> DataFrame:
    """Report rows with currency code, seed flag and the monthly rates of their currency.

    With a minimum value only rows whose converted value is known and above it stay; without one,
    rows of currencies without rates stay with NULL rates.
    """
    df = report_scope(view, spec).withColumns(
        {
            "currency_code": keys.currency_code("MONEDA", fx.CURRENCY_NUMBERS),
            "is_siembra": text.is_seed(
                "DESC_COMPLETA", spec.quantity, spec.seed_patterns, spec.seed_quantity_below
            ),
        }
    )
    codes = list(fx.CURRENCY_NUMBERS.values())
    df = with_monthly_rates(df, converter, codes, RATES, "fecha_month")
    if spec.min_value:
        amount, rate, least = spec.min_value
        df = df.filter(F.col(amount).cast("double") * F.col(rate) > F.lit(float(least)))
    return df


def imports_report(view: DataFrame, converter: DataFrame) -> DataFrame:
    return trade_report(view, converter, IMPORTS)


def exports_report(view: DataFrame, converter: DataFrame) -> DataFrame:
    return trade_report(view, converter, EXPORTS)


def report_views(
    imports_raw_table: DataFrame, exports_raw_table: DataFrame, converter: DataFrame
) -> dict[str, DataFrame]:
    """The four views by name, from the materialized cleaned tables."""
    return {
        "vw_imports_canola_trigo": trade_view(imports_raw_table, IMPORTS),
        "vw_exports_canola_trigo": trade_view(exports_raw_table, EXPORTS),
        "vw_imports_canola_report": imports_report(report_source(imports_raw_table, IMPORTS), converter),
        "vw_exports_canola_report": exports_report(report_source(exports_raw_table, EXPORTS), converter),
    }


def register_report_views(*tables: DataFrame) -> dict[str, DataFrame]:
    views = report_views(*tables)
    register_views(views)
    return views
