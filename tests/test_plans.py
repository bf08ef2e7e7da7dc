from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from frames import rows

from aforo import fixed_values as fx
from aforo.plans import price_series as prices
from aforo.plans import reports

IMPORT_ROW = {
    "FECTRA": "5032021", "NUMENCRIPTADO": "77", "NUMITEM": "1", "DNOMBRE": "SEMILLA DE CANOLA",
    "DMARCA": "S/M", "DVARIEDAD": "GRANO", "DOTRO1": None, "DOTRO2": "A GRANEL", "ARANC_NAC": "12051000",
    "DESOBS1": "SIN OBS", "CIF": "1", "CIF_ITEM": "10000,50", "FOB": "9000", "CANT_MERC": "20000",
    "PRE_UNIT": "0,45", "FLETE": "", "MON_OTRO": None, "SEGURO": "x", "TOT_PESO": "1",
    "ADU": 1, "CL_COMPRA": 1, "TIPO_DOCTO": 1, "MONEDA": 13, "PA_ORIG": 1, "PA_ADQ": None,
    "CODPAISCON": 999, "CODPAISCIA": 1, "PTO_EMB": 1, "PTO_DESEM": 1, "VIA_TRAN": 1, "MEDIDA": 6,
}
EXPORT_ROW = {
    "FECHAACEPT": "15032021", "NUMEROIDENT": "88", "NUMEROITEM": "2", "NOMBRE": "RAPS",
    "ATRIBUTO1": "GRANO", **{f"ATRIBUTO{i}": None for i in range(2, 7)}, "CODIGOARANCEL": "12051000",
    **{c: "6000,5" for c in fx.EXPORT_AMOUNTS},
    "ADUANA": "1.0", "MONEDA": None, "PAISCIATRANSP": None, "VIATRANSPORTE": "7.0", "UNIDADMEDIDA": "6.0",
}


def frame(spark, base, variants):
    data = [{**base, **v} for v in variants]
    ints = [k for k, v in base.items() if isinstance(v, int)]
    ddl = ", ".join(f"{k} {'int' if k in ints or k == 'PA_ADQ' else 'string'}" for k in base)
    return spark.createDataFrame([tuple(d[k] for k in base) for d in data], ddl)


def dims(spark):
    table = spark.createDataFrame([(-1, "DESCONOCIDO"), (1, "UNO"), (6, "KN"), (7, "SIETE"), (13, "DOLAR")],
                                  "code int, name string")
    return {name: table for name in fx.DIMENSIONS}


def converter(spark):
    return spark.createDataFrame(
        [("usd", date(2021, 3, 1), 700.0, 1.0, 0.9, 1.25, 1.4), ("usd", date(2021, 3, 9), 720.0, 1.0, 0.9, 1.27, 1.4)],
        "currency_code string, currency_date date, to_clp double, to_usd double, to_eur double, "
        "to_cad double, to_aud double",
    )


def imports_raw(spark, variants):
    landed = frame(spark, IMPORT_ROW, variants)
    return reports.imports_raw(reports.derive_keys(landed, reports.IMPORTS), dims(spark))


def test_imports_raw(spark):
    row = imports_raw(spark, [{}]).first()
    assert (row.fecha, row.period_id, row.reference_id) == (date(2021, 3, 5), "2021-3", "77-1")
    assert row.fecha_month == date(2021, 3, 1)
    assert row.CIF_ITEM_MOD == Decimal("10000.50") and row.FLETE_MOD == 0 and row.SEGURO_MOD == 0
    assert row.DESC_COMPLETA == "SEMILLA DE CANOLA S/M GRANO  A GRANEL"
    assert row.PRE_UNIT_UOM == "DOLAR / KN"
    assert row.PRE_UNIT_CIF == Decimal("0.500025000000000000")
    assert (row.pais_nombre_origen, row.pais_nombre_adquisicion) == ("UNO", "DESCONOCIDO")
    assert row.pais_nombre_consignante is None


def test_missing_unit_and_dates(spark):
    raw = imports_raw(spark, [{"MEDIDA": None}, {"FECTRA": None}, {"FECTRA": "31022021"}])
    assert [(r.MEDIDA, r.unidad_nombre) for r in raw.collect()] == [(999, None)]
    landed = frame(spark, IMPORT_ROW, [{"FECTRA": None}, {"FECTRA": "31022021"}, {}])
    assert [r.FECTRA for r in reports.undated_rejects(landed, reports.IMPORTS).collect()] == ["31022021"]


def view_keys(view):
    return sorted((r.NUMITEM, r.TIPO) for r in view.collect())


def test_import_view_rules(spark):
    variants = [
        {"NUMITEM": "ok"}, {"NUMITEM": "ok"},
        {"NUMITEM": "both", "ARANC_NAC": "10019900"},
        {"NUMITEM": "word", "DNOMBRE": "ACEITE DE RAPS", "ARANC_NAC": "99999999"},
        {"NUMITEM": "unrelated", "DNOMBRE": "SILLA", "ARANC_NAC": "94010000"},
        {"NUMITEM": "excluded word", "DNOMBRE": "CANOLA MEZCLA"},
        {"NUMITEM": "null obs", "DESOBS1": None},
        {"NUMITEM": "null brand", "DMARCA": None},
        {"NUMITEM": "null tariff", "ARANC_NAC": None},
        {"NUMITEM": "listed tariff", "ARANC_NAC": "7129099"},
        {"NUMITEM": "listed float", "ARANC_NAC": "10063010.0"},
        {"NUMITEM": "ginger", "ARANC_NAC": "9101100", "DNOMBRE": "JENGIBRE"},
        {"NUMITEM": "little", "CANT_MERC": "2"},
    ]
    view = reports.trade_view(imports_raw(spark, variants), reports.IMPORTS)
    assert view_keys(view) == sorted([
        ("ok", "canola"), ("both", "canola"), ("both", "trigo"), ("word", "canola"), ("ginger", "trigo"),
    ])
    assert {r.NUMITEM: r.TIPO2 for r in view.collect()}["word"] == "aceite"


def test_import_report(spark):
    variants = [
        {"NUMITEM": "ok"},
        {"NUMITEM": "seed word", "DVARIEDAD": "PARA SIEMBRA"},
        {"NUMITEM": "seed quantity", "CANT_MERC": "4999"},
        {"NUMITEM": "clp", "MONEDA": 200},
        {"NUMITEM": "cheap", "FOB": "1000"},
        {"NUMITEM": "air", "VIA_TRAN": 4},
        {"NUMITEM": "unit", "MEDIDA": 10},
        {"NUMITEM": "boxes", "DESOBS1": "EN CAJAS"},
        {"NUMITEM": "oil", "DNOMBRE": "ACEITE DE CANOLA"},
        {"NUMITEM": "no rate", "FECTRA": "5042021"},
    ]
    view = reports.trade_view(imports_raw(spark, variants), reports.IMPORTS)
    report = reports.trade_report(view, converter(spark), reports.IMPORTS)
    got = {r.NUMITEM: (r.currency_code, r.is_siembra, r.to_clp, r.to_cad) for r in report.collect()}
    assert got == {
        "ok": ("usd", 0, 710.0, 1.26), "seed word": ("usd", 1, 710.0, 1.26),
        "seed quantity": ("usd", 1, 710.0, 1.26),
    }


def test_exports(spark):
    landed = frame(spark, EXPORT_ROW, [
        {"NUMEROITEM": "ok", "MONEDA": "13.0"}, {"NUMEROITEM": "no customs", "ADUANA": None},
        {"NUMEROITEM": "text customs", "ADUANA": "A1"}, {"NUMEROITEM": "other money"},
        {"NUMEROITEM": "no attribute", "ATRIBUTO1": None},
    ])
    raw = reports.exports_raw(reports.derive_keys(landed, reports.EXPORTS), dims(spark))
    assert {r.NUMEROITEM for r in raw.collect()} == {"ok", "other money", "no attribute"}
    first = raw.filter("NUMEROITEM = 'other money'").first()
    # The real acceptance date and the record key are both there.
    assert (first.FECHAACEPT, first.reference_id, first.period_id) == (15032021, "88-other money", "2021-3")
    assert (first.MONEDA, first.PAISCIATRANSP, first.paisciatransp_nombre) == (900, 999, None)
    views = reports.register_report_views(imports_raw(spark, [{}]), raw, converter(spark))
    report = views["vw_exports_canola_report"]
    got = {r.NUMEROITEM: (r.currency_code, r.to_usd) for r in report.collect()}
    assert got == {"ok": ("usd", 1.0), "other money": ("other", None)}
    assert spark.sql("SELECT count(*) FROM vw_imports_canola_report").first()[0] == 1


def test_report_scans_the_table_once(spark, tmp_path):
    imports_raw(spark, [{}]).write.parquet(f"{tmp_path}/raw")
    view = reports.trade_view(spark.read.parquet(f"{tmp_path}/raw"), reports.IMPORTS)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    # The exclusions run below the distinct, on the scan side of its exchange.
    assert plan.rindex("CANNABOOST") > plan.rindex("Exchange hashpartitioning")


def test_price_series(spark):
    variants = [
        {"NUMITEM": "1"}, {"NUMITEM": "2", "CANT_MERC": "10050", "PRE_UNIT": "0,55"},
        {"NUMITEM": "3", "FECTRA": "5052021", "PA_ORIG": 7, "CANT_MERC": "9950"},
        {"NUMITEM": "seed", "CANT_MERC": "200"},
    ]
    view = reports.trade_view(imports_raw(spark, variants), reports.IMPORTS)
    rates = converter(spark).union(
        converter(spark).replace({}).selectExpr(
            "currency_code", "add_months(currency_date, 2)", "to_clp", "to_usd", "to_eur", "to_cad", "to_aud"
        )
    )
    report = reports.trade_report(view, rates, reports.IMPORTS)
    countries, everything = prices.price_series(report)
    got = {(str(r.fecha_month), r.pais_nombre_origen): r for r in countries.collect()}
    assert sorted(got) == [
        (m, c) for m in ("2021-03-01", "2021-04-01", "2021-05-01") for c in ("SIETE", "UNO")
    ]
    march = got[("2021-03-01", "UNO")]
    # 20000 / 100 and 10050 / 100 rounded half to even.
    assert march.cantidad_quintal == 200 + 100
    assert abs(march.precio_fob_usd_quintal - 50.0) < 1e-9
    assert abs(march.precio_fob_cad_quintal - 63.0) < 1e-9
    assert got[("2021-05-01", "SIETE")].cantidad_quintal == 100
    empty = got[("2021-04-01", "UNO")]
    assert (empty.cantidad_quintal, empty.precio_fob_usd_quintal) == (0, None)
    total = {str(r.fecha_month): (r.pais_nombre_origen, r.cantidad_quintal) for r in everything.collect()}
    assert total == {"2021-03-01": ("TODOS", 300), "2021-04-01": ("TODOS", 0), "2021-05-01": ("TODOS", 100)}
    assert len(rows(everything)) == 3


def test_every_row_is_loaded_or_rejected(spark):
    landed = frame(spark, IMPORT_ROW, [
        {"NUMITEM": "ok"}, {"NUMITEM": "undated", "FECTRA": None}, {"NUMITEM": "no day", "FECTRA": "31022021"},
        {"NUMITEM": "amount", "FOB": "1.234.5"},
    ])
    rejects = reports.load_rejects(landed, reports.IMPORTS)
    assert rows(rejects) == [
        ("77-amount", "FOB", "1.234.5", "no amount", False),
        ("77-no day", "FECTRA", "31022021", "no date", True),
        ("77-undated", "FECTRA", None, "missing", True),
    ]
    loaded = reports.derive_keys(landed, reports.IMPORTS)
    assert loaded.count() + rejects.filter("row_dropped").count() == landed.count()


def test_export_rejects(spark):
    landed = frame(spark, EXPORT_ROW, [
        {"NUMEROITEM": "long", "FECHAACEPT": "3112202199"}, {"NUMEROITEM": "text customs", "ADUANA": "A1"},
        {"NUMEROITEM": "no customs", "ADUANA": None}, {"NUMEROITEM": "money", "MONEDA": "x"},
        {"NUMEROITEM": "way", "VIATRANSPORTE": "x"},
    ])
    rejects = reports.load_rejects(landed, reports.EXPORTS)
    assert rows(rejects) == [
        ("88-money", "MONEDA", "x", "no integer", False),
        ("88-no customs", "ADUANA", None, "no digits", True),
        ("88-text customs", "ADUANA", "A1", "no digits", True),
        ("88-way", "VIATRANSPORTE", "x", "no integer", False),
    ]
    facts = reports.derive_keys(landed, reports.EXPORTS)
    assert facts.count() + rejects.filter("row_dropped").count() == landed.count()
    # The date takes the first eight digits, the column keeps all ten.
    long = facts.filter("NUMEROITEM = 'long'").first()
    assert (long.FECHAACEPT, long.fecha) == (3112202199, date(2021, 12, 31))


def test_strict_load_fails_on_a_bad_date(spark):
    landed = frame(spark, IMPORT_ROW, [{"FECTRA": "31022021"}])
    with pytest.raises(Exception, match="no date"):
        reports.derive_keys(landed, reports.IMPORTS, strict=True).collect()


def test_report_source_leaves_other_classes_out_before_the_distinct(spark, tmp_path):
    variants = [{"NUMITEM": "ok"}, {"NUMITEM": "both", "ARANC_NAC": "10019900"},
                {"NUMITEM": "wheat", "DNOMBRE": "TRIGO", "ARANC_NAC": "10019900"}]
    imports_raw(spark, variants).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    source = reports.report_source(raw, reports.IMPORTS)
    whole = reports.trade_view(raw, reports.IMPORTS).filter("TIPO = 'canola'")
    assert rows(source) == rows(whole) and view_keys(source) == [("both", "canola"), ("ok", "canola")]
    plan = source._jdf.queryExecution().executedPlan().toString()
    assert "TRIGO" not in plan


def test_report_source_leaves_rows_out_of_scope_out_before_the_distinct(spark, tmp_path):
    variants = [{"NUMITEM": "ok"}, {"NUMITEM": "sea", "VIA_TRAN": 2}, {"NUMITEM": "no way", "VIA_TRAN": None},
                {"NUMITEM": "kilos", "MEDIDA": 10}, {"NUMITEM": "few", "CANT_MERC": "100"}]
    imports_raw(spark, variants).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    source, whole = reports.report_source(raw, reports.IMPORTS), reports.trade_view(raw, reports.IMPORTS)
    assert view_keys(source) == [("ok", "canola")] and len(view_keys(whole)) == 5
    assert rows(reports.report_scope(source, reports.IMPORTS)) == rows(reports.report_scope(whole, reports.IMPORTS))


def test_rules_are_fields_of_the_spec(spark):
    spec = replace(
        reports.IMPORTS, oil_word="HARINA", report_unit=10, report_transports=(4,), report_min_quantity=50,
        min_quantity=10, seed_patterns=("BROTE",), seed_quantity_below=60, report_class="trigo",
    )
    base = {"VIA_TRAN": 4, "MEDIDA": 10, "DNOMBRE": "TRIGO", "ARANC_NAC": "10019900"}
    variants = [
        {"NUMITEM": "ok"}, {"NUMITEM": "seed", "DVARIEDAD": "BROTE"}, {"NUMITEM": "few", "CANT_MERC": "59"},
        {"NUMITEM": "too few", "CANT_MERC": "50"}, {"NUMITEM": "flour", "DNOMBRE": "HARINA DE TRIGO"},
        {"NUMITEM": "sea", "VIA_TRAN": 1}, {"NUMITEM": "kilos", "MEDIDA": 6},
    ]
    raw = imports_raw(spark, [{**base, **v} for v in variants])
    report = reports.trade_report(reports.report_source(raw, spec), converter(spark), spec)
    assert {r.NUMITEM: r.is_siembra for r in report.collect()} == {"ok": 0, "seed": 1, "few": 1}
