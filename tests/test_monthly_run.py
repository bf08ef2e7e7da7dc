import zipfile
from datetime import date
from pathlib import Path

import pytest
from test_plans import EXPORT_ROW, IMPORT_ROW

from aforo import fixed_values as fx
from aforo.plans import monthly_run as monthly_run_module
from aforo.plans.monthly_run import Layout, monthly_run
from aforo.session import shared_folder
from aforo.sources.trade import read_trade_archives


def text(value):
    return "" if value is None else str(value)


def lines(base, variants):
    return "".join(";".join(text(v) for v in {**base, **d}.values()) + "\n" for d in variants)


@pytest.fixture
def layout(spark, tmp_path):
    for name in ("archives", "dims", "rates"):
        (tmp_path / name).mkdir()
    (tmp_path / "imports.txt").write_text("\n".join(IMPORT_ROW))
    (tmp_path / "exports.txt").write_text("\n".join(EXPORT_ROW))
    for name in fx.DIMENSIONS:
        (tmp_path / "dims" / f"aduana_codigos_{name}.csv").write_text(
            "c;n\n-1;DESCONOCIDO\n1;CANADA\n6;KN\n7;PERU\n13;DOLAR USA\n"
        )
    for code, value in (("usd", 700), ("eur", 800), ("cad", 560), ("aud", 500)):
        (tmp_path / "rates" / f"Indicador_{code}.csv").write_text(
            f"t\n\n\nPeriodo;Valor\n2021-03-01;{value}\n2021-03-31;{value}\n"
        )
    spark.sql("CREATE DATABASE IF NOT EXISTS run_test")
    yield Layout(
        archives=str(tmp_path / "archives"),
        import_names=str(tmp_path / "imports.txt"),
        export_names=str(tmp_path / "exports.txt"),
        dimensions=str(tmp_path / "dims"),
        rates=str(tmp_path / "rates"),
        facts=str(tmp_path / "facts"),
        output=str(tmp_path / "out"),
        database="run_test",
    )
    spark.sql("DROP DATABASE run_test CASCADE")


def archive(layout, name, imports, exports):
    with zipfile.ZipFile(f"{layout.archives}/{name}", "w") as z:
        z.writestr("Importaciones.txt", lines(IMPORT_ROW, imports))
        z.writestr("Exportaciones.txt", lines(EXPORT_ROW, exports))


def test_whole_run_twice(spark, layout, monkeypatch):
    archive(layout, "import_2020.zip", [{"NUMITEM": "old"}], [])
    archive(
        layout,
        "import_2021.zip",
        [{}, {"NUMITEM": "2", "PA_ORIG": 7}, {"NUMITEM": "3", "FECTRA": "5052021"},
         {"NUMITEM": "5", "FECTRA": "99992021"}],
        [{"MONEDA": "13"}],
    )
    with open(f"{layout.rates}/Indicador_aud.csv", "a") as f:
        f.write("2021-03-02;5x\n2021-03-03;\n")
    first = monthly_run(spark, layout, date(2021, 4, 1))
    assert first.loaded == {"imports": True, "exports": True}
    assert spark.table("run_test.imports_raw").count() == 3
    assert spark.table("run_test.exports_raw").select("FECHAACEPT").first()[0] == 15032021
    series = spark.read.parquet(f"{layout.output}/series")
    got = {(r.serie, str(r.fecha_month)): r.cantidad_quintal for r in series.collect()}
    # The forecast to the end of April holds no rate for May, so that import has no value.
    assert got == {("canada", "2021-03-01"): 200, ("peru", "2021-03-01"): 200, ("all", "2021-03-01"): 400}
    price = series.filter("serie = 'peru'").first()
    assert abs(price.precio_fob_cad_quintal - 0.45 * 700 / 560 * 100) < 1e-9
    rejected = spark.read.parquet(layout.rejects("imports"))
    assert [(r.reference_id, r.raw, r.reason) for r in rejected.collect()] == [("77-5", "99992021", "no date")]
    assert spark.read.parquet(layout.rejects("exports")).isEmpty()
    rates = spark.read.parquet(layout.rejects("rates")).collect()
    assert [(r.currency_code, str(r.currency_date), r.raw) for r in rates] == [("aud", "2021-03-02", "5x")]
    assert not list(Path(shared_folder(spark)).glob("landed-*"))
    names = [r.country for r in spark.read.json(f"{layout.output}/imports_countries").collect()]
    assert names == ["all", "canada", "peru"]
    titles = {r.title for r in spark.read.parquet(f"{layout.output}/charts").collect()}
    assert titles == {"Pais: All", "Pais: Canada", "Pais: Peru"}

    known = Path(layout.manifest()).stat().st_mtime_ns
    monkeypatch.setattr(monthly_run_module, "read_trade_archives", lambda *a, **k: seen.append(a[1].count()) or read(*a, **k))
    seen, read = [], read_trade_archives
    assert not monthly_run(spark, layout, date(2021, 4, 1)).any_loaded
    assert seen == [0, 0] and Path(layout.manifest()).stat().st_mtime_ns > known
    assert spark.read.parquet(layout.rejects("imports")).count() == 1

    archive(layout, "import_2021_b.zip", [{"NUMITEM": "4"}], [])
    again = monthly_run(spark, layout, date(2021, 7, 1))
    assert again.loaded == {"imports": True, "exports": False}
    assert spark.table("run_test.imports_raw").count() == 4
    months = spark.read.parquet(f"{layout.output}/series").filter("serie = 'canada'")
    got = {str(r.fecha_month): r.cantidad_quintal for r in months.collect()}
    assert got == {"2021-03-01": 400, "2021-04-01": 0, "2021-05-01": 200}


def test_archives_are_landed_once(spark, layout, monkeypatch):
    """Only new and replaced archives are unpacked, and those that share a period with them."""
    landed = []

    def counting(spark, archives, *args, **kw):
        landed.append(sorted(Path(r.path).name for r in archives.collect()))
        return read(spark, archives, *args, **kw)

    read = monthly_run_module.read_trade_archives
    monkeypatch.setattr(monthly_run_module, "read_trade_archives", counting)

    def run():
        landed.clear()
        result = monthly_run(spark, layout, date(2021, 7, 1))
        return result.loaded["imports"], sorted({name for names in landed for name in names})

    archive(layout, "import_2021_a.zip", [{}, {"NUMITEM": "2", "FECTRA": "99992021"}], [])
    archive(layout, "import_2021_b.zip", [{"NUMITEM": "3", "FECTRA": "5052021"}], [{}])
    assert run() == (True, ["import_2021_a.zip", "import_2021_b.zip"])
    archive(layout, "import_2021_c.zip", [{"NUMITEM": "4"}], [])
    assert run() == (True, ["import_2021_a.zip", "import_2021_c.zip"])
    archive(layout, "import_2021_b.zip", [{"NUMITEM": "3", "FECTRA": "5052021"}, {"NUMITEM": "5", "FECTRA": "6062021"}], [{}])
    Path(f"{layout.archives}/import_2021_a.zip").unlink()
    assert run() == (True, ["import_2021_b.zip", "import_2021_c.zip"])
    assert sorted(r.NUMITEM for r in spark.table("run_test.imports_raw").collect()) == ["3", "4", "5"]
    assert spark.read.parquet(layout.rejects("imports")).isEmpty()
    manifest = spark.read.parquet(layout.manifest()).where("trade_type = 'imports'")
    assert sorted((Path(r.path).name, r.period_id, r.num_records) for r in manifest.collect()) == [
        ("import_2021_b.zip", "2021-5", 1), ("import_2021_b.zip", "2021-6", 1), ("import_2021_c.zip", "2021-3", 1),
    ]
