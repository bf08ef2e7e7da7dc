import json
import zipfile
from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from aforo.operators.ledger import loaded_ledger
from aforo.plans.monthly_load import incremental_load, refresh_reports_if
from aforo.sinks import deletes
from aforo.sinks import files as file_sinks
from aforo.sinks import tables as table_sinks
from aforo.sources import files, reference, trade


def test_dimension_file_with_quotes(spark, tmp_path):
    (tmp_path / "aduana_codigos_transporte.csv").write_text(
        'transporte_codigo;transporte_nombre\n-1;DESCONOCIDO\n1;"MARITIMA, FLUVIAL"\n'
    )
    dims = reference.read_dimensions(spark, str(tmp_path), ["transporte"])
    assert rows(dims["transporte"]) == [(-1, "DESCONOCIDO"), (1, "MARITIMA, FLUVIAL")]


def test_trade_files_are_one_frame_and_strict(spark, tmp_path):
    (tmp_path / "Importaciones_1.txt").write_text('1;"a;b";\n2;c;3,5\n')
    (tmp_path / "Importaciones_2.txt").write_text('3;"d ""e""";x\n')
    got = trade.read_trade(spark, f"{tmp_path}/*.txt", ["NUM ID", "D-NOMBRE", "CIF"])
    assert got.columns == ["NUM_ID", "D_NOMBRE", "CIF"]
    assert rows(got) == [("1", "a;b", None), ("2", "c", "3,5"), ("3", 'd "e"', "x")]
    (tmp_path / "Importaciones_3.txt").write_text("4;too;many;fields\n")
    broken = trade.read_trade(spark, f"{tmp_path}/*.txt", ["NUM_ID", "D_NOMBRE", "CIF"])
    for plan in (broken, broken.select("NUM_ID")):
        with pytest.raises(Exception, match="(?i)malformed"):
            plan.collect()


def test_manifest(spark, tmp_path):
    (tmp_path / "m.txt").write_text(" NUM-ENC \n\nFEC  TRA\nCIF\n")
    names = files.read_manifest(spark, str(tmp_path / "m.txt"))
    assert names == ["NUM_ENC", "FEC_TRA", "CIF"]
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    assert files.apply_manifest(df, names).columns == names
    with pytest.raises(ValueError, match="3 names for 2 columns"):
        files.apply_manifest(df.select("a", "b"), names)


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)


def test_archives_by_name_year_and_member(spark, tmp_path):
    archive(tmp_path / "import_2021_a.zip", {
        "sub/Importaciones_1.txt": '1;"dos\nlineas";x\r\n2;ñandú;y\r\n', "Exportaciones_1.txt": "9;9;9\n",
        "Importaciones.pdf": "no",
    })
    archive(tmp_path / "import_2020.zip", {"Importaciones_0.txt": "0;old;z\n"})
    archive(tmp_path / "export_2021.zip", {"Exportaciones_2.txt": "8;8;8\n"})
    archive(tmp_path / "import_2021_sample.zip", {"Importaciones_s.txt": "7;s;s\n"})
    archive(tmp_path / "other_2022.zip", {"Importaciones_s.txt": "7;s;s\n"})
    found = files.trade_paths(spark, str(tmp_path))
    assert {(r.trade_type, r.file_name) for r in found.collect()} == {
        ("import", "import_2021_a.zip"), ("import", "import_2020.zip"), ("export", "export_2021.zip"),
    }
    sample = files.trade_paths(spark, str(tmp_path), sample=True)
    assert [r.file_name for r in sample.collect()] == ["import_2021_sample.zip"]
    latest = files.latest_files(found)
    assert {r.file_name for r in latest.collect()} == {"import_2021_a.zip", "export_2021.zip"}

    got = trade.read_trade_archives(spark, latest, "Import", ["id", "name", "flag"])
    assert rows(got) == [("1", "dos\nlineas", "x"), ("2", "ñandú", "y")]
    lines = trade.read_archives(spark, latest, "Export").select("member", "line_no", "value")
    assert rows(lines) == [("Exportaciones_1.txt", 1, "9;9;9"), ("Exportaciones_2.txt", 1, "8;8;8")]


def test_archive_records_with_wrong_field_count(spark, tmp_path):
    archive(tmp_path / "import_2021.zip", {"Importaciones_1.txt": "1;a\n2\n"})
    found = files.trade_paths(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)malformed"):
        trade.read_trade_archives(spark, found, "Import", ["id", "name"]).collect()
    kept = trade.parse_records(
        trade.read_archives(spark, found, "Import"), ["id", "name"], keep=["line_no"], strict=False
    )
    assert {(r.line_no, r.name, r["__corrupt"]) for r in kept.collect()} == {
        (1, "a", None), (2, None, "2"),
    }


def test_archive_batches_keep_line_numbers(spark, tmp_path, monkeypatch):
    n = 3 * trade.BATCH + 5
    body = "".join(f"{i}\n" for i in range(1, n + 1))
    archive(tmp_path / "import_2021.zip", {"Importaciones_1.txt": body})
    got = trade.read_archives(spark, files.trade_paths(spark, str(tmp_path)), "Import")
    assert got.count() == n
    assert got.filter("CAST(line_no AS string) <> value").count() == 0


def test_rate_files(spark, tmp_path):
    (tmp_path / "Indicador_usd.csv").write_text(
        "Banco\n;\n\nPeriodo;Valor\n2021-01-01;700,5\n2021-01-02;\n"
    )
    (tmp_path / "Indicador_eur.csv").write_text("x\ny\nz\nPeriodo;Valor\n2021-01-01;800\n")
    (tmp_path / "notes.csv").write_text("2021-01-01;1\n")
    got = reference.read_rates(spark, str(tmp_path), decimal_comma=True)
    assert rows(got) == [
        ("eur", date(2021, 1, 1), 800.0), ("usd", date(2021, 1, 1), 700.5),
        ("usd", date(2021, 1, 2), None),
    ]


def test_catalogue_pages(spark, tmp_path):
    pages = [{"id": "p", "name": "n", "title": "t", "notes": "x", "resources": [{"id": "r", "url": "u"}]}]
    (tmp_path / "page1.json").write_text(json.dumps({"result": {"results": pages}}, indent=1))
    got = reference.read_catalogue(spark, str(tmp_path))
    assert got.select("id", "resources.url").first().asDict() == {"id": "p", "url": ["u"]}


def test_catalog_tables(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "k int, f boolean")
    assert table_sinks.materialize(df, "facts_raw").count() == 3
    table_sinks.refresh_table(df.filter("k < 3"), "facts_raw")
    assert spark.table("facts_raw").count() == 2
    deletes.delete_from(spark, "facts_raw", "f")
    assert [r.k for r in spark.table("facts_raw").collect()] == [2]
    table_sinks.register_views({"vw_facts": spark.table("facts_raw")})
    assert spark.sql("SELECT count(*) FROM vw_facts").first()[0] == 1
    spark.sql("DROP TABLE facts_raw")


def test_delete_keeps_partitions(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", None), (3, "b", False), (4, "c", True)], "k int, p string, f boolean")
    table_sinks.refresh_table(df, "facts_parted", partitions=["p"])
    try:
        assert deletes.delete_from(spark, "facts_parted", "f") == 2
        assert rows(spark.table("facts_parted").select("k", "p")) == [(2, "b"), (3, "b")]
        assert [c.name for c in spark.catalog.listColumns("facts_parted") if c.isPartition] == ["p"]
        assert [r.partition for r in spark.sql("SHOW PARTITIONS facts_parted").collect()] == ["p=b"]
        assert deletes.delete_from(spark, "facts_parted", "k > 9") == 0
    finally:
        spark.sql("DROP TABLE facts_parted")


def parquet_files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


PARTED = [(i, p, i % 5 == 0 or None) for i in range(40) for p in ("2021-1", "01", "a/b=c %41", None)]


def parted(spark, path):
    df = spark.createDataFrame(PARTED, "k int, p string, f boolean").repartition(4, "k")
    df.write.partitionBy("p").parquet(str(path))
    return lambda: rows(spark.read.schema("k int, f boolean, p string").parquet(str(path)).select("k", "p", "f"))


def test_delete_writes_only_files_with_matching_rows(spark, tmp_path):
    path = tmp_path / "my table"
    read, before = parted(spark, path), None
    before = parquet_files(path)
    assert deletes.delete_rows(spark, str(path), "f AND p = '2021-1'") > 0
    after = parquet_files(path)
    assert {f: t for f, t in before.items() if "2021-1" not in f} == {f: t for f, t in after.items() if "2021-1" not in f}
    assert read() == rows(spark.createDataFrame([r for r in PARTED if not (r[2] and r[1] == "2021-1")], "k int, p string, f boolean"))
    deletes.delete_rows(spark, str(path), F.col("p") == "a/b=c %41")
    deletes.delete_rows(spark, str(path), "p IS NULL AND k < 20 OR p = '01' AND k = 3")
    want = [r for r in PARTED if not (r[2] and r[1] == "2021-1") and r[1] != "a/b=c %41"]
    want = [r for r in want if not (r[1] is None and r[0] < 20) and not (r[1] == "01" and r[0] == 3)]
    assert read() == sorted(want, key=repr)
    assert len([p for p in path.iterdir() if p.is_dir()]) == 3
    assert deletes.delete_rows(spark, str(path), "true") and not parquet_files(path)
    assert deletes.delete_rows(spark, str(path), "true") == 0


def test_a_broken_delete_is_completed_or_undone(spark, tmp_path, monkeypatch):
    path, moved = tmp_path / "t", []
    read = parted(spark, path)
    move = deletes.move_path

    def failing(*args):
        moved.append(args)
        if len(moved) > 1:
            raise OSError("gone")
        move(*args)

    monkeypatch.setattr(deletes, "move_path", failing)
    with pytest.raises(OSError):
        deletes.delete_rows(spark, str(path), "k % 2 = 0")
    monkeypatch.setattr(deletes, "move_path", move)
    (path / "_delete-0" / "rows").mkdir(parents=True)
    deletes.finish_deletes(spark, str(path))
    assert read() == sorted([r for r in PARTED if r[0] % 2], key=repr)
    assert not [p for p in path.iterdir() if p.name.startswith("_delete")]


def test_delete_on_an_unpartitioned_table(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(0, 100, 1, 4).write.parquet(str(path))
    before = parquet_files(path)
    assert deletes.delete_rows(spark, str(path), "id = 3") == 1
    assert len(set(before) & set(parquet_files(path))) == 3
    assert spark.read.parquet(str(path)).count() == 99


def test_file_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [("CANADA", 1, None), ("PERU", 2, "x;y")], "pais_nombre_origen string, n int, t string"
    )
    file_sinks.write_csv(df, f"{tmp_path}/csv")
    text = sorted(spark.read.text(f"{tmp_path}/csv").toPandas()["value"])
    assert text == ['CANADA;1;', 'PERU;2;"x;y"'] or text == ['CANADA;1;""', 'PERU;2;"x;y"']
    everything = df.withColumn("pais_nombre_origen", F.lit("TODOS"))
    file_sinks.export_by_country(df, everything, f"{tmp_path}/series")
    names = sorted(p.name for p in (tmp_path / "series").iterdir() if p.is_dir())
    assert names == ["serie=all", "serie=canada", "serie=peru"]
    file_sinks.write_country_list(df, f"{tmp_path}/countries")
    assert [r.country for r in spark.read.json(f"{tmp_path}/countries").collect()] == [
        "all", "canada", "peru",
    ]
    lines = spark.range(500).selectExpr("id AS line_no", "concat('l', id) AS value")
    file_sinks.write_sample(lines.orderBy(F.desc("line_no")), f"{tmp_path}/sample", "line_no")
    assert [r.value for r in spark.read.text(f"{tmp_path}/sample").collect()] == [
        f"l{i}" for i in range(100)
    ]


def facts(spark, counts, mark):
    data = [(p, i, mark) for p, n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "period_id string, n int, mark string")


def test_incremental_load(spark, tmp_path):
    paths = {"imports": f"{tmp_path}/imports", "exports": f"{tmp_path}/exports"}
    first = {
        "imports": facts(spark, {"2021-1": 2, "2021-2": 3, "2020-12": 4}, "old"),
        "exports": facts(spark, {"2021-1": 1}, "old"),
    }
    assert incremental_load(spark, paths, first).loaded == {"imports": True, "exports": True}

    second = {
        "imports": facts(spark, {"2021-1": 2, "2021-2": 5, "2021-10": 1}, "new"),
        "exports": facts(spark, {"2021-1": 1}, "new"),
    }
    result = incremental_load(spark, paths, second)
    assert rows(result.periods) == [("imports", "2021-10", "load"), ("imports", "2021-2", "replace")]
    assert result.loaded == {"imports": True, "exports": False}
    now = spark.read.parquet(paths["imports"])
    assert {(r.period_id, r.mark, r["count"]) for r in now.groupBy("period_id", "mark").count().collect()} == {
        ("2021-1", "old", 2), ("2021-2", "new", 5), ("2021-10", "new", 1), ("2020-12", "old", 4),
    }

    again = incremental_load(spark, paths, second)
    rebuilt = []
    assert not refresh_reports_if(again, lambda: rebuilt.append(1)) and rebuilt == []
    assert refresh_reports_if(result, lambda: rebuilt.append(1)) and rebuilt == [1]
    table = spark.read.parquet(paths["imports"])
    assert rows(loaded_ledger({"imports": table})) == [
        ("imports", "2020-12", 4), ("imports", "2021-1", 2), ("imports", "2021-10", 1),
        ("imports", "2021-2", 5),
    ]


def test_hot_period_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr(
            "id", "uuid() AS filler",
            "CASE WHEN id % 3 = 0 THEN '2021-5' ELSE concat('2020-', 1 + id % 12) END AS period_id",
        )
        table_sinks.replace_periods(df, str(tmp_path / "facts"))
        table_sinks.replace_periods(df.filter("period_id = '2021-5'"), str(tmp_path / "facts"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list((tmp_path / "facts" / "period_id=2021-5").glob("*.parquet"))
    cold = list((tmp_path / "facts" / "period_id=2020-1").glob("*.parquet"))
    assert len(hot) > 4 and len(cold) < len(hot)
    assert spark.read.parquet(str(tmp_path / "facts")).count() == 200_000
