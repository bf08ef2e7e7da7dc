from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aforo.operators import series
from aforo.operators.classify import ProductClass, classify
from aforo.operators.relational import distinct_rows, row_digest
from aforo.plans.cleaned_tables import refresh_cleaned, table_digest, version_of
from aforo.sinks.tables import append_table, register_path, replace_periods
from frames import rows


def facts(spark, *rows_):
    return spark.createDataFrame([(p, i, "x") for p, i in rows_], "period_id string, id long, code string")


def files(path):
    """The files of every partition with their times of writing."""
    return {p.name: {f.name: f.stat().st_mtime_ns for f in p.glob("*.parquet")} for p in Path(path).glob("period_id=*")}


@pytest.fixture
def table(spark, tmp_path):
    source, target = str(tmp_path / "facts"), str(tmp_path / "cleaned")
    append_table(facts(spark, ("2021-1", 1), ("2021-2", 2), ("2021-10", 3)), source)

    def refresh(version="v", build=lambda df: df.withColumn("twice", F.col("id") * 2)):
        changed = refresh_cleaned(spark, source, build, target, version)
        return {r.period_id: r.action for r in changed.collect()}

    return source, target, refresh


def test_only_changed_periods_are_rebuilt(spark, table):
    source, target, refresh = table
    assert refresh() == dict.fromkeys(("2021-1", "2021-2", "2021-10"), "build")
    before = files(target)
    assert refresh() == {} and files(target) == before
    replace_periods(facts(spark, ("2021-2", 5), ("2021-2", 6), ("2021-3", 7)), source)
    assert refresh() == {"2021-2": "build", "2021-3": "build"}
    after = files(target)
    assert all(after[p] == before[p] for p in ("period_id=2021-1", "period_id=2021-10"))
    assert not set(after["period_id=2021-2"]) & set(before["period_id=2021-2"])
    got = rows(spark.read.parquet(target).select("period_id", "id", "twice"))
    assert got == [("2021-1", 1, 2), ("2021-10", 3, 6), ("2021-2", 5, 10), ("2021-2", 6, 12), ("2021-3", 7, 14)]


def test_a_changed_dimension_rebuilds_all(spark, table):
    _, target, refresh = table
    dim = spark.createDataFrame([(1, "a"), (2, None)], "code int, name string")
    turned = spark.createDataFrame([(2, None), (1, "a")], "code int, name string")
    other = spark.createDataFrame([(1, None), (2, "a")], "code int, name string")
    assert table_digest(dim) == table_digest(turned.repartition(2)) != table_digest(other)
    assert table_digest(dim.union(dim)) != table_digest(dim)
    assert version_of({"d": dim}, "r") != version_of({"d": dim}, "s")
    refresh(version_of({"d": dim}))
    assert refresh(version_of({"d": turned})) == {}
    assert set(refresh(version_of({"d": other}))) == {"2021-1", "2021-2", "2021-10"}


def test_a_failed_refresh_is_made_up_for(spark, table):
    source, target, refresh = table
    refresh()
    replace_periods(facts(spark, ("2021-2", 9)), source)
    with pytest.raises(Exception, match="broken"):
        refresh(build=lambda df: df.withColumn("twice", F.raise_error(F.lit("broken")).cast("long")))
    assert refresh() == {"2021-2": "build"}
    assert rows(spark.read.parquet(target).where("period_id = '2021-2'").select("id", "twice")) == [(9, 18)]


def test_a_period_that_left_the_facts_is_removed(spark, table):
    source, target, refresh = table
    refresh()
    gone = next(Path(source).glob("period_id=2021-1"))
    for file in gone.iterdir():
        file.unlink()
    gone.rmdir()
    assert refresh() == {"2021-1": "remove"}
    assert sorted(files(target)) == ["period_id=2021-10", "period_id=2021-2"]


def test_a_period_that_gives_no_rows_any_more_is_emptied(spark, table):
    source, target, refresh = table
    keep = lambda df: df.where("id < 100")
    refresh(build=keep)
    replace_periods(facts(spark, ("2021-2", 500)), source)
    assert refresh(build=keep) == {"2021-2": "build"}
    assert sorted(files(target)) == ["period_id=2021-1", "period_id=2021-10"]
    assert refresh(build=keep) == {}


def test_series_from_states_equals_the_series_of_all_rows(spark):
    data = [(date(2021, m, 1), c, float(q), p, str(q % 3)) for m in (1, 2) for c in ("a", "b", None) for q, p in ((1, 2.0), (4, None), (9, 5.5))]
    df = spark.createDataFrame(data, "fecha_month date, pais_nombre_origen string, q double, p double, part string")
    whole = series.monthly_by_country(df, "q", ["p"], names=["p"])
    state = series.monthly_state(df, "q", ["p"], also=["part"], names=["p"])
    assert state.count() == 8
    assert rows(series.monthly_from_state(state, names=["p"])) == rows(whole)


def test_registered_table_shows_the_present_partitions(spark, table):
    source, target, refresh = table
    refresh()
    try:
        assert register_path(spark, "cleaned_probe", target).count() == 3
        replace_periods(facts(spark, ("2022-1", 4)), source)
        refresh()
        assert register_path(spark, "cleaned_probe", target).count() == 4
        assert spark.sql("SELECT id FROM cleaned_probe WHERE period_id = '2022-1'").first().id == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS cleaned_probe")


def test_distinct_by_digest_keeps_rows_that_share_one(spark):
    data = [(1, None, "a"), (1, "a", None), (1, None, "a"), (2, "b", "c"), (2, "b", "c"), (None, None, None)] * 3
    df = spark.createDataFrame(data, "n int, x string, y string").repartition(3)
    want = sorted(set(data), key=repr)
    assert rows(distinct_rows(df)) == want
    for narrow in ([F.lit(0)], [F.xxhash64("n") % 2]):
        assert rows(distinct_rows(df, narrow)) == want
    plan = distinct_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__digest_0" in plan and len(row_digest(df)) == 2


def test_prefixes_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("12050001", "ACEITE"), ("10010000", "PAN")], "code string, name_UP string").selectExpr(
        "code", "lower(name_UP) AS name", "name_UP"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    classes = [ProductClass("a", ("1205", "1514"), ("RAPS",)), ProductClass("b", ("1001",), ("TRIGO",))]
    out = classify(stored, classes, "code", "name", "tipo", leave_out=["name_UP"])
    assert rows(out) == [("10010000", "pan", "b"), ("12050001", "aceite", "a")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "StringStartsWith(code,1205)" in pushed and "StringContains(name_UP,RAPS)" in pushed


def test_rows_made_one_by_one_are_written_where_they_were_read(spark, tmp_path, monkeypatch):
    """No shuffle stands before such a write, a period still has few files, and the rows are those of a spread write."""
    source, spread, plain = (str(tmp_path / n) for n in ("facts", "spread", "plain"))
    frame = spark.range(0, 3000, 1, 8).selectExpr("id", "'x' AS code", "concat('2021-', 1 + id % 6) AS period_id")
    append_table(frame, source)
    build = lambda df: df.withColumn("twice", F.col("id") * 2)
    refresh_cleaned(spark, source, build, spread, "v")

    def refuse(df, *columns):
        raise AssertionError("spread")

    monkeypatch.setattr("aforo.sinks.tables.spread_by", refuse)
    assert refresh_cleaned(spark, source, build, plain, "v", spread=False).count() == 6
    assert refresh_cleaned(spark, source, build, plain, "v", spread=False).count() == 0
    assert rows(spark.read.parquet(plain)) == rows(spark.read.parquet(spread))
    assert {p: len(f) for p, f in files(plain).items()} == {p: len(f) for p, f in files(source).items()}
