import json
from datetime import date

import pytest
from frames import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aforo.operators import catalogue, events, ledger, rates, relational, series
from aforo.operators.classify import ProductClass, classify
from aforo.operators.joins import fits_broadcast, lookup_join
from aforo.operators.labels import Role, label_codes


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_in_all_three_ways(spark, how):
    # One key holds a third of all rows, some keys are NULL, one lookup key occurs twice.
    fact = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 20 END AS k"
    )
    lookup = spark.createDataFrame(
        [(7, "hot"), (3, "three"), (3, "again"), (99, "none"), (None, "null")], "code int, name string"
    )
    results = [
        rows(lookup_join(fact, lookup, [("k", "code")], how, small=small, salts=salts))
        for small, salts in ((True, None), (False, None), (False, 8))
    ]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) > 0


def test_lookup_join_checks_size(spark):
    big, small = spark.range(300_000), spark.range(10)
    assert not fits_broadcast(big) and fits_broadcast(small)
    assert not fits_broadcast(small.selectExpr("repeat('x', 1000) AS t"), max_bytes=100)
    fact = spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = lookup_join(fact, small, [("k", "id")], "inner")
        plain = lookup_join(fact, big, [("k", "id")], "inner")
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_labels_by_role(spark):
    dim = spark.createDataFrame([(-1, "DESCONOCIDO"), (1, "A"), (2, "B")], "codigo int, nombre string")
    facts = spark.createDataFrame([(1, 2), (None, 1), (-1, 999)], "o int, d int")
    got = label_codes(facts, {"pais": dim}, [Role("o", "pais", "origen"), Role("d", "pais", "destino")])
    assert rows(got) == rows(
        spark.createDataFrame(
            [(1, 2, "A", "B"), (None, 1, "DESCONOCIDO", "A"), (-1, 999, "DESCONOCIDO", None)],
            "o int, d int, a string, b string",
        )
    )


def test_labelling_does_not_shuffle_the_facts(spark):
    dim = spark.createDataFrame([(1, "A")], "codigo int, nombre string")
    facts = spark.range(100).selectExpr("CAST(id AS int) AS o")
    plan = label_codes(facts, {"pais": dim}, [Role("o", "pais", x) for x in ("a", "b", "c")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 3 and "Exchange hashpartitioning" not in text


CLASSES = (
    ProductClass("trigo", ("1001", "1002"), ("TRIGO", "MAIZ")),
    ProductClass("canola", ("1205",), ("CANOLA", "RAPS")),
)


def test_classify_equals_union_of_branches(spark):
    data = [
        ("10019900", "canola en grano", 1),
        ("10019900", "canola en grano", 1),
        ("12050000", None, 2),
        (None, "Maiz dulce", 3),
        ("99999999", "silla", 4),
        ("10020000", "trigo", 5),
        (None, None, 6),
    ]
    df = spark.createDataFrame(data, "code string, name string, n int")
    got = classify(df, CLASSES, "code", "name", "tipo").select("tipo", "code", "name", "n")
    df.createOrReplaceTempView("products")
    want = spark.sql("""
        SELECT 'trigo' tipo, * FROM products WHERE code LIKE '1001%' OR code LIKE '1002%'
        UNION SELECT 'trigo', * FROM products WHERE upper(name) LIKE '%TRIGO%' OR upper(name) LIKE '%MAIZ%'
        UNION SELECT 'canola', * FROM products WHERE code LIKE '1205%'
        UNION SELECT 'canola', * FROM products WHERE upper(name) LIKE '%CANOLA%' OR upper(name) LIKE '%RAPS%'
    """)
    assert rows(got) == rows(want)
    assert len(rows(got)) == 5


def rate_rows(spark, data):
    return spark.createDataFrame(
        [(c, date.fromisoformat(d), v) for c, d, v in data],
        "currency_code string, currency_date date, to_clp double",
    )


def test_forward_fill_stays_within_the_currency(spark):
    df = rate_rows(spark, [
        ("aud", "2021-01-01", 5.0), ("cad", "2021-01-01", None), ("cad", "2021-01-02", 6.0),
        ("cad", "2021-01-03", None),
    ])
    got = {(r[0], str(r[1])): r[2] for r in rates.ffill(df).collect()}
    assert got[("cad", "2021-01-01")] is None
    assert got[("cad", "2021-01-03")] == 6.0


def test_daily_mean_ignores_null(spark):
    df = rate_rows(spark, [("usd", "2021-01-01", 2.0), ("usd", "2021-01-01", None)])
    assert rates.daily_mean(df).first()["to_clp"] == 2.0


@pytest.mark.parametrize(
    ("as_of", "days"),
    [(date(2021, 2, 14), 30), (date(2021, 2, 15), 730), (date(2021, 2, 16), 730)],
)
def test_forecast_horizon(spark, as_of, days):
    df = rate_rows(spark, [("usd", "2021-01-01", 2.0), ("clp", "2020-12-01", 1.0)])
    got = rates.forecast_rates(df, ["usd", "eur"], as_of)
    assert got.count() == 2 + 2 * (days + 1)
    usd = got.filter("currency_code = 'usd'").agg(F.min("currency_date"), F.max("currency_date"))
    first, last = usd.first()
    assert first == date(2021, 1, 1) and (last - first).days == days


def test_cross_rates_need_all_currencies(spark):
    df = rate_rows(spark, [
        ("usd", "2021-01-01", 700.0), ("eur", "2021-01-01", 800.0), ("clp", "2021-01-01", 1.0),
        ("usd", "2021-01-02", 710.0), ("eur", "2021-01-03", None), ("usd", "2021-01-03", 720.0),
    ])
    got = {(r[0], str(r[1])): (r["to_usd"], r["to_eur"])
           for r in rates.cross_rates(df, ["usd", "eur"]).collect()}
    assert len(got) == 5
    assert got[("eur", "2021-01-01")] == (800 / 700, 1.0)
    assert got[("clp", "2021-01-01")] == (1 / 700, 1 / 800)
    # A currency that has a row without value keeps the day, with NULL rates.
    assert got[("usd", "2021-01-03")] == (1.0, None)


def test_converter_fills_forecast(spark):
    raw = rate_rows(spark, [("usd", "2021-01-01", 700.0), ("eur", "2021-01-01", 770.0)])
    got = rates.currency_converter(raw, ["usd", "eur"], date(2021, 1, 5), short_horizon=3)
    eur = got.filter("currency_code = 'eur'").orderBy("currency_date").collect()
    assert [r["to_clp"] for r in eur] == [770.0] * 4
    assert [round(r["to_usd"], 6) for r in eur] == [1.1] * 4


def test_monthly_rates_join_keeps_unknown_currencies(spark):
    daily = rate_rows(spark, [("usd", "2021-01-01", 2.0), ("usd", "2021-01-31", 4.0),
                              ("zzz", "2021-01-01", 9.0)])
    facts = spark.createDataFrame(
        [(1, "usd", date(2021, 1, 1)), (2, "clp", date(2021, 1, 1)), (3, "usd", date(2021, 2, 1))],
        "k int, currency_code string, month date",
    )
    got = rates.with_monthly_rates(facts, daily, ["usd", "clp"], ["to_clp"], "month")
    assert [(r.k, r.to_clp) for r in got.orderBy("k").collect()] == [(1, 3.0), (2, None), (3, None)]
    assert got.columns == ["k", "currency_code", "month", "to_clp"]


def price_rows(spark, data):
    return spark.createDataFrame(
        [(None if m is None else date.fromisoformat(m), c, q, p) for m, c, q, p in data],
        "fecha_month date, pais_nombre_origen string, q double, p double",
    )


def test_monthly_by_country(spark):
    df = price_rows(spark, [
        ("2021-01-01", "CANADA", 1.0, 10.0), ("2021-01-01", "CANADA", 3.0, 20.0),
        ("2021-01-01", "PERU", None, None), (None, "PERU", 1.0, 1.0), ("2021-01-01", None, 1.0, 1.0),
    ])
    got = series.monthly_by_country(df, "q", ["p"], names=["price"])
    assert rows(got) == [
        (date(2021, 1, 1), "CANADA", 4.0, 15.0), (date(2021, 1, 1), "PERU", 0.0, None),
    ]


def test_monthly_all_weights(spark):
    df = price_rows(spark, [
        ("2021-01-01", "A", 1.0, 10.0), ("2021-01-01", "B", 3.0, None), ("2021-02-01", "A", 0.0, 5.0),
    ])
    got = series.monthly_all(df, "TODOS", quantity="q", prices=["p"])
    assert rows(got) == [
        (date(2021, 1, 1), "TODOS", 4.0, 2.5), (date(2021, 2, 1), "TODOS", 0.0, None),
    ]


def test_fill_months_gives_months_times_countries(spark):
    df = price_rows(spark, [
        ("2021-01-01", "A", 1.0, 10.0), ("2021-04-01", "B", 2.0, 20.0), ("2021-02-01", "B", None, 3.0),
    ])
    got = series.fill_months(df, quantity="q")
    assert got.count() == 8
    b = {str(r[0]): (r["q"], r["p"]) for r in got.filter("pais_nombre_origen = 'B'").collect()}
    assert b == {"2021-01-01": (0.0, None), "2021-02-01": (0.0, 3.0), "2021-03-01": (0.0, None),
                 "2021-04-01": (2.0, 20.0)}


def test_country_list_and_chart(spark):
    df = price_rows(spark, [("2021-01-01", "COREA DEL SUR", 1234567.0, 12.5),
                            ("2021-01-01", "TODOS", 0.0, 1312.6), ("2021-01-01", "A", 2.5, None)])
    assert [r[0] for r in series.country_list(df).collect()] == ["all", "a", "corea del sur", "todos"]
    feed = series.chart_feed(df, "TODOS", quantity="q", fob="p", cif="p").collect()
    got = {r["title"]: (r["cantidad_label"], r["precio_fob_label"]) for r in feed}
    assert got == {
        "Pais: Corea del sur": ("1,234,567", "$12"), "Pais: All": ("0", "$1313"), "Pais: A": ("2", None),
    }


def period_rows(spark, counts):
    data = [(p, i) for p, n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "period_id string, n int")


def test_ledger_cases(spark):
    loaded = ledger.loaded_ledger({"imports": period_rows(spark, {"2021-1 ": 2, "2021-2": 3, "2020-12": 1})})
    incoming = ledger.incoming_ledger(
        {"imports": period_rows(spark, {"2021-1": 2, "2021-2": 5, "2021-10": 1})}
    )
    compared = ledger.compare_ledgers(loaded, incoming)
    assert rows(ledger.periods_to_load(compared)) == [("imports", "2021-10")]
    assert rows(ledger.periods_to_replace(compared)) == [("imports", "2021-2")]
    both = [r.period_id for r in ledger.sorted_ledger(incoming).collect()]
    assert both == ["2021-1", "2021-2", "2021-10"]


def test_latest_year_is_over_both_trade_types(spark):
    df = spark.createDataFrame(
        [("imports", "2021"), ("exports", "2020"), ("imports", "2020")], "trade string, year string"
    )
    assert rows(ledger.keep_latest_year(df, "year")) == [("imports", "2021")]


def test_relational(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", True), (3, "c", False)], "k int, t string, f boolean")
    assert rows(relational.delete_where(df, "f")) == [(1, "a", None), (3, "c", False)]
    got = relational.scan(df, ["t"], "k > 1", top=1, order_by=[F.desc("k")])
    assert [r.t for r in got.collect()] == ["c"]
    assert relational.run_query(spark, "SELECT * FROM {x} WHERE k = :k", x=df, k=2).first()["t"] == "b"
    listed = relational.display_list(df.union(df), "k", "t", "k < 3", order_by="id")
    assert [tuple(r) for r in listed.collect()] == [(1, "a"), (2, "b")]


def test_enforce_types(spark):
    df = spark.createDataFrame(
        [("5.0", "2021-01-01", "r1"), ("x", "nope", "r2"), (None, None, "r3")],
        "n string, d string, reference_id string",
    )
    spec = {"n": "int", "d": "date"}
    got = relational.enforce_types(df, spec, not_null=["reference_id"])
    assert rows(got) == rows(
        spark.createDataFrame(
            [(5, date(2021, 1, 1), "r1"), (None, None, "r2"), (None, None, "r3")],
            "n int, d date, r string",
        )
    )
    assert tuple(relational.type_rejects(df, spec).first()) == (1, 1)
    with pytest.raises(PySparkException, match="n is NULL"):
        relational.enforce_types(df, spec, not_null=["n"]).collect()


def test_flatten_catalogue(spark):
    pages = [
        {"id": "p1", "name": "n1", "title": "t1", "notes": None,
         "organization": {"id": "o", "name": "on", "title": "ot"},
         "resources": [{"id": "r1", "package_id": "other"}, {"id": "r2", "package_id": "other"}]},
        {"id": "p2", "name": "n2", "title": "t2", "notes": "x", "organization": None,
         "resources": [{"id": "r3", "package_id": "other"}]},
        {"id": "p3", "name": "n3", "title": "t3", "notes": "x", "resources": []},
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(p) for p in pages]))
    got = catalogue.flatten_catalogue(df).orderBy("id").collect()
    assert [(r.id, r.package_id, r.inst_title, r.inst_id) for r in got] == [
        ("r1", "p1", "ot", "o"), ("r2", "p1", "ot", "o"), ("r3", "p2", None, None),
    ]


DEVICES = [("d1", "m1", "entrada", 1), ("d1", "m2", "salida", 2), ("d2", "m3", "entrada", 3)]


def device_frame(spark):
    return spark.createDataFrame(
        DEVICES, "device_source_id string, device_mac_address string, device_subtype string, gate_id int"
    )


def test_device_rules(spark):
    seen = spark.createDataFrame(
        [(1, "d1", "m2"), (2, "d1", "m3"), (3, "d9", "m1")],
        "k int, device_source_id string, device_mac_address string",
    )
    flagged = events.authorise(seen, device_frame(spark)).orderBy("k").collect()
    assert [(r.authorised, r.device_subtype) for r in flagged] == [
        (True, "salida"), (False, "Not Applicable"), (False, "Not Applicable"),
    ]
    assert [r.k for r in events.only_authorised(seen, device_frame(spark)).collect()] == [1]
    gates = events.with_gate(seen, device_frame(spark)).orderBy("k").collect()
    assert [r.gate_id for r in gates] == [1, 1, None]


def test_vehicle_plates(spark):
    df = spark.createDataFrame([(1, None), (2, "Unknown"), (3, "AB12")], "k int, p string")
    assert [r.p for r in events.vehicle_events(df, "p").orderBy("k").collect()] == [
        "Unknown", "Unknown", "AB12",
    ]
    assert [r.k for r in events.vehicle_events(df, "p", plate_required=True).collect()] == [3]


def test_delete_with_audit_and_references(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "id int, t string")
    gone = spark.createDataFrame([(2,), (2,), (7,)], "id int")
    audit, rest = events.delete_with_audit(
        df, gone, "id", schema_name="s", table_name="t", category="c", reason="r", username="u"
    )
    assert [(r.id_value, json.loads(r.record_json)) for r in audit.collect()] == [
        ("2", {"id": 2, "t": None})
    ]
    assert rows(rest) == rows(spark.createDataFrame([(1, "a"), (None, "c")], "id int, t string"))
    refs = spark.createDataFrame([(1, 2, 5), (2, 3, 6), (3, None, 7)], "k int, entrance_id int, exit_id int")
    cleared = events.clear_references(refs, gone, "entrance_id", "id", also=["exit_id"])
    assert [tuple(r) for r in cleared.orderBy("k").collect()] == [
        (1, None, None), (2, 3, 6), (3, None, 7),
    ]


def test_cascade_takes_predictions_along(spark):
    tables = {
        "camera_event_detection": spark.createDataFrame([("d1",), ("d2",)], "device string"),
        "camera_event_images": spark.createDataFrame(
            [("d1", "i1"), ("d2", "i2")], "device string, image_name string"
        ),
        "camera_event_vehicle_attributes": spark.createDataFrame([("d1",)], "device string"),
        "image_predictions": spark.createDataFrame([("i1", 1), ("i2", 2)], "image_name string, p int"),
    }
    left = events.cascade_delete(tables, spark.createDataFrame([("d1",)], "device string"), "device")
    assert rows(left["camera_event_detection"]) == [("d2",)]
    assert rows(left["camera_event_images"]) == [("d2", "i2")]
    assert rows(left["camera_event_vehicle_attributes"]) == []
    assert rows(left["image_predictions"]) == [("i2", 2)]


def test_link_registration_latest_wins(spark):
    vehicles = spark.createDataFrame([(1, None), (2, 50), (3, None)], "reference_id int, entrance_id int")
    regs = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13)], "reference_id int, entrance_id int")
    got = events.link_registration(vehicles, regs, "entrance_id").orderBy("reference_id").collect()
    assert [(r.reference_id, r.entrance_id) for r in got] == [(1, 11), (2, 12), (3, None)]


def test_hot_key_is_split_when_the_lookup_is_large(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 200_000, 1, 8).selectExpr(
            "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS k"
        )
        lookup = spark.range(1000).selectExpr("id AS code", "concat('n', id) AS name")
        got = lookup_join(fact, lookup, [("k", "code")], "left", small=False)
        assert len(got.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_wide_rows_are_packed_with_the_same_result(spark):
    dim = spark.createDataFrame([(-1, "DESCONOCIDO"), (1, "A")], "codigo int, nombre string")
    roles = [Role("o", "pais", "origen"), Role("d", "pais", "destino")]
    narrow = spark.createDataFrame([(1, None, "x"), (None, 9, "y")], "o int, d int, `a.b` string")
    wide = narrow.select("*", *[F.lit(i).alias(f"c{i}") for i in range(120)])
    packed = label_codes(wide, {"pais": dim}, roles)
    assert packed.columns == [*wide.columns, "origen", "destino"]
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "__row" in plan
    slim = packed.select("o", "d", F.col("`a.b`"), "origen", "destino")
    assert rows(slim) == rows(label_codes(narrow, {"pais": dim}, roles))


def _split_joins(df):
    df.write.format("noop").mode("overwrite").save()
    executed = df._jdf.queryExecution()
    executed.executedPlan().executeCollectPublic()
    return executed.executedPlan().toString()


def test_hot_key_is_split_when_the_lookup_was_reduced(spark, tmp_path, monkeypatch):
    from aforo.operators import events as ev

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    rows = spark.range(0, 60_000, 1, 6).selectExpr(
        "id", "if(id % 3 < 2, 'hot', concat('k', id % 500)) as k", "if(id % 3 < 2, 'm', 'n') as m", "cast(null as string) as v"
    )
    rows.write.parquet(str(tmp_path / "facts"))
    lookup = spark.range(0, 3_000, 1, 3).selectExpr(
        "if(id = 0, 'hot', concat('k', id)) as k", "if(id = 0, 'm', 'n') as m", "cast(id as string) as v"
    )
    lookup.write.parquet(str(tmp_path / "lookup"))
    facts, lookup = spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "lookup"))
    before = {k: spark.conf.get(k, None) for k in settings}
    monkeypatch.setattr(ev, "fits_broadcast", lambda *a, **b: False)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        made = [
            ev.authorise(facts.drop("v"), lookup, "k", "m", "v"),
            ev.with_gate(facts.drop("v"), lookup, "k", "v"),
            ev.clear_references(facts, lookup, "k", "k"),
            ev.link_registration(facts, lookup, "v", "k"),
        ]
        for df in made:
            assert "skew=true" in _split_joins(df)
            assert df.count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_64_bit_integers_stay_whole(spark):
    from aforo.functions.keys import integer_text
    from aforo.operators.relational import typed

    rows = [("9007199254740993", 12345678.0), ("5.0", 10063010.0), ("x", 7.0), ("2.5", 1.5)]
    got = spark.createDataFrame(rows, "t string, d double").select(
        typed(F.col("t"), "bigint").alias("n"), integer_text("d").alias("s")
    )
    assert [tuple(r) for r in got.collect()] == [(9007199254740993, "12345678"), (5, "10063010"), (None, "7"), (3, "1.5")]


def test_shared_folder_needs_a_setting_on_a_cluster():
    from types import SimpleNamespace

    from aforo.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, applicationId="a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))
