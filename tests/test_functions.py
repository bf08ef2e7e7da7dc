import random
import re
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aforo.functions import amounts, keys, text, timestamps
from aforo.session import shared_folder, staged


def column(spark, values, ddl, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_clean_amount(spark):
    texts = ["1234,56", "-5", "1.234,5", "", None, "12 US", "1,239", "abc", "$ 7", "-", "1e5"]
    want = ["1234.56", "-5.00", None, "0.00", "0.00", "12.00", "1.24", "0.00", "7.00", None, "15.00"]
    got = column(spark, texts, "string", amounts.clean_amount("c"))
    assert got == [None if w is None else Decimal(w) for w in want]


def test_clean_amount_without_sign(spark):
    got = column(spark, ["-5", "1-2"], "string", amounts.clean_amount("c", keep_sign=False))
    assert got == [Decimal("5.00"), Decimal("12.00")]


def test_amount_rejects_counts_only_malformed(spark):
    df = spark.createDataFrame([("1",), (None,), ("1.2.3",), ("",), ("9" * 20,)], "a string")
    got = amounts.amount_rejects(amounts.clean_amounts(df, ["a"]), ["a"]).first()
    assert got["a_rejects"] == 2


def test_unit_price_by_zero_is_null(spark):
    df = spark.sql("SELECT CAST(10 AS DECIMAL(15,2)) a, CAST(0 AS DECIMAL(15,2)) z, "
                   "CAST(4 AS DECIMAL(15,2)) q")
    row = df.select(amounts.unit_price_cif("a", "z").alias("n"), amounts.unit_price_cif("a", "q").alias("p"))
    assert row.schema["p"].dataType.simpleString() == "decimal(33,18)"
    assert tuple(row.first()) == (None, Decimal("2.500000000000000000"))


def test_quintal_prices_and_rate_choice(spark):
    df = spark.sql("SELECT 2.0D AS fob, 3.0D AS cif, 0.5D AS to_usd, 0.25D AS to_cad")
    row = amounts.quintal_prices(df, "fob", "cif").first()
    assert (row["precio_fob_usd"], row["precio_fob_cad"]) == (100.0, 50.0)
    assert (row["precio_cif_usd"], row["precio_cif_cad"]) == (150.0, 75.0)
    old = amounts.quintal_prices(df, "fob", "cif", cif_cad_rate="to_usd").first()
    assert old["precio_cif_cad"] == 150.0


def test_to_quintal_rounds_half_even(spark):
    got = column(spark, [1250.0, 1350.0, 149.0, None], "double", amounts.to_quintal("c"))
    assert got == [12.0, 14.0, 1.0, None]


def test_parse_ddmmyyyy(spark):
    texts = ["5032021", "15032021", "31022021", None, "5032021.0", "150320219", "x", "29022020", "0"]
    want = [date(2021, 3, 5), date(2021, 3, 15), None, None, date(2021, 3, 5), None, None,
            date(2020, 2, 29), None]
    assert column(spark, texts, "string", keys.parse_ddmmyyyy("c")) == want
    assert column(spark, [5032021, 99], "int", keys.parse_ddmmyyyy("c")) == [date(2021, 3, 5), None]
    assert column(spark, [1503202199], "bigint", keys.parse_ddmmyyyy("c", first_eight=True)) == [
        date(2021, 3, 15)
    ]


def test_parse_ddmmyyyy_strict(spark):
    assert column(spark, ["5032021", None], "string", keys.parse_ddmmyyyy("c", strict=True)) == [
        date(2021, 3, 5), None,
    ]
    with pytest.raises(PySparkException, match="no date: 31022021"):
        column(spark, ["31022021"], "string", keys.parse_ddmmyyyy("c", strict=True))


def test_every_day_of_a_leap_year_parses(spark):
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-12-31')) AS d")
    wrong = days.filter(keys.parse_ddmmyyyy(F.date_format("d", "ddMMyyyy").cast("int")) != F.col("d"))
    assert wrong.count() == 0


def test_period_month_and_reference(spark):
    got = column(spark, [date(2021, 1, 31), date(2021, 10, 1), None], "date", keys.period_id("c"))
    assert got == ["2021-1", "2021-10", None]
    assert column(spark, [date(2021, 1, 31)], "date", keys.month_start("c")) == [date(2021, 1, 1)]
    df = spark.createDataFrame(
        [("12.0", "3"), (None, "1"), ("0", "1"), ("", None), ("A1", "2.0"), ("10", "10")],
        "d string, n string",
    )
    got = [r[0] for r in df.select(keys.reference_id("d", "n")).collect()]
    assert got == ["12-3", "Unknown-1", "Unknown-1", "Unknown-Unknown", "A1-2", "10-10"]


def test_fill_codes_and_numeric_filter(spark):
    df = spark.createDataFrame(
        [("5.0", "1"), (None, "2"), ("2.5", "3"), ("x", "4")], "ADUANA string, k string"
    )
    filled = keys.fill_codes(df, {"ADUANA": -1})
    assert [r[0] for r in filled.orderBy("k").collect()] == [5, -1, 2, None]
    # The missing code became -1, which is not written with digits only, so it goes too.
    assert [r.k for r in keys.numeric_aduana(filled, "ADUANA").orderBy("k").collect()] == ["1", "3"]


def test_normalize_tariff(spark):
    codes = ["7129099", "10063010.0", "10063010", "1205", None]
    got = column(spark, codes, "string", keys.normalize_tariff("c"))
    assert got == ["07129099", "10063010", "10063010", "1205", None]


def test_currency_code(spark):
    mapping = {6: "cad", 13: "usd"}
    got = column(spark, [6, 13, 7, None], "int", keys.currency_code("c", mapping))
    assert got == ["cad", "usd", "other", "other"]


def test_descriptions_keep_separators_next_to_null(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(text.full_description("a", "b", "c")).first()[0] == "a  c"
    assert df.select(text.unit_label("b", "c")).first()[0] == " / c"


def test_trims(spark):
    assert column(spark, ["CANADA\r\n", " x \t", None], "string", text.rstrip_ws("c")) == [
        "CANADA", " x", None,
    ]
    assert column(spark, [" 1.5\r\n"], "string", text.strip_line_ends("c")) == ["1.5"]


def test_negated_predicates_drop_null(spark):
    df = spark.createDataFrame(
        [(1, "PASTA"), (2, None), (3, "harina"), (4, "pasta fina")], "k int, d string"
    )
    assert [r.k for r in text.exclude_keywords(df, {"d": ["PASTA"]}).collect()] == [3]
    assert [r.k for r in text.exclude_codes(df, "d", ["harina"]).orderBy("k").collect()] == [1, 4]


def test_seed_flag(spark):
    df = spark.createDataFrame(
        [(1, "para siembra", 9000.0), (2, "comer", 9000.0), (3, "comer", 10.0), (4, None, 9000.0),
         (5, None, 1.0), (6, "S IEMBRA", None)],
        "k int, d string, q double",
    )
    flag = text.is_seed("d", "q", ["SIEMB", "S IEM"], 5000)
    assert [r[1] for r in df.orderBy("k").select("k", flag).collect()] == [1, 0, 1, 0, 1, 1]


def test_parse_ts_and_zones(spark):
    values = ["2021-07-01 12:00:00", "2021-01-01", "01/02/2021", None]
    want = [datetime(2021, 7, 1, 12), datetime(2021, 1, 1), None, None]
    assert column(spark, values, "string", timestamps.parse_ts("c")) == want
    df = spark.createDataFrame([(v,) for v in values], "c string")
    moved = timestamps.convert_tz(df, ["c"], "UTC", "America/New_York", timestamps.DATETIME_FORMAT)
    assert [r.c for r in moved.collect()] == [
        "2021-07-01 08:00:00", "2020-12-31 19:00:00", None, None,
    ]


@pytest.mark.parametrize("session_zone", ["UTC", "America/Santiago"])
def test_timestamps_with_and_without_zone(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.sql(
            "SELECT timestamp'2021-07-01 12:00:00+00:00' AS moment, "
            "timestamp_ntz'2021-07-01 12:00:00' AS wall"
        )
        fmt = timestamps.DATETIME_FORMAT
        got = timestamps.convert_tz(df, ["moment", "wall"], "Asia/Tokyo", "Europe/Madrid", fmt)
        assert tuple(got.first()) == ("2021-07-01 14:00:00", "2021-07-01 05:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_forms(spark):
    df = spark.sql("SELECT timestamp'2021-01-02 03:04:05' AS t, 1 AS n, date'2021-01-01' AS d")
    assert timestamps.timestamps_to_text(df).first()["t"] == "2021-01-02 03:04:05"
    assert tuple(text.all_to_string(df).first()) == ("2021-01-02 03:04:05", "1", "2021-01-01")


def test_clean_amount_equals_the_rule_on_random_text(spark):
    random.seed(7)
    texts = ["".join(random.choices("0123456789.,-- aU$", k=random.randint(0, 9))) for _ in range(3000)]

    def rule(value):
        kept = re.sub("[^0-9.-]", "", value.replace(",", ".")) or "0"
        try:
            return Decimal(kept).quantize(Decimal("0.01"), ROUND_HALF_UP)
        except InvalidOperation:
            return None

    assert column(spark, texts, "string", amounts.clean_amount("c")) == [rule(t) for t in texts]


def test_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == configured
    frame = staged(spark.range(5), "numbers")
    assert frame.count() == 5
    assert frame.inputFiles()[0].startswith(f"file://{configured}/numbers-")
