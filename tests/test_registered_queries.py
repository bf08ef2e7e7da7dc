import pytest
from compare import compare, connect

import __spark_entry__ as contract
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    same_columns, got, want = compare(
        spark, sql, SF, contract.queries()[name], contract.oracle_sql()[name]
    )
    assert same_columns
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["trade_view", "stored_view", "report_exports", "price_series"])
def test_generated_code_compiles(spark, name):
    """Spark would fall back in silence where the code of a plan grows too long; here it fails."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        contract.queries()[name](spark, SF).collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
