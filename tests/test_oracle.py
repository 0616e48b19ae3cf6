"""Every registered query against its SQL on whole tables."""

import oracle
import pytest

import __spark_entry__ as contract

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", list(contract.BINDINGS))
def test_query(spark, con, name):
    columns, got = oracle.spark_rows(contract.queries()[name](spark, oracle.SF_DIR))
    wanted_columns, wanted = oracle.sql_rows(con, SQL[name])
    assert columns == wanted_columns
    assert len(got) == len(wanted)
    assert got == wanted


def test_entry(spark):
    assert contract.entry(spark).count() == 25


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize(
    "name", ["parse_timestamp", "record_envelope", "clean_places", "clean_users", "category_counts_by_year"]
)
def test_time_zone_of_the_session_does_not_matter(spark, con, name, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert oracle.spark_rows(contract.queries()[name](spark, oracle.SF_DIR)) == oracle.sql_rows(con, SQL[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
