"""Registered queries against their SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not pathlib.Path(FOLDER).exists(), reason="driver tables are not here")
CHECKED = (
    "d01_by_status_year", "d01h_by_status", "d02_flags", "d03_worst_digits",
    "d04_enrichment", "d05_detail", "d06_rotation", "d06_rings", "d07_over_cap",
    "d08_other_buyer", "d10_dedupe", "d10_rings", "d11_bunching", "canon_contracts",
    "name_norm", "rfc_quality", "dof_parse", "rt_seen_diff", "rt_rules",
    "rp_freshness", "rp_pending", "rp_folios", "rt_seen_expiry", "src_contracts",
)


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert compare(frame, con, entry.oracle_sql()[name]) is None


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_narrow_queries_do_not_shuffle_facts(spark):
    """Screens that only filter and look up lists need no exchange of their own."""
    from contraluz.operators import modifications
    plan = modifications.over_cap(
        spark.read.parquet(_stored(spark)))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "ReadSchema" in plan
    assert "titulo_expediente" not in plan


def _stored(spark):
    from contraluz.session import stored
    from contraluz.sources import driver_tables as D
    return stored(D.contracts(spark, FOLDER)).inputFiles()[0].rsplit("/", 1)[0]
