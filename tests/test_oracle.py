"""Every query against its SQL, value by value."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from semesta import queries as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, ORACLE = registry.PLANS, entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sorted(columns: list[str], data: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    actual = _sorted(result.columns, result.collect())
    assert actual == _sorted(columns, expected.fetchall())
    assert actual


#: Reports with an order of their own; the run history has a tie-break on its id.
SORTED = """tren_performa_akademik perbandingan_kelas cohort_angkatan tren_peminjaman_semester korelasi_rajin_pinjam_ip
korelasi_denda_ip distribusi_ip etl_log_monitor""".split()


@pytest.mark.parametrize("name", SORTED)
def test_report_order(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert [tuple(row) for row in result.select(*columns).collect()] == expected.fetchall()


QUALITY = [name for name in QUERIES if name.startswith("dq_")]


@pytest.mark.parametrize("name", QUALITY)
def test_every_rule_is_broken_somewhere(duck, name):
    """So that no rule could be replaced by a literal 0."""
    report = duck.execute(ORACLE[name]).fetchall()
    assert report and all(broken > 0 for *_, broken in report)


def test_second_night_keeps_and_rebuilds(duck):
    found = {(row[0], row[3]) for row in duck.execute(ORACLE["second_night"]).fetchall()}
    assert {("fact_rekap_pinjam", True), ("fact_rekap_pinjam", False)} <= found


def test_conflicts_occur(duck):
    """A stored row with rivals, and a transcript that was taken before another of the same batch."""
    rivals = duck.execute(f"SELECT khs IS NULL, max(pesaing) FROM ({ORACLE['fact_rekap_ip_conflict']}) GROUP BY 1").fetchall()
    assert dict(rivals)[True] >= 1 and dict(rivals)[False] >= 2


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
