"""Every query of the catalogue against its SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from statuta.plans import catalogue
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents pages labels embeddings".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()[:10]
    return repr(value)


@pytest.mark.parametrize("name", [*catalogue.QUERIES])
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(tuple(map(plain, r)) for r in got.select(*columns).collect())
    if name in catalogue.ORACLE_SQL:
        want = db.execute(catalogue.ORACLE_SQL[name])
        at = {c[0]: k for k, c in enumerate(want.description)}
        assert sorted(at) == columns
        assert rows == sorted(tuple(plain(r[at[c]]) for c in columns) for r in want.fetchall())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.QUERIES["inspect_or_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(l_partkey,17),EqualTo(l_suppkey,5))]" in plan and "l_shipdate" not in plan


def test_citations_give_a_row_for_every_page(spark, tmp_path):
    ids = [0, 1, 99999, 100000, 100001, 1234567]
    spark.createDataFrame([(i, "http://a.b/", "") for i in ids], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in catalogue.QUERIES["citations"](spark, str(tmp_path)).collect()}
    assert sorted(got) == ids
    for i, r in got.items():
        kind, number, year = "PD" if i % 2 == 0 else "NOMOS", i % 100000, 1990 + i % 30
        assert (r["kind"], r["number"], r["year"], r["article"]) == (kind, number, year, str(i % 50))
        assert r["instrument_key"] == f"{'PD' if i % 2 == 0 else 'N'}{number}/{year}"
