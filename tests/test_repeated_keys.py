"""Registered queries over tables whose natural keys repeat, against their DuckDB SQL."""

import duckdb
import pytest

import quillon.plans.catalog_checks  # noqa: F401
from quillon.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["cache_state", "verify_tree"])
def test_pages_of_one_url(name, spark, tmp_path):
    """Fifty pages share a url; each has a state of its own."""
    path = str(tmp_path / "pages.parquet")
    con = duckdb.connect()
    con.sql(f"COPY (SELECT i AS page_id, CASE WHEN i < 50 THEN 'http://a' ELSE 'http://' || i END AS url, '<p>' || i % 7 AS html FROM range(400) r(i)) TO '{path}' (FORMAT parquet)")
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, str(tmp_path))
    want = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in df.select(want.columns).collect()) == sorted(want.fetchall())


def test_repeated_pages(spark, tmp_path):
    """A page that is there twice, with other contents, is checked twice."""
    path = str(tmp_path / "pages.parquet")
    con = duckdb.connect()
    con.sql(f"COPY (SELECT i // 2 AS page_id, 'u' AS url, '<p>' || i AS html FROM range(120) r(i)) TO '{path}' (FORMAT parquet)")
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{path}'")
    for name in ("cache_state", "verify_tree"):
        want = con.sql(ORACLES[name])
        assert sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).select(want.columns).collect()) == sorted(want.fetchall())
