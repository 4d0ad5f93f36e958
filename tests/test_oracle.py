"""Every registered query against its DuckDB text on the smallest tables."""

import duckdb
import pytest

from sampleloom.plans import check, registry

SF = "/root/testdata/sf0.001"
registry.load()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query(spark, con, key):
    said, _ = check.compare(spark, con, key, SF)
    assert said in ("ok", "rows only"), said
