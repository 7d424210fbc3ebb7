"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import pytest

from sieveline.plans import boxes, catalog, composed, files, ordering, pairs, relational, runs, selecting  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return f"{float(v):.9g}" if type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(str([plain(r[c]) for c in columns]) for r in found.collect()) == sorted(str([plain(r[i]) for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs_and_repeats(spark, name):
    once, again = (sorted(map(str, catalog.QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert once and once == again
