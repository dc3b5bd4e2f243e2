"""Every registered query against its DuckDB counterpart on the smallest tables."""

import numbers

import duckdb
import numpy as np
import pandas as pd
import pytest

from evidence_atlas.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NA or x != x:
            return None
        return float(x) if isinstance(x, numbers.Number) and not isinstance(x, (bool, np.bool_)) else str(x)

    cells = frame[sorted(frame.columns)]
    return sorted((tuple(plain(x) for x in row) for row in cells.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query(spark, data, db, key):
    got = catalog.QUERIES[key](spark, data).toPandas()
    if key not in catalog.ORACLES:
        assert len(got)
        return
    want = db.sql(catalog.ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
