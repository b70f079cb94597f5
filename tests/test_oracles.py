"""Every operator against its SQL in another engine, over the smallest tables."""

import duckdb
import pytest

from framelake.plans import catalogue
from framelake.sources.fixtures import TABLES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.OPERATORS))
def test_matches_oracle(spark, sf_dir, oracle, name):
    op = catalogue.OPERATORS[name]
    got = op.run(spark, sf_dir)
    want = oracle.sql(op.oracle())
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.collect(), got.columns) == rows(want.fetchall(), want.columns)
