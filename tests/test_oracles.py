"""Every query with SQL gives the rows that DuckDB gives; the others run and keep their schema."""

import math

import pytest

from spanloom import catalogue, catalogue_cases  # noqa: F401

FEW_SECONDS = {"similarity_composite", "intervention_gate"}


def canon(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, list | tuple):
        return tuple(canon(v) for v in value)
    return value


@pytest.fixture(scope="module")
def db(sf):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf, db, name):
    got = catalogue.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    rows = got.select(*columns).collect()
    assert len(set(columns)) == len(columns)
    if name in catalogue.ORACLES:
        want = db.execute(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({catalogue.ORACLES[name]})").fetchall()
        a, b = (sorted(repr(tuple(canon(v) for v in r)) for r in x) for x in (rows, want))
        assert a == b


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    out = entry.entry(spark)
    assert out.columns == ["lang", "missing_literals", "failing_pairs"] and out.count() > 0
