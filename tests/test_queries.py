"""Every registered query of the library itself against its DuckDB SQL."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from fieldloom.plans.queries import QUERIES, SQL


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, sf_dir, name):
    found, wanted = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


def test_samples(spark, sf_dir):
    n = QUERIES["sample_n"](spark, sf_dir)
    assert n.count() == 100 and n.collect() == QUERIES["sample_n"](spark, sf_dir).collect()
    fields = QUERIES["sample_fields"](spark, sf_dir)
    assert fields.groupBy("field").count().agg({"count": "max"}).first()[0] <= 10


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
