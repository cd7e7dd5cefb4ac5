"""Every registered query of the engine against its oracle, on the smallest tables."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from tokenmix import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_oracle(spark, duck, tmp_path, name):
    out = str(tmp_path / "out")
    queries.queries()[name](spark, SF).write.parquet(out)
    want, got = duck.sql(queries.oracle_sql()[name]), duck.sql(f"SELECT * FROM '{out}/*.parquet'")
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    pick = ", ".join(f'"{c}"' for c in cols)
    assert sorted(duck.sql(f"SELECT {pick} FROM want").fetchall(), key=key) == sorted(duck.sql(f"SELECT {pick} FROM got").fetchall(), key=key)
    assert {c: str(t) for c, t in zip(want.columns, want.types)} == {c: str(t) for c, t in zip(got.columns, got.types)}


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(queries.oracle_sql())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 20
