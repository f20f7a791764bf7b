"""Every query of the subpackage on the smallest tables, those with SQL against it."""

import glob
import os

import duckdb
import pytest

from phasemill.llm.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, D)
    rows = sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
    if name in ORACLES:
        con = duckdb.connect()
        for p in glob.glob(f"{D}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
        rel = con.sql(ORACLES[name])
        assert rows == sorted(map(str, rel.select(*[f'"{c}"' for c in sorted(rel.columns)]).fetchall()))


def test_whole_tables_are_covered(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    assert QUERIES["p7_ids"](spark, D).count() == docs.count()
