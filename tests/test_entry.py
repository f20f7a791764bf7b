"""The driver contract: every query runs on the smallest tables, those with SQL give its rows."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from phasemill.plans import catalogue, exchange, pipeline, quality, stages, streams

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
CORE = [n for m in (quality, catalogue, stages, exchange, pipeline, streams) for n in m.QUERIES]


@pytest.fixture(autouse=True, scope="module")
def shared_signals():
    """Signals, and probabilities by kind and folds, are the same in all queries here: computed once."""
    made, patch = {}, pytest.MonkeyPatch()
    for name in ("signals", "_posteriors"):
        once = getattr(pipeline, name)

        def run(spark, d, *a, once=once, name=name, **k):
            key = (name, d, a, tuple(k.items()))
            if key not in made:
                out = once(spark, d, *a, **k)
                made[key] = pipeline.materialize(out, "kept") if name == "signals" else out
            return made[key]

        patch.setattr(pipeline, name, run)
    yield
    patch.undo()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: "-" if v is None or v != v else f"{v + 0.0:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and set(CORE) <= set(queries)
    assert {f"p{n}_found" for n in (1, 2, 3, 6)} <= set(queries)
    assert entry.entry(spark).columns == ["take", "kind", "start_ms", "end_ms"]


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, D)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql:
        want = duck.sql(sql)
        assert sorted(df.columns) == sorted(want.columns)
        assert plain(df.columns, rows) == plain(want.columns, want.fetchall())
