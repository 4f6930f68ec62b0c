import tempfile

import duckdb
import pytest

import __spark_entry__ as E
from affinity.plans.catalog import queries as _catalogue

CATALOGUE = _catalogue()
SMOKE = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["sno", "cno", "pre_score"]
    assert df.count() >= 0


def test_catalogue_keys():
    q = E.queries()
    o = E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if not (k == "pipeline" or k.startswith("op"))}
    assert own - set(o) == {"kmeans_assign", "cluster_sizes"}


def _canon(df):
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(None if (isinstance(v, float) and v != v) else
                          (float(f"{v:.9g}") if isinstance(v, float) else
                           (v.item() if hasattr(v, "item") else v)) for v in rec))
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"SET temp_directory='{tempfile.mkdtemp(prefix='duck-')}'")
    con.execute("SET max_temp_directory_size='2GB'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(CATALOGUE)))
def test_query_matches_sql_on_smoke_data(spark, duck, name):
    got = E.queries()[name](spark, SMOKE).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


@pytest.mark.parametrize("name", ["kmeans_assign", "cluster_sizes"])
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SMOKE)
    assert df.count() > 0
