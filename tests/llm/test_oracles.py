import pytest

from affinity.llm.oracle import oracle_sql
from affinity.llm.queries import queries

from .conftest import SMOKE


def rows_of(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, SMOKE).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
