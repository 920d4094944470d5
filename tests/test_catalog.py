import pytest

from quirelake.plans import catalog
from tests.compare import connect, same_rows

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, con, name):
    same_rows(catalog.queries()[name](spark, data), con, SQL[name])


def test_flagship(spark, data):
    import __spark_entry__

    assert __spark_entry__.queries()["chunk_stats"](spark, data).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
