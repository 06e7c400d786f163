import tempfile

import pytest

from paceforge.session import local_session


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="paceforge-")
    session = local_session(
        8,
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/checkpoints",
    )
    yield session
    session.stop()


@pytest.fixture()
def database(spark, request):
    """An empty database of its own for one test."""
    name = "t_" + request.node.name.split("[")[0][:60]
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by all."""
    found = [tuple(row) for row in df.collect()]
    names = df.columns
    picks = [names.index(c) for c in order] or range(len(names))
    return sorted(found, key=lambda r: [(r[i] is not None, r[i]) for i in picks])
