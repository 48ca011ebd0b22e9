import math

import pytest

from skygrain.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "skygrain-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def hot(spark):
    """Treat every key above a few rows as hot and keep Spark from merging the small ranges of the test data."""
    from skygrain.plans.skew import HOT_ROWS_CONF

    merge = "spark.sql.adaptive.coalescePartitions.enabled"

    def switch(rows: int = 15, ranges: int = 9) -> None:
        spark.conf.set(HOT_ROWS_CONF, str(rows))
        spark.conf.set(merge, "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))

    yield switch
    spark.conf.unset(HOT_ROWS_CONF)
    spark.conf.set(merge, "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def same(a, b, digits: int = 9) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=10**-digits, abs_tol=10**-digits)
    if isinstance(a, (list, tuple)):
        return len(a) == len(b) and all(same(x, y, digits) for x, y in zip(a, b))
    return a == b


def assert_same_rows(left, right, key):
    names = sorted(left.columns)
    assert names == sorted(right.columns)
    a = left.select(*names).orderBy(*key).collect()
    b = right.select(*names).orderBy(*key).collect()
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for n in names:
            assert same(x[n], y[n]), (n, x, y)
