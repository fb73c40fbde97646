"""Every job against its check SQL on the smallest tables."""

import pytest

from compare import DATA, compare, connect
from protolith.plans import CHECKS, JOBS

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(JOBS))
def test_job(spark, con, name):
    df = JOBS[name](spark, SF)
    if name in CHECKS:
        assert compare(df, con, CHECKS[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
