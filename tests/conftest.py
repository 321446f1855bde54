import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quotelake.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


def rows(df, *order):
    """Rows as dicts, sorted by the given columns."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[c]) for c in order)) if order else out


def one(df):
    found = rows(df)
    assert len(found) == 1
    return found[0]
