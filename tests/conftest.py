import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "millrace-tests", "local[8]",
        **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="millrace-"), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return lambda label: scratch_path(spark, label)


@pytest.fixture
def database(spark):
    from millrace.plans.registry import scratch_database

    return scratch_database(spark)


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "a bigint, b bigint")


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    """The physical plan as text."""
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
