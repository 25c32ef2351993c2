import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfscout.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        cores=4,
        shuffle_partitions=4,
        conf={
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


def rows(df):
    """Rows as plain tuples in no particular order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
