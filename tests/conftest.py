import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from threadloom import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", memory="8g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A DataFrame out of tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
