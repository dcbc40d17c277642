import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from snapmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tiny inputs: interpreting an expression is quicker than compiling it.
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__sql__sources__parallelPartitionDiscovery__threshold="256",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    """The plan Spark ran, or will run."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
