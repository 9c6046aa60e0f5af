import io
import os
import sys
from contextlib import redirect_stdout

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline.schemas import ddl  # noqa: E402
from tramline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(root / "checkpoints"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Builds a table from dicts that name only the columns that matter."""

    def build(columns, *values):
        return spark.createDataFrame([tuple(value.get(name) for name in columns) for value in values], ddl(columns))

    return build


def values(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is not None, str(v)) for v in row))


def plan_of(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue()
