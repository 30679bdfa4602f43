import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetspark.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]", "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"


def rows(df):
    """Rows as a sorted list of tuples in column-name order, decimals as floats."""
    columns = sorted(df.columns)
    out = []
    for row in df.collect():
        values = []
        for c in columns:
            v = row[c]
            values.append(float(v) if type(v).__name__ == "Decimal" else v)
        out.append(tuple(values))
    return sorted(out, key=repr)
