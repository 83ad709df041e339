import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tabloom.session import build_session  # noqa: E402
from tabloom.sources.tables import Tables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture
def values(spark):
    """``values("a int, b string", (1, "x"), ...)`` as a DataFrame."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def same():
    """Equal bags of rows, compared column by column name."""

    def check(left, right):
        columns = sorted(left.columns)
        assert columns == sorted(right.columns)
        one, two = left.select(columns), right.select(columns)
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))

    return check
