import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tabforge.session import local_session

    session = local_session(8, spark__sql__shuffle__partitions="4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trips(spark):
    """A small table of trips with every kind of dirt the operators must handle."""
    rows = [
        (1, 10.0, "Morning", 2.0, "Low", 5.0, "12.5", 20.0),
        (2, 200.0, " morning\t", 9.0, "High", None, "30", 35.0),
        (3, None, "Evening", 0.0, "high", 3.0, "abc", 15.0),
        (4, -3.0, None, None, "Medium", 4.0, None, -1.0),
        (5, 25.0, "NIGHT ", 3.0, None, -2.0, "NaN", 50.0),
        (6, 25.0, "Night", 3.0, "Low", 6.0, "7e1", None),
        (7, 40.0, "Evening", 6.0, "Low", 8.0, " 8 ", 60.0),
        (8, 0.0, "Evening", 1.0, "Low", 8.0, "1d", 61.0),
    ]
    return spark.createDataFrame(
        rows, "id long, km double, part string, people double, traffic string, fare double, minutes string, price double"
    )
