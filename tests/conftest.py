import itertools

import pytest

from perron.session import local_session
from perron.sinks.warehouse import Warehouse


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        cores=8,
        shuffle_partitions=4,
        **{
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield session
    session.stop()


_numbers = itertools.count()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"), prefix=f"t{next(_numbers)}_")


def rows(frame, *columns):
    """The rows as a sorted list of tuples; NULL sorts first."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
