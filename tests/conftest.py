import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from twinsync.rules import SYSTEM_A, SYSTEM_B  # noqa: E402
from twinsync import schemas  # noqa: E402
from twinsync.session import local_session  # noqa: E402
from twinsync.sources.tables import Tables  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 8, **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


def day(number: int) -> datetime:
    return datetime(2024, 1, number)


def snapshot_rows(spark, system, *rows):
    """Snapshot rows from dicts; ``id``, ``modified`` and ``email`` stand for the system's own columns."""
    names = {"id": system.id, "modified": system.modified, "email": system.email}
    schema = schemas.snapshot(system)
    table = []
    for row in rows:
        named = {names.get(k, k): v for k, v in row.items()}
        assert set(named) <= set(schema.names), named
        table.append(tuple(named.get(c) for c in schema.names))
    return spark.createDataFrame(table, schema)


def a_rows(spark, *rows):
    return snapshot_rows(spark, SYSTEM_A, *rows)


def b_rows(spark, *rows):
    return snapshot_rows(spark, SYSTEM_B, *rows)


def as_dicts(df, *order):
    return [row.asDict() for row in (df.orderBy(*order) if order else df).collect()]
