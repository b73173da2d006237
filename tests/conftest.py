import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from souk.session import local_session

    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        "8",
        "tests",
        **{
            "spark.checkpoint.dir": str(folder),
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    from __spark_entry__ import warehouse

    return warehouse(spark, SMALL)


@pytest.fixture
def store(spark, tmp_path):
    from souk.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "store"))
