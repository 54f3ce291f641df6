from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.shuffle.partitions": "4",
        }
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir() -> str:
    return "/root/testdata/sf0.001"
