import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        **{
            "spark.checkpoint.dir": str(folder / "work"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()
