"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stemma.session import get_spark

    own = tmp_path_factory.mktemp("spark")
    s = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(own / "warehouse"),
            "spark.checkpoint.dir": f"file://{own / 'shared'}",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
