from __future__ import annotations

import sys
from datetime import timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from generated import HISTORY_COLUMNS, ISSUE_COLUMNS, ISSUES, T0  # noqa: E402

from trackmill.session import build_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "trackmill-tests", "local[4]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="4g", spark__sql__maxMetadataStringLength="100000",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def issues(spark):
    return spark.createDataFrame(ISSUES, ISSUE_COLUMNS).cache()


@pytest.fixture(scope="session")
def history(spark):
    rows = [
        (i, str(1 + i % 10), f"TYPE-{1 + i % 10}", f"c{i}", T0 - timedelta(hours=i), f"user-{i % 5}",
         f"Hand {i % 5}", None, ("status", "assignee", "priority", "summary")[i % 4], None, None, "x",
         None, "X")
        for i in range(30)
    ]
    return spark.createDataFrame(rows, HISTORY_COLUMNS).cache()
