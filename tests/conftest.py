from __future__ import annotations

import pytest

from telemetry_lake.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
