import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tapeworks.session import get_session

    shared = tmp_path_factory.mktemp("shared")
    session = get_session(
        "local[4]", 4, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"file://{shared}/warehouse"}
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.environment.setdefault("PYTHONPATH", str(ROOT))
    yield session
    session.stop()
