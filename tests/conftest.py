import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waybill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests", "local[4]", 4, {"spark.driver.memory": "4g", "spark.checkpoint.dir": folder}
    )
    yield session
    session.stop()
