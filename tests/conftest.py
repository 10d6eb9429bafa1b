import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayfare.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wayfare-tests",
        **{
            "spark__master": "local[8]",
            "spark__sql__shuffle__partitions": "8",
            "spark__ui__enabled": "false",
            "spark__ui__showConsoleProgress": "false",
            "spark__driver__memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
