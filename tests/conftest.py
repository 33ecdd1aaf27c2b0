import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercadal.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "mercadal-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def interpreted(request):
    """Hand fixtures are tiny: compiling their plans would take most of the time.
    The comparisons with SQL and the kernel run compiled, as users do."""
    if "spark" not in request.fixturenames:
        yield
        return
    session = request.getfixturevalue("spark")
    compiled = request.module.__name__.endswith(("test_oracles", "test_pipeline"))
    mode = {"spark.sql.codegen.wholeStage": "true" if compiled else "false"}
    for key, value in mode.items():
        session.conf.set(key, value)
    yield
    session.conf.set("spark.sql.codegen.wholeStage", "true")
