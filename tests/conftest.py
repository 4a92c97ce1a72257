import os
import sys

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from foldmark.session import session

    s = session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="3g", spark__ui__showConsoleProgress="false",
                spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
