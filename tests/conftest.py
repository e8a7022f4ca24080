import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lectern.session import get_session

    made = get_session("local[4]", 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
