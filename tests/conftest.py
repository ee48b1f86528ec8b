import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from folio.session import session

    made = session(
        f"local[{os.environ.get('TEST_CPUS', '4')}]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "3g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.sql.warehouse.dir": f"file://{tmp_path_factory.mktemp('warehouse')}",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made


@pytest.fixture(scope="session")
def smallest():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)
