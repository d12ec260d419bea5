import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from merchlens.session import local_session, tune

    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = local_session(8, 4, **{"spark.checkpoint.dir": scratch})
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def star(spark, sf_dir):
    from merchlens import RetailStar

    return RetailStar(spark, sf_dir)
