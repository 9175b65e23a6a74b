import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from everkey.session import local_session

    settings = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))}
    session = local_session(4, "everkey-tests", **{**settings, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
