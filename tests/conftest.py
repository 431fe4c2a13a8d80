import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakeops.session import clear_scratch, local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", 4, "4g", {"spark.checkpoint.dir": shared})
    assert session.conf.get("spark.checkpoint.dir") == shared
    yield session
    clear_scratch(session)
    session.stop()
