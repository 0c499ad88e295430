import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session._marquee_shared_dir = str(tmp_path_factory.mktemp("shared"))
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
