import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from respondo.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
