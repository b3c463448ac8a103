import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from helixframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", 4, str(tmp_path_factory.mktemp("checkpoints")))
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
