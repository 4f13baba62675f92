import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.session import session

RUN_TS = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    return session(cpus="4", memory="6g")


@pytest.fixture
def run_ts():
    return RUN_TS


@pytest.fixture
def layers(tmp_path):
    """A fresh warehouse with database names of its own."""
    from uuid import uuid4

    from tillstar.sources.layers import Layers

    tag = uuid4().hex[:8]
    return Layers(str(tmp_path), f"raw_{tag}", f"processed_{tag}", f"star_{tag}")
