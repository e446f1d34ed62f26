from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()
