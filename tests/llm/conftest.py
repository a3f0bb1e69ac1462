from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def shipped(spark):
    from salesloom.llm.shipping import ship

    ship(spark)
    return spark
