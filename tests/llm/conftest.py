from __future__ import annotations

import pytest

from pairforge.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """The operators' modules on the executors."""
    ship(spark)
