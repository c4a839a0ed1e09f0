from __future__ import annotations

import pytest

from talktally.llm.frames import ship_modules


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_modules(spark)
