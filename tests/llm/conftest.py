import pytest

from ampora.llm.ship import ship


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship(spark)
