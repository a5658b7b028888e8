import pytest
from tidegate.runtime import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)
