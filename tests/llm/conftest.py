import pytest
from llm_frames import EDGES, frame


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, EDGES).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, EDGES[:1]).limit(0)
