import pytest


@pytest.fixture
def rows():
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]
