import pytest


@pytest.fixture
def sf() -> str:
    return "/root/testdata/sf0.001"
