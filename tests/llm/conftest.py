import pytest


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
