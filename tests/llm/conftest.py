import pytest

from ferrolith.session import clean_up


@pytest.fixture(scope="module", autouse=True)
def own_tables(spark):
    """What the tests of one module settled is gone before the next module looks at what is left."""
    yield
    clean_up(spark)
