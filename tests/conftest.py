import pytest

from ledgerlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
