import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from railmill.session import local_session

    session = local_session(8, app="railmill-tests", memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def sql(spark):
    """Runs SQL text; VALUES lists make the small fixtures."""
    return spark.sql


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
