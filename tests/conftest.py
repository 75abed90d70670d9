import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tunetable.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, app="tests")
    # Keep several partitions on small tables, so that carries between them are tested.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return session


@pytest.fixture
def one(spark):
    """Evaluate column expressions on one row."""

    def run(**cols):
        return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()

    return run
