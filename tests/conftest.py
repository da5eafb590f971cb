import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from calibra.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(shuffle_partitions=2)


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
