import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

RUN_TS = datetime(2024, 6, 1, 12, 0, 0)
AS_OF = date(2024, 6, 1)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=int(os.environ.get("TEST_CPUS", "8")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate column expressions over a list of texts."""

    def run(texts, make, type_="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {type_}")
        return [r[1] for r in df.select("i", make(F.col("c"))).orderBy("i").collect()]

    return run
