import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from matchloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate column expressions over one row of literals."""
    def evaluate(*columns, **values):
        from pyspark.sql import functions as F

        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
        return df.select(*columns).first()[0] if len(columns) == 1 else tuple(df.select(*columns).first())

    return evaluate
