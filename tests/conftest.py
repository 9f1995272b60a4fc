import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark
    # tests own their checkpoint folder (on a cluster the setting is given)
    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = get_spark("tidemark-tests", master="local[4]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def store(spark):
    from tidemark.session import new_work_dir
    from tidemark.sources.tables import TableStore
    return TableStore(spark, new_work_dir(spark, "test"))


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().optimizedPlan().toString()
