import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidelog.session import get_spark

    b = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    b.getOrCreate()
    s = get_spark(shuffle_partitions=8)
    assert s.sparkContext.uiWebUrl is None, "the Spark UI must stay off"
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidelog-test-"))
    yield s


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
