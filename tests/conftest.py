import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from chronoloom.session import session

    s = session(
        "tests",
        spark_master="local[4]",
        **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from chronoloom.sources.tables import Scratch

    return Scratch(spark, "test")


CLASHES = ["label", "node", "key", "cell", "part", "i", "j", "n", "rank", "score", "value", "place", "total", "size", "v", "u", "form", "own", "_p", "_n", "block", "found", "count_"]


@pytest.fixture
def cluttered():
    """Adds columns whose names operators might use inside."""

    def add(df):
        for c in CLASHES:
            if c not in df.columns:
                df = df.withColumn(c, F.lit("clash"))
        return df

    return add
