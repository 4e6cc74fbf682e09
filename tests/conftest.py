import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tamper.session import SESSION_DEFAULTS

    b = (SparkSession.builder.master("local[4]").appName("tamper-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "4g"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    # Tests own their scratch space. The setting is static: it belongs to the builder.
    b = b.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt")))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
