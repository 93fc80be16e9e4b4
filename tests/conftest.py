import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("claimsmith-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "4g")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="claimsmith-test-warehouse-"))
         .config("spark.sql.codegen.hugeMethodLimit", "8000")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="claimsmith-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from claimsmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
