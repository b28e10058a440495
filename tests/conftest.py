import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cartwright.session import SESSION_DEFAULTS, configure

    b = (SparkSession.builder.master("local[*]").appName("cartwright-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)  # uses spark.checkpoint.dir, or a local temp folder when unset
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from cartwright.session import scratch_dir

    return scratch_dir(spark, f"test-{request.node.name[:40]}")
