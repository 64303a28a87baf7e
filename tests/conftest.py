import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clinframe import get_spark
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="clinframe-warehouse-")   # local test session only
    s = get_spark("local[4]", app="clinframe-tests", shuffle_partitions=4,
                  **{"spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4",
                     "spark.sql.warehouse.dir": warehouse,
                     "spark.checkpoint.dir": tempfile.mkdtemp(prefix="clinframe-checkpoints-")})
    yield s
    s.stop()
