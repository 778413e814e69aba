import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ampora.session import build_session
    ck = tempfile.mkdtemp(prefix="ampora-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="ampora-test-warehouse-")
    s = build_session(f"local[{os.environ.get('TEST_CPUS', '*')}]", app_name="ampora-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": ck, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from ampora.session import scratch_path
    return scratch_path(spark, "t")
