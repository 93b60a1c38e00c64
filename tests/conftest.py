import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion_ops.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mo-warehouse-")})
    yield s
    s.stop()


