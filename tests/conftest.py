import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import drop_scratch, get_spark
    s = get_spark("local[*]", shuffle_partitions=8,
                  extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    drop_scratch(s)
    s.stop()
