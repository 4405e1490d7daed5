import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from starlake.session import local_session
    wh_dir = tempfile.mkdtemp(prefix="starlake-warehouse-")
    s = local_session("*", app="starlake-tests", extra={"spark.sql.shuffle.partitions": "8",
                                                        "spark.sql.warehouse.dir": wh_dir})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh(spark):
    from starlake.plans.settings import REGISTERED
    from starlake.plans.warehouse import Warehouse
    return Warehouse(spark, SF, REGISTERED)


@pytest.fixture(scope="session")
def built(spark, tmp_path_factory):
    from starlake.plans.build import build
    from starlake.plans.settings import REGISTERED
    return build(spark, SF, str(tmp_path_factory.mktemp("build") / "wh"), REGISTERED)
