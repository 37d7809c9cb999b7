import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ratestar.session import build_session

    session = build_session(
        "local[8]", name="tests", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
        spark_driver_memory="8g", spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from ratestar.sources.order_star import OrderStar

    return OrderStar(spark, SF_DIR)
