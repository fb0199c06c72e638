import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from transferlens.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "transferlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows(spark):
    """Transfers from (contract, from, to, value, time) tuples with amounts as text, in both amount forms."""
    from pyspark.sql import functions as F

    from transferlens.functions.amounts import DECIMAL38, u256_from_hex

    def build(data, amounts="u256"):
        records = [(130, 10 + i, i, *record, format(int(record[3]), "064x")) for i, record in enumerate(data)]
        t = spark.createDataFrame(
            records,
            "chain_id bigint, block_number bigint, log_index bigint, contract_address string, "
            "from_address string, to_address string, value string, time string, digits string",
        )
        value = u256_from_hex(F.col("digits")) if amounts == "u256" else F.col("value").cast(DECIMAL38)
        timed = t.withColumn("value", value).withColumn("block_timestamp", F.col("time").cast("timestamp"))
        return timed.drop("time", "digits")

    return build


@pytest.fixture
def names(spark):
    def build(*data):
        return spark.createDataFrame(list(data), "contract_address string, name string, symbol string, decimals smallint")

    return build
