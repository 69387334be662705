import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessera.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *by):
    """Collected rows as plain tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


from pyspark import cloudpickle  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])
