import pytest
from pyspark.sql import SparkSession

from checks.views import credit, part

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def credit_rows(spark, tmp_path_factory):
    """Cleaned rows of the smallest scale, stored once."""
    path = str(tmp_path_factory.mktemp("credit") / "rows")
    credit(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def train(credit_rows):
    return part(credit_rows, "train")


@pytest.fixture(scope="session")
def test_rows(credit_rows):
    return part(credit_rows, "test")
