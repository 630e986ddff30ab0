import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    made = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g").getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
