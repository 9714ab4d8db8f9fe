import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    from sediment.staging import Staging

    return Staging(spark)


@pytest.fixture
def frame(spark):
    """A DataFrame from a DDL schema and tuples."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))
