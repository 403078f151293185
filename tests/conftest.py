import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gleaner.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", "local[*]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression over one row of literals."""
    from pyspark.sql import functions as F

    return lambda column: spark.range(1).select(column.alias("x")).first()["x"] if hasattr(column, "alias") else F.lit(column)
