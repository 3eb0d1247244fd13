"""Small tables with awkward rows and clashing column names."""

import pytest

FOLDER = "/root/testdata/sf0.001"

ODD = "Ünï   x　 don't\x1c 12345 ²³ 😀\n\n  \t end"


@pytest.fixture
def table(spark):
    """Rows as a DataFrame with extra columns whose names an operator might use itself."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", "'x' AS size", "1 AS kept", "2 AS key", "3 AS fp", "'y' AS digest", "0 AS row", "'z' AS doc")

    return make
