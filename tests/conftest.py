import pytest

from plateia.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function on a list of values."""
    from pyspark.sql import functions as F

    def run(function, values, kind="string"):
        rows = [(place, value) for place, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"place INT, value {kind}")
        out = df.select("place", function(F.col("value")).alias("out")).orderBy("place")
        return [row.out for row in out.collect()]

    return run
