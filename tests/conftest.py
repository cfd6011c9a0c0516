import pytest

from firmfold.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[4]", shuffle_partitions=2,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
           "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Evaluate a Column function over a list of values of one column."""
    from pyspark.sql import functions as F

    def run(values, fn, type_="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
        rows = frame.select("i", fn(F.col("x")).alias("y")).collect()
        return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
