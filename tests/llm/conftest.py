import pytest

from tickloom.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship(spark)


@pytest.fixture
def table(spark, tmp_path):
    """A table in files, as the operators get it: rows to a frame read from Parquet."""
    made = iter(range(1000))

    def write(rows, schema):
        path = str(tmp_path / f"t{next(made)}")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return write
