import pytest


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def of(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)

    return of


@pytest.fixture
def frame(spark):
    def of(data, schema):
        return spark.createDataFrame(data, schema)

    return of
