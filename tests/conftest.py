import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from filetally.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("filetally-tests")
        .master("local[2]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from dicts against a declared schema; missing fields are null."""

    def make(schema, *records):
        names = schema.names
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)

    return make


@pytest.fixture
def column(spark):
    """Apply a column builder to a list of values of column ``v``."""

    def apply(values, build):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.out for r in df.select("i", build("v").alias("out")).orderBy("i").collect()]

    return apply


@pytest.fixture
def fails_with():
    """The job fails and its error names the rule."""
    from contextlib import contextmanager

    @contextmanager
    def check(text):
        with pytest.raises(Exception) as caught:
            yield
        assert text in str(caught.value)

    return check
