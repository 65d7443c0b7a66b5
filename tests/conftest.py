import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from morbidity.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="morbidity-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tuned(session)


@pytest.fixture
def make(spark):
    """Rows and a schema to a DataFrame; ISO text in date columns becomes dates."""
    from datetime import date

    from pyspark.sql.types import _parse_datatype_string as parse

    def build(schema, rows):
        fields = parse(schema).fields
        typed = [
            tuple(
                date.fromisoformat(v) if f.dataType.simpleString() == "date" and isinstance(v, str) else v
                for f, v in zip(fields, row)
            )
            for row in rows
        ]
        return spark.createDataFrame(typed, schema)

    return build


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, dates as ISO text."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        plain = [tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in r) for r in picked.collect()]
        return sorted(plain, key=repr)

    return collect
