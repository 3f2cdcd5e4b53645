import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quillmark.session import local_session

    return local_session("tests", 4)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def folder():
    import tempfile

    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def one(spark):
    """Values of a column expression over rows given as DDL schema and tuples, in order."""
    from pyspark.sql import functions as F

    def run(schema, rows, make):
        numbered = [(i, *r) for i, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"_i int, {schema}")
        return [r.v for r in df.select("_i", make(F.col).alias("v")).orderBy("_i").collect()]

    return run
