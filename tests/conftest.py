from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexmill.session import session

    made = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def value(spark):
    """The value of a column expression."""

    def one(column, **columns):
        rows = [tuple(columns.values())] if columns else [(1,)]
        from pyspark.sql import types as T

        kinds = {str: T.StringType(), int: T.LongType(), float: T.DoubleType(), list: T.ArrayType(T.StringType()), type(None): T.StringType()}
        schema = T.StructType([T.StructField(k, kinds[type(v)]) for k, v in columns.items()]) if columns else "x int"
        return spark.createDataFrame(rows, schema).select(column.alias("v")).first()["v"]

    return one
