from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from replyloom import configure  # noqa: E402

# Workers import the packages and the test modules from here, wherever pytest was started.
os.environ["PYTHONPATH"] = os.pathsep.join([*sys.path[:2], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to many strings at once, in order."""

    def apply(function, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        from pyspark.sql import functions as F

        return [r.out for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return apply


@pytest.fixture(scope="session")
def grouped_columns():
    """Names of the columns that reach any aggregate of a frame's plan."""
    import re

    def find(df):
        plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        parts = re.findall(r"\(\d+\) \w*Aggregate\b.*?\nInput(?: \[\d+\])?: \[(.*?)\]\n", plan, re.S)
        return {re.sub(r"#\d+L?$", "", c.strip()) for p in parts for c in p.split(",")}

    return find
