from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession
from pyspark.sql.types import DecimalType, StringType, StructType

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lotflow.session import configure  # noqa: E402
from lotflow.sources.schemas import ERP, WORK  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lotflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def table(spark):
    """A table in one of the known schemas from rows as dicts; text left out is blank, numbers 0."""

    def build(name: str, *rows: dict):
        schema = StructType.fromDDL(ERP.get(name) or WORK[name])
        unknown = {k for r in rows for k in r} - set(schema.names)
        assert not unknown, unknown

        def value(field, row):
            if field.name not in row:
                if field.name == "mandt":
                    return "168"
                if isinstance(field.dataType, StringType):
                    return " "
                return Decimal(0) if isinstance(field.dataType, DecimalType) else None
            given = row[field.name]
            return Decimal(str(given)) if isinstance(field.dataType, DecimalType) and given is not None else given

        return spark.createDataFrame([tuple(value(f, r) for f in schema) for r in rows], schema)

    return build


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of plain tuples."""

    def collect(df, *columns: str):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect
