from __future__ import annotations

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Workers find the package wherever the tests are started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, os.environ.get("PYTHONPATH"))))

from samples import ODD  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, out string")
    return docs.selectExpr("*", "out AS row", "out AS id", "out AS n", "out AS spans", "out AS key", "out AS digest")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
