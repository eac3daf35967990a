import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from noticelake.session import build_session  # noqa: E402


# Built at import time: test modules define columns at module level.
SESSION = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="6g")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def one(spark):
    """First value of an expression over one row of literals."""

    def run(expr, **values):
        schema = ", ".join(f"{k} {_type(v)}" for k, v in values.items()) or "x int"
        row = tuple(values.values()) or (1,)
        return spark.createDataFrame([row], schema).select(expr.alias("out")).first()["out"]

    def _type(v):
        if isinstance(v, list):
            return "array<string>"
        return {int: "bigint", float: "double", bytes: "binary"}.get(type(v), "string")

    return run
