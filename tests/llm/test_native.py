"""Operators that must stay within DataFrame functions."""

from pathlib import Path

import pytest
from helpers import plan

from quayside.llm import catalog, licenses, quality, sharding

DATA = Path("/root/testdata/sf0.001")
NATIVE = {"op3_sharding": sharding, "op7_licenses": licenses, "op8_quality": quality}


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python(name):
    text = Path(NATIVE[name].__file__).read_text()
    for word in ("map_rows", "rewrite_text", "udf", "InPandas", "InArrow", ".rdd", "pandas"):
        assert word not in text


@pytest.mark.skipif(not DATA.exists(), reason="test data not present")
@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, str(DATA)))
    for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct"):
        assert word not in text
