"""Physical-plan properties of every registered query of the library: JVM-only execution
(no Python UDF), no cartesian or nested-loop joins, pruned scans."""

import pytest

import __spark_entry__ as E
from chatmill.plans.catalog import QUERIES

from .conftest import SF0001

_PLANS = {}


def _plan(spark, name):
    if name not in _PLANS:
        df = E.queries()[name](spark, SF0001)
        qe = df._jdf.queryExecution()
        _PLANS[name] = qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()
    return _PLANS[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    plan = _plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name,unread", [("normalize_text", ["lang", "n_chars", "source"]),
                                         ("convert_triples", ["n_chars"]),
                                         ("cap_per_source", ["text", "lang", "n_chars"])])
def test_scans_read_only_needed_columns(spark, name, unread):
    scans = [line for line in _plan(spark, name).splitlines() if "ReadSchema" in line and "documents" in line]
    assert scans
    for line in scans:
        schema = line.split("ReadSchema:")[1]
        for col in unread:
            assert f"{col}:" not in schema, f"{name} reads {col}: {schema}"
