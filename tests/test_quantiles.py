import random

import numpy as np
import pytest

from chatmill.operators import quantiles


@pytest.mark.parametrize("fan", [2, 16, 4096])
def test_exact_quantiles(spark, monkeypatch, fan):
    monkeypatch.setattr(quantiles, "FAN", fan)
    rng = random.Random(4)
    groups = {"a": [rng.randrange(10**6) for _ in range(501)], "b": [7] * 300 + [9], None: [0], "c": [rng.randrange(5) for _ in range(40)] + [10**9]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g2 string, length long").repartition(5)
    out = {r.g2: (r.low, r.median, r.p95) for r in quantiles.exact_quantiles(df, "length", {"low": 0.0, "median": 0.5, "p95": 0.95}, ["g2"]).collect()}
    assert out.keys() == groups.keys()
    for g, vs in groups.items():
        assert out[g] == pytest.approx(tuple(np.quantile(vs, [0, 0.5, 0.95])))


def test_quantiles_of_one_group_and_of_nothing(spark):
    df = spark.createDataFrame([(v,) for v in (5, 1, 3, 2)], "n int")
    assert [tuple(r) for r in quantiles.exact_quantiles(df, "n", {"median": 0.5}).collect()] == [(2.5,)]
    assert quantiles.exact_quantiles(df.limit(0), "n", {"median": 0.5}).collect() == []
