import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.operators import monitor as M
from innspark.plans import storage


def test_exact_percentiles_equal_numpy(spark):
    rng, ps = random.Random(3), [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    data = {"many": [rng.gauss(0, 9) for _ in range(3000)], "one": [5.0], "two": [1.0, 2.0],
            "ties": [rng.randrange(4) * 1.0 for _ in range(1000)]}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("many", None), ("none", None)]
    got = {r.k: r for r in X.exact_percentiles(
        spark.createDataFrame(rows, "k string, v double").repartition(5), ["k"], "v", ps).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        assert got[k].percentiles == pytest.approx(np.quantile(vs, ps).tolist())


def test_root_cause_climbs_any_depth_and_finds_cycles(spark):
    n = 14
    edges = spark.createDataFrame([(k, k - 1) for k in range(2, n + 1)], "titik_id int, depends_on_titik_id int")
    events = spark.createDataFrame([(k,) for k in range(1, n + 1)], "titik_id int")
    got = {r.titik_id: (r.root_titik_id, r.depth, r.is_root) for r in M.root_cause(events, edges).collect()}
    assert got == {k: (1, k - 1, k == 1) for k in range(1, n + 1)}
    ring = edges.union(spark.createDataFrame([(1, n)], edges.schema))
    with pytest.raises(ValueError):
        M.root_cause(events, ring)
