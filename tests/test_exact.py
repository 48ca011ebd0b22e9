"""Exact p-values against all orders of small samples, the stop rule against a loop, leaves against the model's text."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain.operators import monitoring as Q, serving, topics as K, training


def _gap(a, b):
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in (*a, *b))


@pytest.mark.parametrize("n,m", [(1, 1), (3, 3), (2, 5), (6, 4), (5, 5)])
def test_exact_p_value_counts_every_order(n, m):
    gaps = []
    for chosen in itertools.combinations(range(n + m), n):
        gaps.append(_gap(chosen, [i for i in range(n + m) if i not in chosen]))
    for score in {round(g, 12) for g in gaps}:
        assert math.isclose(Q.ks_exact_p(n, m, score), sum(g >= score - 1e-9 for g in gaps) / len(gaps), abs_tol=1e-12)


def test_exact_p_value_of_large_samples_is_near_the_limit_and_bounded():
    for n, m, d in ((400, 300, 0.08), (2000, 2000, 0.03), (10_000, 9_000, 0.02)):
        x2 = d * d * n * m / (n + m)
        limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x2) for k in range(1, 100))
        assert abs(Q.ks_exact_p(n, m, d) - limit) < 0.05
    assert Q.ks_exact_p(500, 700, 0.0) == 1.0 and 0 <= Q.ks_exact_p(500, 700, 1.0) < 1e-9


def test_drift_is_exact_up_to_a_size_and_null_without_values(spark):
    rng = random.Random(2)
    a, b = [[(float(rng.randrange(5)), None) for _ in range(n)] for n in (7, 9)]
    frames = [spark.createDataFrame(x, "t DOUBLE, none DOUBLE") for x in (a, b)]
    got = {r["feature"]: r for r in Q.ks_drifts(*frames, ["t", "none"]).collect()}
    score = _gap([x for x, _ in a], [x for x, _ in b])
    assert math.isclose(got["t"]["ks_score"], score) and math.isclose(got["t"]["p_value"], Q.ks_exact_p(7, 9, score))
    assert got["none"]["p_value"] is None
    rough = Q.ks_drift(*frames, "t", exact_rows=8).first()["p_value"]
    assert rough == Q.ks_drift(*frames, "t", exact_rows=0).first()["p_value"]


@pytest.mark.parametrize("stop,most", [(1, None), (3, None), (3, 4), (50, None), (50, 11), (2, 0)])
def test_reading_stops_after_a_run_of_invalid_messages(spark, hot, stop, most):
    hot(10, 5)
    rng = random.Random(stop)
    good = '{"event_time":"t","horizon_hours":1,"temperature_prediction":1.0,"model_name":"m","model_version":"v","created_at":"c"}'
    rows = [(i, good if rng.random() < 0.6 else rng.choice(["{}", "x", None])) for i in range(60)]
    want, idle = [], 0
    for i, value in rows:
        if most is not None and len(want) >= most or idle >= stop:
            break
        want, idle = ([*want, i], 0) if value == good else (want, idle + 1)
    df = spark.createDataFrame(rows, "id LONG, value STRING").repartition(3)
    assert sorted(r["id"] for r in K.bounded_read(df, "predictions", most, ["id"], stop_after=stop).collect()) == want


def test_leaves_of_the_node_table_are_those_of_the_models_text(spark):
    df = spark.range(400).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                 (F.col("id") % 17 * 2.0 + F.rand(1)).alias("y"))
    model = training.train(df, ["a", "b"], "y", numTrees=5, maxDepth=4)
    trees = re.split(r"\n\s*Tree \d+ \(weight [^)]*\):", model.stages[-1].toDebugString)[1:]
    table = serving.leaf_table(model)
    for row, tree in zip(table, trees, strict=True):
        leaves = [float(v) for v in re.findall(r"Predict: (\S+)", tree)]
        assert np.allclose(row[: len(leaves)], leaves) and np.isnan(row[len(leaves):]).all()
