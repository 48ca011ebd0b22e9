"""A hot key cut into ranges gives the rows that one whole window gives."""

import random


import numpy as np
import pytest
from pyspark.sql import functions as F

from registry.observations import cleaned_observations, feature_input
from registry.views import KEY, ORDER, observations
from skygrain.operators import alerts, dedup, features as X, samples as M
from skygrain.plans import skew
from tests.conftest import assert_same_rows


def one_place(spark, n: int):
    """One key with n readings, several at the same time, and two small keys."""
    rng = random.Random(7)
    rows = [("hot", i, i // 3, rng.choice([None, round(rng.uniform(-20, 40), 2)])) for i in range(n)]
    rows += [("cold", i, i, float(i)) for i in range(5)] + [(None, i, i, float(i)) for i in range(4)]
    return spark.createDataFrame(rows, "location STRING, id INT, event_time INT, temperature DOUBLE")


@pytest.mark.parametrize("back,ahead", [(23, 0), (0, 6), (6, 6), (40, 3)])
def test_windows_across_ranges(spark, hot, back, ahead):
    df = one_place(spark, 60)

    def build(rows, w):
        x = F.col("temperature")
        cols = {"mean": F.avg(x).over(w.rowsBetween(-back, 0)), "n": F.count(F.lit(1)).over(w.rowsBetween(-back, 0))}
        if back:
            cols["lag"] = F.lag(x, back).over(w)
        if ahead:
            cols["lead"] = F.lead(x, ahead).over(w)
        return rows.withColumns(cols)

    whole = skew.ordered_rows(df, KEY, ORDER, build, back, ahead)
    expected = spark.createDataFrame(whole.collect(), whole.schema)
    hot(10)
    cut = skew.ordered_rows(df, KEY, ORDER, build, back, ahead)
    assert_same_rows(cut, expected, ["location", "id"])


def test_ranges_are_really_cut(spark, hot):
    hot(10)
    df = one_place(spark, 60).filter("location = 'hot'")
    ranges = skew.cut_ranges(df, KEY, ORDER)
    offsets = skew.range_offsets(ranges, KEY).orderBy(skew.PART).collect()
    assert len(offsets) > 4
    assert max(o["_n"] for o in offsets) < 30
    assert [o["_start"] for o in offsets] == [sum(p["_n"] for p in offsets[:i]) for i in range(len(offsets))]


def frozen(df):
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize(
    "make,key",
    [
        (lambda s, d: X.engineer_features_batch(cleaned_observations(s, d), KEY, ORDER, "event_time", targets=True), ["id"]),
        (lambda s, d: M.temporal_split(cleaned_observations(s, d), KEY, ORDER), ["id"]),
        (lambda s, d: M.sequences(cleaned_observations(s, d), KEY, ORDER, ["temperature"], "temperature", 5, [1, 3])
            .withColumn("x", F.col("x").cast("string")), ["id"]),
        (lambda s, d: X.engineer_features(feature_input(s, d), KEY, ORDER).select(
            "id", "base_features.*", "historical_features.temp_rolling_24h.*", "historical_features.wind_lags.*",
            "metadata.samples_accumulated", "metadata.feature_count"), ["id"]),
        (lambda s, d: dedup.flag_unchanged(observations(s, d), KEY, ORDER, {"temperature": 8.0, "humidity": 30.0}), ["id"]),
    ],
    ids=["batch_features", "split", "sequences", "engineer", "dedup"],
)
def test_operators_with_hot_keys(spark, sf, hot, make, key):
    expected = frozen(make(spark, sf))
    hot(15)
    assert_same_rows(make(spark, sf), expected, key)


def brute_fold(values, tol):
    """The dedup rule, row by row."""
    kept, anchor = [], None
    for row in values:
        differs = anchor is None or any(
            (a is None) != (b is None) or (a is not None and abs(a - b) > t) for a, b, t in zip(row, anchor, tol))
        kept.append(differs)
        anchor = row if differs else anchor
    return kept


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("step", [0.3, 0.9, 4.0])
def test_dedup_fold_over_ranges_equals_brute_force(spark, hot, seed, step):
    """Slow drift is the hard case: the accepted rows of a range depend on where the range before ended."""
    rng = random.Random(seed)
    x, rows = 0.0, []
    for i in range(150):
        x += rng.uniform(-step, step)
        humidity = None if rng.random() < 0.1 else rng.choice([50, 50, 50, 51])
        rows.append(("a", i, round(x, 2), humidity))
    df = spark.createDataFrame(rows, "location STRING, id INT, temperature DOUBLE, humidity INT")
    tol = {"temperature": 1.0, "humidity": 2.0}
    expected = brute_fold([(r[2], r[3]) for r in rows], list(tol.values()))
    whole = [r["accepted"] for r in dedup.flag_unchanged(df, ["location"], ["id"], tol).orderBy("id").collect()]
    assert whole == expected
    hot(20, 7)
    cut = [r["accepted"] for r in dedup.flag_unchanged(df, ["location"], ["id"], tol).orderBy("id").collect()]
    assert cut == expected


def _drift(n, spread, seed=0, odd=0.0, gaps=0.0):
    rng = np.random.default_rng(seed)
    tol = np.array(list(dedup.TOLERANCES.values()))
    x = np.cumsum(rng.normal(0, 1, (n, 6)) * tol * spread, axis=0)
    nulls = rng.random((n, 6)) < gaps
    x[rng.random(n) < odd, 0] = np.nan
    return np.where(nulls, 0, x), nulls, tol


@pytest.mark.parametrize("spread", [0.05, 0.4, 1.5, 5.0])
@pytest.mark.parametrize("odd,gaps", [(0, 0), (0, 0.02), (0.02, 0)])
def test_blocks_of_the_fold_equal_brute_force(spread, odd, gaps):
    """Runs of all kinds: drift, resets, nulls, not-a-number, with and without a row carried in."""
    for seed in range(12):
        x, nulls, tol = _drift(seed * 17, spread, seed, odd, gaps)
        anchor = None if seed % 2 else (np.zeros(6), np.zeros(6, bool))
        keep, end, _ = dedup.fold_run(x, nulls, tol, anchor)
        kept = []
        for row, null in zip(x, nulls):
            differs = anchor is None or bool(dedup.changed(row, anchor[0], tol, null, anchor[1]))
            kept.append(differs)
            anchor = (row, null) if differs else anchor
        assert keep.tolist() == kept
        assert (end is None) == (anchor is None) and (end is None or np.array_equal(end[0], anchor[0], equal_nan=True))


def test_slow_drift_is_compared_in_blocks(monkeypatch):
    """A hundred thousand slowly drifting rows take a few hundred comparisons, not one for each row."""
    x, nulls, tol = _drift(100_000, 0.02)
    nulls[:, 5] = True  # so that every comparison goes through ``changed``
    calls = []
    plain = dedup.changed
    monkeypatch.setattr(dedup, "changed", lambda *a: calls.append(len(a[0])) or plain(*a))
    keep, _, _ = dedup.fold_run(x, nulls, tol, None)
    assert len(calls) < 12 * keep.sum() + 50 < 5_000


def test_ranges_with_resets_are_folded_once(spark, hot, monkeypatch):
    """Where each range holds a reset, no range is folded again although every carried row is new."""
    rng = random.Random(5)
    rows = [("a", i, float(i // 7 * 5 + rng.random())) for i in range(200)]
    df = spark.createDataFrame(rows, "location STRING, id INT, temperature DOUBLE")
    hot(20, 7)
    labels = []
    plain = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda d, label: labels.append(label) or plain(d, label))
    cut = [r["accepted"] for r in dedup.flag_unchanged(df, ["location"], ["id"], {"temperature": 2.0}).orderBy("id").collect()]
    assert labels.count("dedup-ends") == 1 and cut == brute_fold([(r[2],) for r in rows], [2.0])


@pytest.mark.parametrize("kinds", [3, 6, 40])
def test_alert_history_over_ranges_equals_a_fold(spark, hot, kinds):
    """Few kinds of message are the hard case: what a range keeps depends on the ranges before it."""
    rng = random.Random(kinds)
    old = [(i, rng.choice([None, *"abcdefg"])) for i in range(9)]
    new = [(100 + 3 * i, f"m{rng.randrange(kinds)}") for i in range(160)] + [(90, "a"), (91, None)]
    top, kept = [m for _, m in sorted(old)][-alerts.RECENT_ALERTS:], []
    for k, m in sorted(new):
        if m not in top[-alerts.RECENT_ALERTS:]:
            top.append(m)
            kept.append(k)
    hot(20, 9)
    frames = [spark.createDataFrame(x, "pos LONG, message STRING").repartition(4) for x in (old, new)]
    got = [r["pos"] for r in alerts.alert_history(*frames, "pos").collect()]
    assert got == sorted(kept, reverse=True) + list(range(8, -1, -1))
    empty = spark.createDataFrame([], "pos LONG, message STRING")
    assert alerts.alert_history(empty, empty, "pos").collect() == []


def test_copies_of_one_row_are_spread(spark, hot):
    """Many rows that tie in the whole order still end up in several ranges, and counting stays exact."""
    hot(10)
    df = spark.range(90).select(F.lit("a").alias("location"), F.lit(1).alias("event_time"), F.lit(2).alias("id"))
    ranges = skew.cut_ranges(df, KEY, ORDER)
    assert skew.range_offsets(ranges, KEY).agg(F.max("_n")).first()[0] < 45
    split = M.temporal_split(df, KEY, ORDER)
    assert split.filter("is_train").count() == 72
