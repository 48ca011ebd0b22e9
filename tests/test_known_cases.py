"""Small cases with results known by hand: records, contracts, dedup, features, targets, metrics."""

import json
import math

import pytest
from pyspark.sql import functions as F

from skygrain.functions import series as S, values as V
from skygrain.operators import alerts as A, dataset as D, dedup, features as X, filters, monitoring as Q, normalize as N
from skygrain.operators import samples as M, topics as K
from skygrain.plans.prefix import exact_quantiles
from skygrain.sources.contracts import conforms, validate_contract
from tests.conftest import same

NOON = "2023-10-02T12:00:00+00:00"


def raw_sample():
    return {
        "latitude": -41.29, "longitude": 174.78, "elevation": 12.0,
        "current": {"time": NOON, "temperature_2m": 8.4, "relative_humidity_2m": 71, "precipitation": 0.2,
                    "wind_speed_10m": 23.0, "wind_direction_10m": 310, "cloud_cover": 85, "pressure_msl": 1002.5},
        "current_units": {"temperature_2m": "°C", "relative_humidity_2m": "%", "precipitation": "mm",
                          "wind_speed_10m": "km/h", "wind_direction_10m": "°", "cloud_cover": "%", "pressure_msl": "hPa"},
        "hourly": {"time": [NOON] * 3, "temperature_2m": [8.4, 8.1, 9.3], "relative_humidity_2m": [71, 74, 69],
                   "precipitation_probability": [40, 55, 20], "precipitation": [0.2, 0.6, 0.0],
                   "wind_speed_10m": [23.0, 24.5, 19.0], "cloud_cover": [85, 90, 60], "pressure_msl": [1002.5, 1001.9, 1003.2]},
        "metadata": {"source": "mast", "location": "-41.29,174.78", "timestamp": NOON, "fetch_time": NOON},
    }


def feature_sample(**historical):
    h = {
        "temp_rolling_3h": {"mean_3h": -4.0, "std_3h": 0.8, "min_3h": -5.1, "max_3h": -3.2},
        "temp_rolling_6h": {"mean_6h": -4.6, "std_6h": 1.1, "min_6h": -6.3, "max_6h": -3.2},
        "temp_deltas": {"delta_1h": 0.5, "delta_3h": 1.9, "delta_6h": 3.1, "delta_12h": None},
        "temp_roc_3h": 0.63, "temp_roc_6h": 0.52,
        "temp_lags": {"lag_1h": -3.7, "lag_2h": -4.1, "lag_3h": -5.1, "lag_6h": -6.3, "lag_12h": None},
        "temp_volatility_6h": 1.1,
    }
    return {
        "location": {"latitude": 61.5, "longitude": 23.75, "elevation": 98.0}, "timestamp": "2022-02-07T18:00:00Z",
        "base_features": {"temp_current": -3.2, "humidity_current": 88.0, "wind_current": 7.5, "pressure_current": 994.0,
                          "cloud_cover_current": 100.0, "precipitation_current": 0.3},
        "historical_features": {**h, **historical},
        "cyclical_features": {"hour_sin": -1.0, "hour_cos": 0.0, "day_sin": 0.0, "day_cos": 1.0, "is_day": 0, "is_weekend": 0},
        "target_labels": {"temp_target_1h": -3.0, "temp_target_3h": -2.4, "temp_target_6h": -2.8},
        "metadata": {"feature_engineered_at": "2022-02-07T18:00:40Z", "history_size": 12, "samples_accumulated": 12, "feature_count": 31},
    }


def messages(spark, *values):
    rows = [(str(i), v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key STRING, value STRING")


def accepted(spark, contract, *values):
    return [int(r["key"]) for r in validate_contract(messages(spark, *values), contract)[0].orderBy("key").collect()]


# Contracts ----------------------------------------------------------------------------------------------------


def cleaned_sample():
    raw = raw_sample()
    current = {**raw["current"], "units": {"temperature": "°C", "humidity": "%", "precipitation": "mm", "wind_speed": "km/h", "pressure": "hPa"}}
    return {
        "location": {"latitude": 1.0, "longitude": 2.0, "elevation": 10.0}, "event_time": NOON, "current": current,
        "hourly": raw["hourly"],
        "metadata": {"source": "test", "location": "1.0,2.0", "timestamp": NOON, "normalized_at": NOON,
                     "data_quality": {"completeness": 1.0, "has_anomalies": False, "validation_errors": []}},
    }


POINT = {"event_time": NOON, "horizon_hours": 1, "temperature_prediction": 20.5, "model_name": "m", "model_version": "v1", "created_at": NOON}


@pytest.mark.parametrize("contract,sample", [("raw", raw_sample()), ("cleaned", cleaned_sample()), ("features", feature_sample()), ("predictions", POINT)])
def test_contracts_accept_samples(spark, contract, sample):
    assert accepted(spark, contract, sample) == [0]


def changed(sample, **changes):
    out = json.loads(json.dumps(sample))
    for path, v in changes.items():
        *parents, leaf = path.split("__")
        at = out
        for p in parents:
            at = at[p]
        if v is KeyError:
            del at[leaf]
        else:
            at[leaf] = v
    return out


def test_contract_edges(spark):
    r = raw_sample()
    cases = [
        (changed(r, extra=1), True),
        (changed(r, elevation=KeyError), True),
        (changed(r, elevation=35), True),
        (changed(r, hourly__pressure_msl=KeyError), True),
        (changed(r, hourly__pressure_msl=None), False),
        (changed(r, hourly__pressure_msl=["1"]), False),
        (changed(r, current__relative_humidity_2m=60.5), False),
        (changed(r, current__relative_humidity_2m=3_000_000_000), False),
        (changed(r, current__temperature_2m=None), True),
        (changed(r, current__time=None), False),
        (changed(r, current__time=12), False),
        (changed(r, hourly__time=[NOON, 5]), False),
        (changed(r, hourly__time=[NOON, None]), False),
        (changed(r, hourly__temperature_2m=[1.0, None]), True),
        (changed(r, hourly__temperature_2m="none"), False),
        (changed(r, latitude="48"), False),
        (changed(r, latitude=True), False),
        (changed(r, metadata=KeyError), False),
        (changed(r, current_units__temperature_2m=KeyError), True),
        ("{broken", False),
        ("[1]", False),
        ("", False),
    ]
    ok = accepted(spark, "raw", *[c for c, _ in cases])
    assert sorted(ok) == [i for i, (_, good) in enumerate(cases) if good]


def test_defaults_are_filled(spark):
    r = changed(raw_sample(), hourly__pressure_msl=KeyError, current_units__precipitation=KeyError)
    row = validate_contract(messages(spark, r), "raw")[0].first()["record"]
    assert row["hourly"]["pressure_msl"] == [] and row["current_units"]["precipitation"] == "mm"


# Chain --------------------------------------------------------------------------------------------------------


def test_raw_to_features(spark):
    raw = N.parse_raw(messages(spark, raw_sample()))
    cleaned = N.normalize(raw)
    c = cleaned.first()
    assert c["event_time"] == NOON and c["metadata"]["data_quality"]["completeness"] == 1.0
    flat = X.observations_of(cleaned).withColumns({"id": F.lit(1), "event_time": S.wall_clock(F.col("time_text")), "place": F.lit("x")})
    features = X.contract_features(X.engineer_features(flat, ["place"], ["event_time", "id"]))
    assert conforms(features, "features").count() == 1
    f = features.first()
    assert (f["cyclical_features"]["is_day"], f["cyclical_features"]["is_weekend"]) == (1, 0)
    assert same(f["cyclical_features"]["hour_cos"], -1.0) and same(f["cyclical_features"]["day_sin"], 0.0)
    assert f["target_labels"].asDict() == {"temp_target_1h": 8.1, "temp_target_3h": None, "temp_target_6h": None}
    h = f["historical_features"]
    assert h["temp_rolling_3h"]["mean_3h"] is None and h["temp_deltas"]["delta_1h"] is None and h["temp_volatility_6h"] is None
    assert f["metadata"]["samples_accumulated"] == 1 and f["metadata"]["feature_count"] == 12


def test_numbers_as_text_and_fractions_are_read(spark):
    r = changed(raw_sample(), current__temperature_2m="8.4", current__relative_humidity_2m="71", current__cloud_cover=85.9,
                current__wind_direction_10m="310.5", current__pressure_msl="high", hourly__temperature_2m=["8.4", 8, None, "x"],
                hourly__cloud_cover=["90", 60.7, "60.7"])
    row = N.normalize(N.parse_raw(messages(spark, r))).first()
    c, h = row["current"], row["hourly"]
    assert (c["temperature_2m"], c["relative_humidity_2m"], c["cloud_cover"]) == (8.4, 71, 85)
    assert c["wind_direction_10m"] is None and c["pressure_msl"] is None
    assert h["temperature_2m"] == [8.4, 8.0, None, None] and h["cloud_cover"] == [90, 60, None]


def test_texts_that_look_like_numbers_stay_valid(spark):
    from skygrain.sources.contracts import check_contract

    odd = [("sensor", None), ("12", None), ("true", None), ("[x", None), ('"q', None), ("a\n-5e3", None), ("NaN", None),
           (12, "wrong type"), (-5e3, "wrong type"), (True, "wrong type"), (["x"], "wrong type"), ({"a": 1}, "wrong type"),
           (math.nan, "wrong type"), (math.inf, "wrong type"), (None, "missing field"), (KeyError, "missing field")]
    rows = messages(spark, *[changed(raw_sample(), metadata__source=v) for v, _ in odd])
    got = {int(r["key"]): r for r in check_contract(rows, "raw").collect()}
    assert [got[i]["reject_reason"] for i in range(len(odd))] == [reason for _, reason in odd]
    assert [got[i]["record"]["metadata"]["source"] for i in range(7)] == [v for v, _ in odd[:7]]
    lists = [(["2024-01-01T00:00:00"], None), (["2024"], None), ([2024], "wrong type"), ([None], "wrong type"), ([], None)]
    rows = messages(spark, *[changed(raw_sample(), hourly__time=v) for v, _ in lists])
    got = {int(r["key"]): r["reject_reason"] for r in check_contract(rows, "raw").collect()}
    assert [got[i] for i in range(len(lists))] == [reason for _, reason in lists]


def test_coordinates_must_be_numbers(spark):
    assert N.normalize(N.parse_raw(messages(spark, changed(raw_sample(), latitude="-41.29")))).count() == 0


def test_required_keys(spark):
    null_kept = changed(raw_sample(), current_units=None)
    rows = messages(spark, raw_sample(), null_kept, changed(raw_sample(), current_units=KeyError), "no json")
    got = rows.orderBy("key").select(N.has_required_keys(F.col("value"))).collect()
    assert [r[0] for r in got] == [True, True, False, False]


def test_wall_clock_hour(spark):
    df = spark.createDataFrame([("2024-01-01T12:00:00+02:00",), ("nonsense",)], "t STRING")
    assert [r[0] for r in df.select(F.hour(S.wall_clock(F.col("t")))).collect()] == [12, None]


def test_unreadable_time_still_feeds_history(spark):
    rows = [(i, i, t, float(i)) for i, t in enumerate(["2024-01-01T00:00:00", "bad", "2024-01-01T02:00:00"])]
    df = spark.createDataFrame(rows, "id INT, event_time INT, time_text STRING, temperature DOUBLE").withColumns(
        {c: F.lit(1.0) for c in ("latitude", "longitude", "elevation", "humidity", "wind_speed", "pressure", "cloud_cover", "precipitation")}
    ).withColumn("forecast", F.array(F.lit(1.0)))
    out = X.engineer_features(df, ["latitude"], ["event_time", "id"]).orderBy("timestamp").collect()
    assert len(out) == 2 and out[1]["historical_features"]["temp_lags"]["lag_1h"] == 1.0
    assert out[1]["historical_features"]["temp_rolling_3h"]["mean_3h"] == 1.0


@pytest.mark.parametrize("value,unit,convert,expected", [
    (300.0, "K", V.convert_temperature, 26.85), (86.0, "°F", V.convert_temperature, 30.0), (20.0, "?", V.convert_temperature, 20.0),
    (10.0, "m/s", V.convert_speed, 36.0), (10.0, "mph", V.convert_speed, 16.0934), (10.0, "kmh", V.convert_speed, 10.0),
    (101300.0, "Pa", V.convert_pressure, 1013.0), (101.3, "kPa", V.convert_pressure, 1013.0), (1013.0, "hPa", V.convert_pressure, 1013.0),
])
def test_units(spark, value, unit, convert, expected):
    assert same(spark.range(1).select(convert(F.lit(value), F.lit(unit))).first()[0], expected)


def test_casts(spark):
    texts = spark.createDataFrame([("60",), (" 60 ",), ("60.5",), ("abc",), (None,)], "t STRING")
    assert [r[0] for r in texts.select(V.to_int(F.col("t"))).collect()] == [60, 60, None, None, None]
    numbers = spark.createDataFrame([(60.7,), (-60.7,), (math.nan,)], "x DOUBLE")
    assert [r[0] for r in numbers.select(V.to_int(F.col("x"))).collect()] == [60, -60, None]


# Dedup --------------------------------------------------------------------------------------------------------


def flags(spark, rows, columns, tol=None):
    df = spark.createDataFrame([("p", i, *r) for i, r in enumerate(rows)], f"place STRING, id INT, {columns}")
    return [r["accepted"] for r in dedup.flag_unchanged(df, ["place"], ["id"], tol).orderBy("id").collect()]


def test_anchor_moves_only_on_a_change(spark):
    assert flags(spark, [(0.0,), (0.008,), (0.016,)], "temperature DOUBLE") == [True, False, True]
    assert flags(spark, [(1.0,), (1.005,), (1.02,), (1.03,)], "temperature DOUBLE") == [True, False, True, True]


def test_nulls_in_dedup(spark):
    rows = [(None, None), (None, 5.0), (5.0, 5.0), (5.0, 5.0), (None, 5.0)]
    assert flags(spark, rows, "temperature DOUBLE, humidity DOUBLE") == [True, True, True, False, True]


def test_real_changes_are_kept(spark):
    rows = [(20.0, 60, 10.0), (20.0, 60, 10.0), (20.0, 65, 10.0), (20.0, 65, 12.0), (20.0, 65, 12.0)]
    got = flags(spark, rows, "temperature DOUBLE, humidity INT, wind_speed DOUBLE")
    assert got == [True, False, True, True, False]


def test_not_a_number_takes_the_slow_path(spark):
    assert flags(spark, [(math.nan,), (5.0,), (9.0,), (9.0,)], "temperature DOUBLE") == [True, False, False, False]


# Rolling ------------------------------------------------------------------------------------------------------


def over(spark, values, columns):
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate(values)], "place STRING, id INT, temperature DOUBLE")
    return X.over_history(df, ["place"], ["id"], columns).orderBy("id").collect()


def test_rolling_skips_nulls_but_counts_rows(spark):
    rows = over(spark, [1.0, 2.0, None, 5.0], lambda w: S.rolling_stats(F.col("temperature"), 3, w))
    assert [(r["mean_3h"], r["std_3h"]) for r in rows] == [(None, None), (None, None), (1.5, 0.5), (3.5, 1.5)]


def test_rolling_mean_from_the_first_row(spark):
    rows = over(spark, [1.0, 2.0, 3.0], lambda w: {"m": S.rolling_mean(F.col("temperature"), 3, w)})
    assert [r["m"] for r in rows] == [1.0, 1.5, 2.0]


def test_time_windows_are_an_option(spark):
    rows = [("p", "2024-01-01 00:00:00", 1.0), ("p", "2024-01-01 01:00:00", 3.0), ("p", "2024-01-01 09:00:00", 5.0)]
    df = spark.createDataFrame(rows, "place STRING, t STRING, temperature DOUBLE").withColumn("t", F.col("t").cast("timestamp"))
    got = X.with_time_windows(df, ["place"], "t", [3]).orderBy("t").collect()
    assert [r["temp_mean_3h"] for r in got] == [1.0, 2.0, 5.0]
    undated = df.unionByName(df.limit(1).withColumn("t", F.lit(None).cast("timestamp")))
    rows = X.with_time_windows(undated, ["place"], "t", [3]).orderBy("t").collect()
    assert [r["temp_mean_3h"] for r in rows] == [None, 1.0, 2.0, 5.0]


def test_time_windows_over_buckets_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    seconds = sorted(rng.sample(range(6 * 86400), 150))
    rows = [("p", s, float(i)) for i, s in enumerate(seconds)]
    df = spark.createDataFrame(rows, "place STRING, s LONG, temperature DOUBLE").withColumn("t", F.timestamp_seconds("s"))
    got = X.with_time_windows(df, ["place"], "t", [3, 6]).orderBy("s").collect()
    assert len(got) == len(rows)
    for r in got:
        for h in (3, 6):
            near = [v for _, s, v in rows if r["s"] - h * 3600 < s <= r["s"]]
            assert same(r[f"temp_mean_{h}h"], sum(near) / len(near)) and r[f"temp_min_{h}h"] == near[0]


# Datasets -----------------------------------------------------------------------------------------------------


def test_target_shift(spark):
    rows = [("p", i, t) for i, t in enumerate([10.0, 11.0, 12.0, 13.0])]
    df = spark.createDataFrame(rows, "place STRING, timestamp INT, temperature DOUBLE")
    got = D.add_target(df, 2, ["place"], ["timestamp"]).orderBy("timestamp").collect()
    assert [r["target_temperature_horizon_2h"] for r in got] == [12.0, 13.0, None, None]
    with pytest.raises(ValueError):
        D.add_target(df.drop("temperature"), 2, ["place"], ["timestamp"])


def flat_of(spark, sample):
    return D.build_dataset_frame(validate_contract(messages(spark, sample), "features")[0].select("record.*")).first()


def test_flatten(spark):
    row = flat_of(spark, feature_sample())
    want = {"temperature": -3.2, "humidity": 88.0, "wind_speed": 7.5, "temp_mean_3h": -4.0, "temp_delta_3h": 1.9,
            "temp_lag_1h": -3.7, "hour_sin": -1.0, "is_day": 0, "target_temp_6h": -2.8}
    assert {k: row[k] for k in want} == want and len(row) == 39


def test_flatten_null_groups(spark):
    lags = {"lag_1h": -3.7, "lag_2h": None, "lag_3h": -5.1, "lag_6h": None, "lag_12h": None}
    row = flat_of(spark, feature_sample(temp_rolling_6h=None, temp_roc_6h=None, temp_lags=lags, temp_volatility_6h=None))
    assert row["temp_mean_3h"] == -4.0 and row["temp_mean_6h"] is None and row["temp_volatility_6h"] is None
    assert row["temp_lag_3h"] == -5.1 and row["temp_lag_2h"] is None


def test_rounding_is_an_option_and_last_wins(spark):
    cols = "timestamp INT, temperature DOUBLE, humidity DOUBLE"
    a = spark.createDataFrame([(1, 12.001, 50.0), (9, 7.0, 1.0)], cols)
    b = spark.createDataFrame([(2, 12.004, 50.0), (5, 7.0, 1.0)], cols)
    exact = D.merge_datasets(a, b).collect()
    assert [(r["timestamp"], r["temperature"]) for r in exact] == [(1, 12.001), (2, 12.004), (5, 7.0)]
    assert [r["timestamp"] for r in D.merge_datasets(a, b, rounding=D.ROUNDING).collect()] == [2, 5]


def test_merge_without_existing_keeps_all(spark):
    new = spark.createDataFrame([(1, 5.0), (2, 5.0)], "timestamp INT, temperature DOUBLE")
    assert D.merge_datasets(None, new).count() == 2
    assert D.merge_datasets(new, new.filter("false")).count() == 2


# Samples ------------------------------------------------------------------------------------------------------


def series_frame(spark, n):
    return spark.createDataFrame([("p", i, float(i)) for i in range(n)], "place STRING, id INT, temperature DOUBLE")


def test_sequences(spark):
    df = series_frame(spark, 10)
    one = M.sequences(df, ["place"], ["id"], ["temperature"], "temperature", 3, [2]).orderBy("sequence_no").collect()
    assert len(one) == 6 and one[0]["y"] == [4.0] and [x["temperature"] for x in one[0]["x"]] == [0.0, 1.0, 2.0]
    multi = M.sequences(df, ["place"], ["id"], ["temperature"], "temperature", 3, [1, 3, 6]).orderBy("sequence_no").collect()
    assert [r["y"] for r in multi] == [[3.0, 5.0, 8.0], [4.0, 6.0, 9.0]]
    assert [r["is_train"] for r in M.sequence_split(spark.createDataFrame(multi)).orderBy("sequence_no").collect()] == [True, False]
    with pytest.raises(ValueError):
        M.require_sequences(M.sequences(df, ["place"], ["id"], ["temperature"], "temperature", 9, [6]))


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a DOUBLE, b DOUBLE")
    fit = M.minmax_fit(df, ["a", "b"])
    scaled = M.minmax_transform(df, fit, ["a", "b"])
    assert sorted((r["a"], r["b"]) for r in scaled.collect()) == [(0.0, 0.0), (0.0, 1.0)]
    back = M.minmax_inverse(scaled, fit, {"a": "a", "b": "b"})
    assert sorted((r["a"], r["b"]) for r in back.collect()) == [(5.0, 1.0), (5.0, 3.0)]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 3.0)], "y DOUBLE, p DOUBLE")
    r = M.regression_metrics(df, "y", "p").first()
    assert same(r["mae"], 2 / 3) and same(r["rmse"], math.sqrt(2 / 3)) and same(r["r2"], 1 - 2 / (14 / 3))


# Monitoring ---------------------------------------------------------------------------------------------------


def numbers(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v DOUBLE")


def test_ks(spark):
    d = Q.ks_drift(numbers(spark, range(200)), numbers(spark, [i + 80 for i in range(200)]), "v").first()
    assert same(d["ks_score"], 0.4) and d["p_value"] < 1e-10
    even = Q.ks_drift(numbers(spark, range(50)), numbers(spark, range(50)), "v").first()
    assert even["ks_score"] == 0.0 and even["p_value"] == 1.0


def test_ks_p_value_at_a_known_point(spark):
    """The limit law gives 0.05 near x = 1.3581."""
    x = 1.3581
    row = spark.createDataFrame([(x / math.sqrt(500.0), 1000, 1000)], "ks_score DOUBLE, current_rows LONG, reference_rows LONG")
    assert abs(row.select(Q.ks_p_value()).first()[0] - 0.05) < 1e-4


def test_constant_sample_has_no_outliers(spark):
    r = Q.zscore_outliers(numbers(spark, [5] * 9), "v").first()
    assert (r["outlier_count"], r["outlier_pct"]) == (0, 0.0)


def test_quantiles(spark):
    r = exact_quantiles(numbers(spark, [10, 3, 2, 1, None]), "v", {"a": 0.1, "b": 0.5, "c": 0.9}).first()
    assert same([r["a"], r["b"], r["c"]], [1.3, 2.5, 7.9])


def test_quantiles_of_many_groups_and_ranges(spark, hot):
    import numpy as np

    hot(5, 7)
    rng = np.random.default_rng(3)
    data = [(g, float(np.round(x, 1))) for g in range(3) for x in rng.normal(g, 3, 40 + 11 * g)]
    df = spark.createDataFrame(data, "g INT, v DOUBLE")
    got = exact_quantiles(df, "v", {"q1": 0.25, "q9": 0.9}, ["g"]).orderBy("g").collect()
    for r in got:
        mine = [v for g, v in data if g == r["g"]]
        assert same([r["q1"], r["q9"]], list(np.percentile(mine, [25, 90])))


def test_empty_confidence_interval_is_zero(spark):
    r = Q.confidence_intervals(numbers(spark, []).withColumnRenamed("v", "main_prediction")).first()
    assert (r["p10"], r["p50"], r["p90"]) == (0.0, 0.0, 0.0)


def test_stability_of_one_row(spark):
    one = numbers(spark, [3]).withColumnRenamed("v", "main_prediction")
    assert Q.stability(one).first()[0] == 0.0


def test_prediction_columns(spark):
    assert Q.main_prediction(numbers(spark, [1])).first()["main_prediction"] is None


def test_bins_of_empty_minutes(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:10",), ("2024-01-01 00:02:50",), ("2024-01-01 00:02:51",)], "t STRING")
    got = Q.per_minute_counts(df.withColumn("created_at", F.col("t").cast("timestamp"))).orderBy("minute").collect()
    assert [r["message_count"] for r in got] == [1, 0, 2]


def test_a_stray_time_does_not_stretch_the_minutes(spark):
    df = spark.createDataFrame([("1970-01-01 00:00:00",), ("2024-01-01 00:00:10",), ("2024-01-01 00:02:50",)], "t STRING")
    times = df.withColumn("created_at", F.col("t").cast("timestamp"))
    got = Q.per_minute_counts(times, since=F.lit("2024-01-01").cast("timestamp")).orderBy("minute").collect()
    assert [r["message_count"] for r in got] == [1, 0, 1]
    assert Q.per_minute_counts(times, until=F.lit("1960-01-01").cast("timestamp")).count() == 0


def test_drift_of_several_features_at_once(spark):
    now = spark.createDataFrame([(1.0, None), (2.0, None), (5.0, None)], "a DOUBLE, b DOUBLE")
    then = spark.createDataFrame([(1.0, 1.0), (1.5, 2.0), (None, 3.0)], "a DOUBLE, b DOUBLE")
    got = {r["feature"]: r for r in Q.ks_drifts(now, then, ["a", "b"]).collect()}
    assert math.isclose(got["a"]["ks_score"], 2 / 3) and (got["a"]["current_rows"], got["a"]["reference_rows"]) == (3, 2)
    assert got["b"]["ks_score"] is None and got["b"]["p_value"] is None and got["b"]["reference_rows"] == 3
    assert Q.ks_drift(now.limit(0), then.limit(0), "a").first()["ks_score"] is None


def test_an_unreadable_time_does_not_stop_a_dataset(spark):
    from skygrain.sources.tables import explode_hourly

    hourly = "struct<time:array<string>,temperature_2m:array<double>,relative_humidity_2m:array<int>," \
        "wind_speed_10m:array<double>,pressure_msl:array<double>,cloud_cover:array<int>,precipitation:array<double>>"
    df = spark.createDataFrame([((["2024-01-01T00:00", "soon"], [1.0, 2.0], None, None, None, None, None),)], f"hourly {hourly}")
    rows = sorted(explode_hourly(df).collect(), key=lambda x: x["temperature"])
    assert rows[0]["timestamp"] is not None and rows[1]["timestamp"] is None


def test_removed_rows(spark):
    df = spark.createDataFrame([(20.0, 50), (99.0, 50), (None, 50), (20.0, 101)], "temperature DOUBLE, humidity INT")
    assert filters.physical_range_filter(df).count() == 1
    assert filters.removed_rows(df).first().asDict() == {"rows_before": 4, "rows_after": 1, "rows_removed": 3}


def test_unknown_topic_and_alert_texts(spark):
    rows = [("a", 0, o) for o in (10, 1600)] + [("b", 0, 0), ("b", 0, 599)]
    df = spark.createDataFrame(rows, "topic STRING, partition INT, offset LONG")
    backlog = K.topic_backlog(df, ["a", "b", "c"])
    got = {r["topic"]: (r["total_messages"], r["error"]) for r in backlog.collect()}
    assert got == {"a": (1591, None), "b": (600, None), "c": (None, "Topic not found")}
    drift = spark.createDataFrame([("t", 0.456), ("h", 0.3)], "feature STRING, ks_score DOUBLE")
    done = spark.createDataFrame([("t", 97.96), ("h", 98.0)], "feature STRING, completeness_pct DOUBLE")
    std = spark.createDataFrame([(5.5,)], "stability DOUBLE")
    alerts = A.check_alerts(backlog, drift, done, std).orderBy("rule_no", "message").collect()
    assert [(r["level"], r["message"]) for r in alerts] == [
        ("CRITICAL", "High Kafka lag on a: 1591 messages"), ("WARNING", "Increased Kafka lag on b: 600 messages"),
        ("CRITICAL", "Feature drift detected: t (score: 0.46)"), ("INFO", "Low feature completeness: t (98.0%)"),
        ("WARNING", "High prediction instability detected (std: 5.50)")]


def test_alert_history_skips_recent_repeats(spark):
    old = spark.createDataFrame([(i, m) for i, m in enumerate("zabcde")], "pos LONG, message STRING")
    new = spark.createDataFrame([(10, "x"), (11, "a"), (12, "e"), (13, "x")], "pos LONG, message STRING")
    got = [(r["pos"], r["message"]) for r in A.alert_history(old, new, "pos").collect()]
    assert got == [(11, "a"), (10, "x"), (5, "e"), (4, "d"), (3, "c"), (2, "b"), (1, "a"), (0, "z")]


def test_alert_history_is_whole_and_shown_in_part(spark):
    old = spark.range(40).select(F.col("id").alias("pos"), F.concat(F.lit("m"), F.col("id")).alias("message"))
    whole = A.alert_history(old, spark.createDataFrame([(50, "new")], "pos LONG, message STRING"), "pos")
    assert [r["pos"] for r in whole.collect()] == [50, *range(39, -1, -1)]
    assert [r["pos"] for r in A.shown(whole).collect()] == [50, *range(39, 25, -1)]
