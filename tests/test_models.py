"""Training, saving, serving, on small forests."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from registry import replays
from registry.learning import frame
from registry.observations import feature_records
from registry.views import KEY, ORDER, observations
from skygrain.operators import features as X, serving, training as TR
from skygrain.operators.samples import regression_metrics
from skygrain.plans import jobs
from skygrain.sources import models as store
from skygrain.sources.streams import as_messages, read_topic
from skygrain.sources.tables import load_performance
from skygrain.streaming.chain import folder_sink, noop_sink, prediction_batches, serve_stream

SMALL = {"numTrees": 7, "maxDepth": 4}


@pytest.fixture(scope="module")
def trained(spark):
    rows, features = frame(spark, "/root/testdata/sf0.001")
    models, scores = TR.train_all_horizons(rows, features, **SMALL)
    return rows, features, models, scores


def test_one_model_per_horizon(trained):
    rows, features, models, scores = trained
    assert sorted(models) == [1, 3, 6] and len(features) == 25
    got = {r["horizon"]: r for r in scores.collect()}
    assert set(got) == {"1h", "3h", "6h"}
    assert all(r["train_mae"] > 0 and r["test_rmse"] >= r["test_mae"] for r in got.values())


def test_missing_target_is_skipped(trained):
    rows, features, _, _ = trained
    models, _ = TR.train_all_horizons(rows.drop("target_temperature_3h"), features, numTrees=2, maxDepth=2)
    assert sorted(models) == [1, 6]
    with pytest.raises(ValueError, match="target"):
        TR.train_all_horizons(rows.select("id", *features), features)


def test_unknown_kind_is_an_error(trained):
    rows, features, _, _ = trained
    with pytest.raises(ValueError):
        TR.train(rows, features, "target_temperature_1h", "magic")


def test_boosted_trees_fit(trained):
    rows, features, _, _ = trained
    model = TR.train(rows.filter("is_train"), features, "target_temperature_1h", "boosted", maxIter=3, maxDepth=3)
    assert model.transform(rows).count() == rows.count()


def test_scores_agree_with_the_library_evaluator(trained):
    rows, _, models, _ = trained
    scored = models[1].transform(rows)
    ours = regression_metrics(scored, "target_temperature_1h", "prediction").first()
    for name in ("mae", "rmse", "r2"):
        e = RegressionEvaluator(labelCol="target_temperature_1h", predictionCol="prediction", metricName=name)
        assert abs(e.evaluate(scored) - ours[name]) < 1e-9


def test_leaf_table_reproduces_the_forest(trained):
    rows, features, models, _ = trained
    table = serving.leaf_table(models[3])
    scored = models[3].transform(rows).select("prediction", vector_to_array("leaves").alias("leaf")).collect()
    for r in scored:
        trees = table[np.arange(len(table)), np.array(r["leaf"], dtype=int)]
        assert abs(trees.mean() - r["prediction"]) < 1e-9


def test_quantiles_are_percentiles_of_the_trees(trained):
    rows, features, models, _ = trained
    table = serving.leaf_table(models[1])
    got = serving.predict(rows, models[1], features).select("id", *serving.QUANTILES).orderBy("id").collect()
    leaf = models[1].transform(rows).select("id", vector_to_array("leaves").alias("leaf")).orderBy("id").collect()
    for a, b in zip(got, leaf):
        trees = table[np.arange(len(table)), np.array(b["leaf"], dtype=int)]
        assert np.allclose([a[n] for n in serving.QUANTILES], np.percentile(trees, [10, 50, 90]))


def test_absent_features_are_zero_and_listed(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a DOUBLE, b DOUBLE")
    got = serving.fill_features(df, ["a", "b", "c"]).orderBy("a").collect()
    assert [(r["b"], r["c"], r["missing_features"]) for r in got] == [(0.0, 0.0, ["b", "c"]), (3.0, 0.0, ["c"])]


def test_streaming_names_can_be_aligned(spark):
    flat = spark.createDataFrame([(20.0, 19.0, 0.5)], "temperature DOUBLE, temp_lag_1h DOUBLE, temp_delta_1h DOUBLE")
    plain = serving.fill_features(flat, ["temperature", "lag_1h", "delta_1h"]).first()
    assert (plain["lag_1h"], plain["missing_features"]) == (0.0, ["lag_1h", "delta_1h"])
    aligned = serving.fill_features(serving.with_model_names(flat), ["temperature", "lag_1h", "delta_1h"]).first()
    assert (aligned["lag_1h"], aligned["delta_1h"], aligned["missing_features"]) == (19.0, 0.5, [])


def test_save_and_load(spark, trained, tmp_path):
    rows, features, models, _ = trained
    store.save_models(spark, {h: models[h] for h in (1, 6)}, features, str(tmp_path))
    loaded = store.load_models(spark, str(tmp_path))
    assert sorted(loaded) == [1, 6] and loaded[1][1] == features
    again = loaded[6][0].transform(rows).agg(F.sum("prediction")).first()[0]
    assert abs(again - models[6].transform(rows).agg(F.sum("prediction")).first()[0]) < 1e-6
    with pytest.raises(FileNotFoundError):
        store.load_models(spark, f"{tmp_path}/none")
    store.save_models(spark, {}, features, f"{tmp_path}/empty")
    with pytest.raises(FileNotFoundError):
        store.load_models(spark, f"{tmp_path}/empty")
    store.save_models(spark, {1: models[1]}, [], f"{tmp_path}/nocols")
    with pytest.raises(ValueError):
        store.load_models(spark, f"{tmp_path}/nocols")


def test_training_job(spark, sf, tmp_path):
    scores = jobs.train_models(observations(spark, sf), str(tmp_path), KEY, ORDER, "event_time", numTrees=3, maxDepth=3)
    assert load_performance(spark, str(tmp_path)).count() == scores.count() == 3
    assert spark.read.json(f"{tmp_path}/data_quality").count() == 25
    assert sorted(store.load_models(spark, str(tmp_path))) == [1, 3, 6]


def test_serving_stream(spark, sf, trained, tmp_path):
    _, features, models, _ = trained
    records = X.contract_features(feature_records(spark, sf)).withColumn("key", F.format_string("%06d", "id")).drop("id")
    as_messages(records).write.json(f"{tmp_path}/features")
    bad = spark.createDataFrame([("bad", "{}"), ("worse", "x")], "key STRING, value STRING")
    bad.coalesce(1).write.mode("append").json(f"{tmp_path}/features")
    bundle = {h: (models[h], features) for h in (1, 3)}
    stream = read_topic(spark, f"{tmp_path}/features")
    sink = folder_sink(f"{tmp_path}/points", f"{tmp_path}/quantiles")
    serve_stream(stream, bundle, sink, f"{tmp_path}/ck").awaitTermination(240)
    n = records.count()
    for side in ("points", "quantiles"):
        out = spark.read.json(f"{tmp_path}/{side}")
        assert out.count() == 2 * n and out.select("key").distinct().count() == n
    value = F.from_json("value", "horizon_hours INT, temperature_prediction DOUBLE, model_name STRING, event_time STRING")
    rows = spark.read.json(f"{tmp_path}/points").select(value.alias("r")).select("r.*")
    assert rows.filter("temperature_prediction IS NULL OR model_name <> 'random_forest' OR event_time IS NULL").count() == 0
    dry = serve_stream(stream, bundle, noop_sink, f"{tmp_path}/ck2")
    dry.awaitTermination(240)
    assert dry.exception() is None


def test_boosted_models_give_points_and_write_errors_fail_the_batch(spark, sf, trained, tmp_path):
    rows, features, models, _ = trained
    boosted = TR.train(rows.filter("is_train"), features, "target_temperature_1h", "boosted", maxIter=2, maxDepth=2)
    got = serving.predict(rows, boosted, features)
    assert got.count() == got.filter("prediction IS NOT NULL AND temperature_p50 IS NULL").count() == rows.count()
    records = X.contract_features(feature_records(spark, sf)).withColumn("key", F.format_string("%06d", "id")).drop("id")
    sink = folder_sink(f"{tmp_path}/points", f"{tmp_path}/quantiles")
    prediction_batches(spark, {1: (boosted, features), 3: (models[3], features)}, sink)(as_messages(records), 0)
    n = records.count()
    assert spark.read.json(f"{tmp_path}/points").count() == 2 * n and spark.read.json(f"{tmp_path}/quantiles").count() == n

    def failing(messages, contract, number):
        if contract == "predictions_quantiles":
            raise OSError("full")

    with pytest.raises(OSError):
        prediction_batches(spark, {3: (models[3], features)}, failing)(as_messages(records), 1)


def test_an_unreadable_model_is_an_error(spark, trained, tmp_path):
    _, features, models, _ = trained
    store.save_models(spark, {1: models[1]}, ["it's"], str(tmp_path))
    assert store.load_models(spark, str(tmp_path))[1][1] == ["it's"]
    stages = tmp_path / "weather_model_1h" / "metadata"
    for part in stages.iterdir():
        part.write_text("broken")
    with pytest.raises(ValueError, match="Expecting value"):
        store.load_models(spark, str(tmp_path))


def test_training_frame_works_its_input_out_once(spark):
    """The rows of each key are counted before the split, which worked the features out a second time."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(60).selectExpr(
        "id % 3 AS location", "id AS event_time", "id", "id * 0.5D AS temperature", "id * 1.5D AS target_temperature_1h")
    done, _ = TR.training_frame(rows.mapInArrow(counted, rows.schema), KEY, ORDER)
    assert done.count() == 60 and done.filter("is_train").count() == 48
    assert read.value == 60


def test_the_round_trip_notices_other_predictions_and_other_scores(spark, monkeypatch):
    """Forests of the same shape that predict five degrees more, and a score other than the test error."""
    rows = spark.range(120).selectExpr(
        "id % 2 AS location", "id AS event_time", "id", "id * 0.5D AS temperature", "id % 7 + id * 0.25D AS target_temperature_1h",
        "id % 5 + id * 0.5D AS target_temperature_3h", "id % 3 + id * 1.0D AS target_temperature_6h")
    frame_, names = TR.training_frame(rows, KEY, ORDER)
    models, scores = TR.train_all_horizons(frame_, names, numTrees=3, maxDepth=3)
    warmer = frame_.withColumns({c: F.col(c) + 5 for c in frame_.columns if c.startswith("target")})
    others, _ = TR.train_all_horizons(warmer, names, numTrees=3, maxDepth=3)
    monkeypatch.setattr(replays, "small_forests", lambda *_: ((models, scores), names, rows, frame_))
    facts = lambda: {tuple(r) for r in replays.metrics_round_trip(spark, "").collect()}
    assert facts() == {(f"{h}h", True, True, 3) for h in models}
    load_performance_ = replays.load_performance
    monkeypatch.setattr(replays, "load_performance", lambda *a: load_performance_(*a).withColumn("train_r2", F.col("train_r2") / 2))
    assert {f[1:3] for f in facts()} == {(False, True)}
    monkeypatch.setattr(replays, "load_performance", load_performance_)
    load = replays.load_models
    monkeypatch.setattr(replays, "load_models", lambda *a: {h: (others[h], n) for h, (_, n) in load(*a).items()})
    assert {h: m.stages[-1].totalNumNodes for h, m in others.items()} == {h: m.stages[-1].totalNumNodes for h, m in models.items()}
    assert {f[1:3] for f in facts()} == {(True, False)}
