"""What the plans must look like: shuffles, pushdown, early combination, no cross joins."""

import re

from pyspark.sql import functions as F

from registry.observations import cleaned_observations
from registry.views import KEY, ORDER, observations, table
from skygrain.operators import dataset as D, features as X, monitoring as Q, normalize as N, topics as K, windows as W
from skygrain.sources.contracts import check_contract


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", text))


def test_all_history_features_share_one_shuffle_and_sort(spark, sf):
    text = plan(X.over_history(observations(spark, sf), KEY, ORDER, X.historical_columns))
    assert shuffles(text) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_batch_features_and_targets_share_one_shuffle(spark, sf):
    full = X.engineer_features_batch(cleaned_observations(spark, sf), KEY, ORDER, "event_time", targets=True)
    assert shuffles(plan(full)) == 1


def test_windows_combine_before_their_shuffle(spark, sf):
    text = plan(W.tumbling(observations(spark, sf), 3))
    assert shuffles(text) == 1 and "partial_avg" in text and "SortAggregate" not in text and "ObjectHash" not in text


def test_three_windows_from_one_scan(spark, sf):
    text = plan(W.hourly_enriched(W.rolled_up_windows(observations(spark, sf))))
    assert text.count("FileScan") == 1 and shuffles(text) == 2


def test_interval_join_is_an_equi_join(spark, sf):
    o = observations(spark, sf)
    text = plan(W.join_windows_within(*W.tumbling_from_hourly(o)))
    assert "NestedLoop" not in text and "Cartesian" not in text and "events.parquet" not in text


def test_keep_last_limits_groups_before_the_shuffle(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_shipdate", "l_orderkey")
    text = plan(D.dedup_keep_last(li, ["l_shipdate", "l_orderkey"], ["l_quantity", "l_discount"]))
    before = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before


def test_filters_and_columns_reach_the_scan(spark, sf):
    li = table(spark, sf, "lineitem")
    text = plan(li.filter(F.col("l_quantity") > 49).select("l_orderkey"))
    assert "GreaterThan(l_quantity,49.0)" in text
    scan = re.search(r"ReadSchema: (struct<[^\n]*>)", plan(Q.stability(li.withColumnRenamed("l_quantity", "main_prediction"))))
    assert scan.group(1) == "struct<l_quantity:double>"


def test_top_k_is_not_a_global_sort(spark, sf):
    e = table(spark, sf, "events").withColumn("value", F.col("props"))
    assert "TakeOrderedAndProject" in plan(K.latest_n(e, 10, ["ts"]))


def test_scaling_needs_no_join(spark, sf):
    from skygrain.operators import samples as M

    o = observations(spark, sf)
    text = plan(M.minmax_transform(o, M.minmax_fit(o, ["pressure"]), ["pressure"]))
    assert "Join" not in text


def test_interval_join_broadcasts_no_offers(spark, sf):
    text = plan(W.join_windows_within(*W.tumbling_from_hourly(observations(spark, sf))))
    assert "BroadcastExchange" not in text and text.count("SortMergeJoin") == 2


def test_training_rows_take_one_partition_a_core(spark, sf):
    from skygrain.operators import training

    rows = cleaned_observations(spark, sf).coalesce(1)
    even = training.training_rows(rows, ["humidity", "pressure"], "temperature")
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()]
    assert even.columns == ["humidity", "pressure", "temperature"]
    assert len(sizes) == cores > 1 and sum(sizes) == rows.count() and max(sizes) - min(sizes) <= cores


def test_feature_record_aggregates_over_three_rows_only(spark, sf):
    rows = observations(spark, sf).withColumns({"time_text": F.col("event_time").cast("string"), "forecast": F.array(F.lit(0.0))})
    whole = "spark.sql.debug.maxToStringFields"
    spark.conf.set(whole, "10000")
    text = plan(X.engineer_features(rows, KEY, ORDER))
    spark.conf.unset(whole)
    frames = {int(n) for n in re.findall(r"specifiedwindowframe\(RowFrame, -(\d+), currentrow", text)}
    assert frames == {2} and shuffles(text) == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_merged_frames_equal_whole_ones(spark):
    from pyspark.sql import Window

    rows = spark.range(300).select(
        F.col("id"), (F.col("id") % 7).alias("location"),
        F.when(F.col("id") % 5 != 2, F.round(F.rand(3) * 40, 2)).alias("temperature"),
        F.when((F.col("id") < 60) | (F.col("id") > 220), (F.col("id") % 90).cast("int")).alias("humidity"),
        F.lit(7.3).alias("wind_speed"))
    w = Window.partitionBy("location").orderBy("id")
    names = list(X.historical_columns(w))
    ours, whole = (
        {r["id"]: r for r in df.collect()} for df in (X.with_history(rows, w), rows.withColumns(X.historical_columns(w))))
    assert set(names) <= set(next(iter(ours.values())).asDict())
    for key, row in whole.items():
        for n in names:
            a, b = ours[key][n], row[n]
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9), (key, n, a, b)


def test_plain_messages_are_parsed_without_variants(spark):
    messages = spark.createDataFrame([("a", "{}")], "key string, value string")
    raw = plan(N.parse_raw(messages))
    assert raw.count("jsonObjectKeys") == 1
    assert len(re.findall(r"CASE WHEN [^{}]{0,80} THEN from_json\(", raw)) == 1 and raw.count("from_json(") == 2
    checked = plan(check_contract(messages, "cleaned"))
    assert len(re.findall(r"CASE WHEN NOT _ok#\d+ THEN from_json\(", checked)) == 1 and checked.count("from_json(") == 2
    converted = plan(N.normalize(N.parse_raw(messages)))
    assert "transform(_hourly#" in converted  # lists in other units
    assert not re.search(r"lambdafunction\((lambda \w+#\d+), \1, false\)", converted)  # none that is only copied
