"""Queries over feature records and datasets: dedup, flatten, merge, targets, splits, scaling, sequences, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registry.book import query
from registry.observations import (
    B_ALL, B_TARGETS, BASE_SQL, CYCLE_SQL, DELTAS, FLAGS_SQL, LAGS, RATES, ROLL, TARGET_SQL, VOLATILITY,
    cleaned_observations, feature_records, with_clean, with_obs,
)
from registry.views import KEY, ORDER, observations, r, rounded, table
from skygrain.operators import dataset as D, dedup, features as X, samples as M
from skygrain.sources.schemas import MODEL_FEATURES

# Unchanged readings: line items as a supplier's slowly changing quantity.
SUPPLIER, SHIPPED = ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
QUANTITY_TOLERANCE = {"l_quantity": 2.0}
FOLD = """WITH RECURSIVE s AS (
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity AS q, row_number() OVER (PARTITION BY l_suppkey
      ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem),
  f AS (
    SELECT *, q AS anchor, true AS accepted FROM s WHERE k = 1
    UNION ALL
    SELECT s.*, CASE WHEN abs(s.q - f.anchor) > 2.0 THEN s.q ELSE f.anchor END, abs(s.q - f.anchor) > 2.0
    FROM f JOIN s ON s.l_suppkey = f.l_suppkey AND s.k = f.k + 1)"""


def flagged_items(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*SUPPLIER, *SHIPPED, "l_quantity")
    return dedup.flag_unchanged(items, SUPPLIER, SHIPPED, QUANTITY_TOLERANCE)


@query("dedup_unchanged", f"""{FOLD} SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, q AS l_quantity
  FROM f WHERE accepted""")
def dedup_unchanged(spark, sf_dir):
    return flagged_items(spark, sf_dir).filter(dedup.ACCEPTED).drop(dedup.ACCEPTED, "l_shipdate")


@query("dedup_counts", f"""{FOLD} SELECT count(*) FILTER (accepted) AS processed, count(*) FILTER (NOT accepted) AS duplicates FROM f""")
def dedup_counts(spark, sf_dir):
    return dedup.dedup_counts(flagged_items(spark, sf_dir))


# Flat datasets ------------------------------------------------------------------------------------------------


def _only(cols, *names):
    return [c for c in cols if c[1] in names]


RENAMED = [(dict((n, e) for e, n in BASE_SQL)[leaf], name) for name, leaf in D.FLAT_BASE.items()]
SHORT_ROLL = _only(ROLL["temp"], *[f"temp_{s}_{n}h" for s in ("mean", "std", "min", "max") for n in (3, 6)])
FLAT_SQL = (
    [("latitude", "latitude"), ("longitude", "longitude"), ("elevation", "elevation")] + RENAMED + CYCLE_SQL + SHORT_ROLL
    + [c for c in DELTAS if c[1].startswith("temp_")] + [c for c in RATES if c[1].startswith("temp_")]
    + [c for c in LAGS if c[1].startswith("temp_")] + VOLATILITY
    + [(e, n.replace("temp_target_", "target_temp_")) for e, n in TARGET_SQL]
)
FLAT_OUT = ", ".join(r(e, n) for e, n in FLAT_SQL)


@query("flatten_features", with_obs(f"""SELECT id, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS timestamp, {FLAT_OUT}, {FLAGS_SQL} FROM obs"""))
def flatten_features(spark, sf_dir):
    return rounded(D.flatten_features(feature_records(spark, sf_dir), ["id"]))


@query("dataset_frame", with_obs(f"""SELECT id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS timestamp, {FLAT_OUT}, {FLAGS_SQL} FROM obs"""))
def dataset_frame(spark, sf_dir):
    frame = D.build_dataset_frame(feature_records(spark, sf_dir), ["id"])
    return rounded(frame.withColumn("timestamp", F.col("timestamp").cast("string")))


@query("add_target", with_obs(f"""SELECT id, location, {r('lead(temperature, 3) OVER (PARTITION BY location ORDER BY event_time, id)',
    'target_temperature_horizon_3h')} FROM obs"""))
def add_target(spark, sf_dir):
    o = D.add_target(observations(spark, sf_dir), 3, KEY, ORDER)
    return rounded(o.select("id", "location", "target_temperature_horizon_3h"))


@query("target_validity", with_obs("""SELECT count(t) AS valid_targets, count(*) - count(t) AS null_targets FROM (
    SELECT lead(temperature, 3) OVER (PARTITION BY location ORDER BY event_time, id) AS t FROM obs)"""))
def target_validity(spark, sf_dir):
    o = D.add_target(observations(spark, sf_dir), 3, KEY, ORDER)
    return D.target_validity(o, "target_temperature_horizon_3h")


# Line items as weather rows: shipped in 1999 or before = existing dataset, later = new rows.
WX = """wx AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS tie, l_shipdate AS ts, l_quantity AS temperature,
    l_discount AS humidity, l_tax AS wind_speed, CAST(year(l_shipdate) >= 2000 AS INTEGER) AS is_new FROM lineitem)"""
WX_COLS = "l_orderkey, l_linenumber, l_partkey, tie, ts, temperature, humidity, wind_speed"
TIE = ["l_orderkey", "l_linenumber", "l_partkey", "tie"]
TIE_DESC = ", ".join(f"{c} DESC" for c in TIE)


def weather_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    wx = li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("tie"),
                   F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("temperature"),
                   F.col("l_discount").alias("humidity"), F.col("l_tax").alias("wind_speed"))
    late = F.col("ts") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return wx.filter(~late), wx.filter(late)


@query("union_datasets", f"""WITH {WX} SELECT {WX_COLS}, NULL::DOUBLE AS pressure, is_new FROM wx WHERE is_new = 1
  UNION ALL BY NAME SELECT {WX_COLS}, temperature + 1000 AS pressure, is_new FROM wx WHERE is_new = 0""")
def union_datasets(spark, sf_dir):
    old, new = weather_rows(spark, sf_dir)
    both = D.union_datasets(old.withColumn("pressure", F.col("temperature") + 1000), new)
    return both.withColumnRenamed(D.SOURCE, "is_new")


def _keep_last_sql(keys: str) -> str:
    return f"""WITH {WX} SELECT {WX_COLS} FROM wx
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY is_new DESC, ts DESC, {TIE_DESC}) = 1"""


@query("dedup_keep_last", _keep_last_sql("temperature, humidity, wind_speed"))
def dedup_keep_last(spark, sf_dir):
    both = D.union_datasets(*weather_rows(spark, sf_dir))
    return D.dedup_keep_last(both, [D.SOURCE, "ts", *TIE]).drop(D.SOURCE)


@query("dedup_rounded", _keep_last_sql("round(temperature, 2), round(humidity, 1), round(wind_speed, 2)"))
def dedup_rounded(spark, sf_dir):
    both = D.union_datasets(*weather_rows(spark, sf_dir))
    return D.dedup_keep_last(both, [D.SOURCE, "ts", *TIE], rounding=D.ROUNDING).drop(D.SOURCE)


@query("merge_datasets", _keep_last_sql("temperature, humidity, wind_speed"))
def merge_datasets(spark, sf_dir):
    return D.merge_datasets(*weather_rows(spark, sf_dir), time="ts", tie=TIE)


@query("dataset_period", with_clean("SELECT count(*) AS row_count, min(event_time) AS period_start, max(event_time) AS period_end FROM clean"))
def dataset_period(spark, sf_dir):
    return D.dataset_period(cleaned_observations(spark, sf_dir), "event_time")


# Model input --------------------------------------------------------------------------------------------------

B_BY_NAME = {n: e for e, n in B_ALL + B_TARGETS}
PREPARED_COLS = [(B_BY_NAME.get(f, f), f) for f in MODEL_FEATURES] + B_TARGETS
PREPARED_SQL = f"""prep AS (SELECT * FROM (SELECT id, location, event_time, {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for e, n in PREPARED_COLS)} FROM clean)
    WHERE {' AND '.join(f'{n} IS NOT NULL' for _, n in PREPARED_COLS)})"""


def prepared(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    full = X.engineer_features_batch(cleaned_observations(spark, sf_dir), KEY, ORDER, "event_time", targets=True)
    return M.prepare_features(full, ["id", *KEY, "event_time"])


@query("prepare_features", with_clean(f", {PREPARED_SQL} SELECT id, {', '.join(r(n, n) for _, n in PREPARED_COLS)} FROM prep"))
def prepare_features(spark, sf_dir):
    rows, _ = prepared(spark, sf_dir)
    names = [n for _, n in PREPARED_COLS]
    return rounded(rows.select("id", *[F.col(n).cast("double").alias(n) for n in names]))


@query("temporal_split", with_clean("""SELECT id, location,
    row_number() OVER (PARTITION BY location ORDER BY event_time, id) <= floor(count(*) OVER (PARTITION BY location) * 0.8) AS is_train
  FROM clean"""))
def temporal_split(spark, sf_dir):
    return M.temporal_split(cleaned_observations(spark, sf_dir), KEY, ORDER).select("id", "location", "is_train")


@query("temporal_split_global", with_clean("""SELECT id,
    row_number() OVER (ORDER BY event_time, id) <= floor(count(*) OVER () * 0.8) AS is_train FROM clean"""))
def temporal_split_global(spark, sf_dir):
    c = cleaned_observations(spark, sf_dir).select("id", "event_time")
    return M.temporal_split(c, [], ORDER).select("id", "is_train")


@query("vector_fill", with_clean(f""", prep AS (SELECT id, {', '.join(f'CAST({B_BY_NAME.get(f, f)} AS DOUBLE) AS {f}' for f in MODEL_FEATURES)} FROM clean)
  SELECT id, {', '.join(r(f'coalesce({f}, 0.0)', f) for f in MODEL_FEATURES)},
    concat_ws(',', {', '.join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in MODEL_FEATURES)}) AS missing_features FROM prep"""))
def vector_fill(spark, sf_dir):
    from skygrain.operators.serving import fill_features

    full = X.engineer_features_batch(cleaned_observations(spark, sf_dir), KEY, ORDER, "event_time")
    filled = fill_features(full, MODEL_FEATURES)
    return rounded(filled.select("id", *MODEL_FEATURES, F.array_join("missing_features", ",").alias("missing_features")))


SCALED = ["temperature", "humidity", "wind_speed", "pressure"]


def _scale(c: str) -> str:
    return f"({c} - (SELECT min({c}) FROM clean)) / (SELECT max({c}) - min({c}) FROM clean)"


@query("minmax_scale", with_clean(f"SELECT id, {', '.join(r(_scale(c), c) for c in SCALED)} FROM clean"))
def minmax_scale(spark, sf_dir):
    c = cleaned_observations(spark, sf_dir)
    return rounded(M.minmax_transform(c, M.minmax_fit(c, SCALED), SCALED).select("id", *SCALED))


@query("minmax_inverse", with_clean(f"SELECT id, {', '.join(r(c, c) for c in SCALED)} FROM clean"))
def minmax_inverse(spark, sf_dir):
    c = cleaned_observations(spark, sf_dir)
    fit = M.minmax_fit(c, SCALED)
    scaled = M.minmax_transform(c, fit, SCALED).select("id", *SCALED)
    return rounded(M.minmax_inverse(scaled, fit, {c: c for c in SCALED}))


STEPS = 24
SEQ_TEXT = f"""array_to_string(list(CAST(round(temperature * 100) AS BIGINT)) OVER (PARTITION BY location ORDER BY event_time, id
    ROWS BETWEEN {STEPS - 1} PRECEDING AND CURRENT ROW), ',')"""


def _sequence_sql(far: int, ys: str) -> str:
    return f""", s AS (SELECT id, location, {SEQ_TEXT} AS x,
      row_number() OVER (PARTITION BY location ORDER BY event_time, id) - {STEPS} AS sequence_no,
      count(*) OVER (PARTITION BY location) - {STEPS} - {far} + 1 AS n, {ys} FROM clean)"""


def _lead(h: int) -> str:
    return f"lead(temperature, {h}) OVER (PARTITION BY location ORDER BY event_time, id) AS y{h}"


def observation_sequences(spark, sf_dir, horizons) -> DataFrame:
    c = cleaned_observations(spark, sf_dir)
    seqs = M.sequences(c, KEY, ORDER, ["temperature", "humidity", "wind_speed", "pressure"], "temperature", STEPS, horizons)
    text = F.array_join(F.transform("x", lambda v: F.round(v["temperature"] * 100).cast("bigint").cast("string")), ",")
    ys = [F.get("y", F.lit(i)).alias(f"y{h}") for i, h in enumerate(horizons)]
    return seqs.withColumn("x", text).select("*", *ys)


@query("sequences", with_clean(f"""{_sequence_sql(3, _lead(3))} SELECT id, location, x, y3, sequence_no FROM s
  WHERE sequence_no >= 0 AND sequence_no < n"""))
def sequences(spark, sf_dir):
    return observation_sequences(spark, sf_dir, [3]).select("id", "location", "x", "y3", "sequence_no")


MULTI = _sequence_sql(6, ", ".join(_lead(h) for h in (1, 3, 6)))


@query("sequences_multi", with_clean(f"""{MULTI} SELECT id, location, x, y1, y3, y6, sequence_no FROM s
  WHERE sequence_no >= 0 AND sequence_no < n"""))
def sequences_multi(spark, sf_dir):
    return observation_sequences(spark, sf_dir, [1, 3, 6]).select("id", "location", "x", "y1", "y3", "y6", "sequence_no")


@query("sequence_split", with_clean(f"""{MULTI} SELECT id, location, sequence_no, sequence_no < floor(n * 0.8) AS is_train FROM s
  WHERE sequence_no >= 0 AND sequence_no < n"""))
def sequence_split(spark, sf_dir):
    seqs = observation_sequences(spark, sf_dir, [1, 3, 6])
    return M.sequence_split(seqs).select("id", "location", "sequence_no", "is_train")


# Scores -------------------------------------------------------------------------------------------------------
# A naive forecast (temperature stays as it is) against the temperature 1, 3 and 6 rows later.

NAIVE = """naive AS (SELECT location, temperature AS p, lead(temperature, h) OVER (PARTITION BY h, location ORDER BY event_time, id) AS y, h AS horizon
    FROM clean, (SELECT unnest([1, 3, 6]) AS h))"""
SCORE = """avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2"""


def naive_forecasts(spark, sf_dir) -> DataFrame:
    t = X.create_targets(cleaned_observations(spark, sf_dir), KEY, ORDER)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_temperature_{h}h").alias("y")) for h in (1, 3, 6)]))
    return t.select("location", F.col("temperature").alias("p"), stacked.alias("t")).select("location", "p", "t.*")


@query("regression_metrics", with_clean(f""", {NAIVE} SELECT horizon, {r('mae', 'mae')}, {r('rmse', 'rmse')}, {r('r2', 'r2')}
  FROM (SELECT horizon, {SCORE} FROM naive WHERE y IS NOT NULL GROUP BY horizon)"""))
def regression_metrics(spark, sf_dir):
    return rounded(M.regression_metrics(naive_forecasts(spark, sf_dir), "y", "p", ["horizon"]))


@query("descaled_metrics", with_clean(f""", {NAIVE} SELECT horizon, {r('mae', 'mae')}, {r('rmse', 'rmse')}, {r('r2', 'r2')} FROM (
    SELECT horizon, {SCORE} FROM naive WHERE y IS NOT NULL GROUP BY horizon)"""))
def descaled_metrics(spark, sf_dir):
    c = cleaned_observations(spark, sf_dir)
    fit = M.minmax_fit(c, ["temperature"])
    both = {"y": "temperature", "p": "temperature"}
    scaled = M.minmax_transform(naive_forecasts(spark, sf_dir), fit, both)
    back = M.minmax_inverse(scaled, fit, both)
    return rounded(M.regression_metrics(back, "y", "p", ["horizon"]))


@query("feature_completeness", with_clean(f""", f AS (SELECT {', '.join(f'CAST({B_BY_NAME.get(n, n)} AS DOUBLE) AS {n}' for n in MODEL_FEATURES)} FROM clean)
  {' UNION ALL '.join(f"SELECT '{n}' AS feature, count({n}) AS non_null, count(*) AS total, {r(f'count({n}) * 100.0 / count(*)', 'completeness_pct')} FROM f" for n in MODEL_FEATURES)}"""))
def feature_completeness(spark, sf_dir):
    full = X.engineer_features_batch(cleaned_observations(spark, sf_dir), KEY, ORDER, "event_time")
    return rounded(M.feature_completeness(full, MODEL_FEATURES))
