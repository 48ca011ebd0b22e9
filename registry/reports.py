"""Monitoring queries over predictions, observations and stored scores, and the alerts drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from registry.book import query
from registry.datasets import NAIVE, SCORE, feature_completeness, naive_forecasts
from registry.datasets import B_BY_NAME
from registry.observations import CLEAN, OBS, cleaned_observations, with_clean, with_obs
from registry.records import BACKLOG, backlog
from registry.views import PRED, observations, predictions, r, rounded, table
from skygrain.operators import alerts as A, filters, monitoring as Q, samples as M
from skygrain.sources.schemas import MODEL_FEATURES, POINT_FIELDS, QUANTILE_FIELDS

NOW, MINUTES = "1999-07-01 12:00:00", 60 * 24 * 90


def with_pred(body: str) -> str:
    return f"WITH {PRED}, p AS (SELECT *, temperature_prediction AS main_prediction FROM pred) {body}"


def main_predictions(spark, sf_dir) -> DataFrame:
    return Q.main_prediction(predictions(spark, sf_dir))


def now():
    return F.lit(NOW).cast("timestamp_ntz")


RECENT = f"created_at >= TIMESTAMP '{NOW}' - INTERVAL {MINUTES} MINUTE"
TIME_COLS = "id, horizon_hours, event_time, created_at, temperature_prediction"


@query("recent_window", with_pred(f"SELECT {TIME_COLS} FROM p WHERE {RECENT}"))
def recent_window(spark, sf_dir):
    return filters.recent_window(predictions(spark, sf_dir), now(), MINUTES).select(*TIME_COLS.split(", "))


@query("horizon_timeline", with_pred(f"SELECT {TIME_COLS} FROM p ORDER BY horizon_hours, created_at"))
def horizon_timeline(spark, sf_dir):
    return filters.by_horizon(predictions(spark, sf_dir)).select(*TIME_COLS.split(", "))


SPLIT_DAY = "2024-01-16"


def halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current, reference): the later and the earlier readings."""
    late = F.col("event_time") >= F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return df.filter(late), df.filter(~late)


def _ks_sql(col: str) -> str:
    return f"""(SELECT max(abs(a / na - b / nb)) FROM (
      SELECT sum(sum(late)) OVER (ORDER BY v) AS a, sum(sum(1 - late)) OVER (ORDER BY v) AS b, sum(sum(late)) OVER () AS na, sum(sum(1 - late)) OVER () AS nb
      FROM (SELECT {col} AS v, CAST(event_time >= TIMESTAMP '{SPLIT_DAY}' AS INTEGER) AS late FROM obs WHERE {col} IS NOT NULL) GROUP BY v))"""


@query("ks_drift", with_obs(f"""SELECT {r('d', 'ks_score')}, n AS current_rows, m AS reference_rows, 'ks_test' AS method,
    {r("CASE WHEN d * d * n * m / (n + m) < 0.04 THEN 1.0 ELSE least(greatest(list_sum([(CASE k % 2 WHEN 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * d * d * n * m / (n + m)) FOR k IN range(1, 101)]), 0.0), 1.0) END", 'p_value')}
  FROM (SELECT {_ks_sql('temperature')} AS d, count(*) FILTER (event_time >= TIMESTAMP '{SPLIT_DAY}') AS n,
    count(*) FILTER (event_time < TIMESTAMP '{SPLIT_DAY}') AS m FROM obs WHERE temperature IS NOT NULL)"""))
def ks_drift(spark, sf_dir):
    return rounded(Q.ks_drift(*halves(observations(spark, sf_dir)), "temperature", exact_rows=0))


# Mean temperatures of the day's hours, to whole degrees so that some are equal: two samples of at most 24 values.
@query("ks_drift_exact", with_obs(f""", hourly AS (SELECT event_time >= TIMESTAMP '{SPLIT_DAY}' AS now, hour(event_time) AS h,
    round(avg(temperature)) AS t FROM obs WHERE temperature IS NOT NULL GROUP BY ALL),
  sizes AS (SELECT count(*) FILTER (now) AS n, count(*) FILTER (NOT now) AS m FROM hourly),
  gaps AS (SELECT max(abs((SELECT count(*) FROM hourly x WHERE x.now AND x.t <= v.t) * m - (SELECT count(*) FROM hourly x
    WHERE NOT x.now AND x.t <= v.t) * n)) AS gap FROM (SELECT DISTINCT t FROM hourly) v, sizes),
  walk AS (SELECT 0 AS k, 0 AS i, CAST(1 AS DOUBLE) AS c UNION ALL SELECT k, i, sum(c) FROM (
    SELECT w.k + 1 AS k, w.i + s.d AS i, w.c FROM walk w, (VALUES (0), (1)) AS s (d), sizes, gaps
    WHERE w.k < n + m AND w.i + s.d <= n AND w.k + 1 - w.i - s.d <= m
      AND abs((w.i + s.d) * m - (w.k + 1 - w.i - s.d) * n) < gap) GROUP BY k, i),
  orders AS (SELECT product((m + q) / CAST(q AS DOUBLE)) AS total FROM sizes, (SELECT unnest(range(1, n + 1)) AS q FROM sizes))
  SELECT {r('gap / (n * m)', 'ks_score')}, n AS current_rows, m AS reference_rows, 'ks_test' AS method,
    {r('least(1.0, 1 - coalesce((SELECT max(c) FROM walk WHERE k = n + m), 0) / total)', 'p_value')} FROM sizes, gaps, orders""").replace(
        "WITH obs", "WITH RECURSIVE obs", 1))
def ks_drift_exact(spark, sf_dir):
    def hourly(rows):
        return rows.filter("temperature IS NOT NULL").groupBy(F.hour("event_time")).agg(
            F.round(F.avg("temperature")).alias("temperature"))

    current, reference = halves(observations(spark, sf_dir))
    return rounded(Q.ks_drift(hourly(current), hourly(reference), "temperature"))


MEAN_DRIFT = f"""abs(avg(temperature) FILTER (event_time >= TIMESTAMP '{SPLIT_DAY}')
    - avg(temperature) FILTER (event_time < TIMESTAMP '{SPLIT_DAY}'))"""


@query("mean_drift", with_obs(f"SELECT {r(MEAN_DRIFT, 'ks_score')}, 0.0::DOUBLE AS p_value, 'mean_diff_fallback' AS method FROM obs"))
def mean_drift(spark, sf_dir):
    return rounded(Q.mean_drift(*halves(observations(spark, sf_dir)), "temperature"))


@query("zscore_outliers", with_obs(f"""SELECT count(*) FILTER (z > 3) AS outlier_count,
    {r('count(*) FILTER (z > 3) * 100.0 / count(z)', 'outlier_pct')}, 3.0::DOUBLE AS threshold FROM (
    SELECT abs(temperature - (SELECT avg(temperature) FROM obs)) / (SELECT stddev_pop(temperature) FROM obs) AS z FROM obs)"""))
def zscore_outliers(spark, sf_dir):
    return rounded(Q.zscore_outliers(observations(spark, sf_dir), "temperature"))


CHECKED = ("id", "temperature", "humidity", "wind_speed", "pressure")


@query("missing_rates", with_obs(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {r(f"avg(CAST({c} IS NULL AS INTEGER))", 'missing_rate')} FROM obs HAVING count({c}) < count(*)"""
    for c in CHECKED)))
def missing_rates(spark, sf_dir):
    return rounded(Q.missing_rates(observations(spark, sf_dir).select(*CHECKED)))


@query("range_violations", with_obs("""SELECT 'temperature' AS variable, count(*) FILTER (temperature < -50 OR temperature > 60) AS violations FROM obs
  UNION ALL SELECT 'humidity', count(*) FILTER (humidity < 0 OR humidity > 100) FROM obs
  UNION ALL SELECT 'wind_speed', count(*) FILTER (wind_speed < 0) FROM obs"""))
def range_violations(spark, sf_dir):
    return Q.range_violations(observations(spark, sf_dir))


@query("main_prediction", with_pred(f"""SELECT id, {r('main_prediction', 'of_both')},
    {r('main_prediction - 1.5', 'of_median')}, NULL::DOUBLE AS of_neither FROM p"""))
def main_prediction(spark, sf_dir):
    """Records with a point and a median, with a median only, and with neither."""
    p = predictions(spark, sf_dir).withColumn("temperature_p50", F.col("temperature_prediction") - 1.5)
    both = Q.main_prediction(p).withColumnRenamed("main_prediction", "of_both")
    median = Q.main_prediction(both.drop("temperature_prediction")).withColumnRenamed("main_prediction", "of_median")
    neither = Q.main_prediction(median.drop("temperature_p50"))
    return rounded(neither.select("id", "of_both", "of_median", F.col("main_prediction").alias("of_neither")))


def _fields_sql(kind: str, fields: tuple[str, ...]) -> str:
    here = [f for f in fields if f in TIME_COLS.split(", ")]
    gone = ",".join(f for f in fields if f not in here)
    return f"""SELECT '{kind}' AS kind, {str(not gone).lower()} AS is_valid, '{gone}' AS missing_fields,
        {r(f'{len(here)} * 100.0 / {len(fields)}', 'completeness')}, count(*) AS most_common FROM p"""


@query("prediction_fields", with_pred(" UNION ALL ".join(
    _fields_sql(k, f) for k, f in (("point", POINT_FIELDS), ("quantile", QUANTILE_FIELDS)))))
def prediction_fields(spark, sf_dir):
    """Point forecasts as JSON messages, checked for the fields of a point and of a quantile record."""
    messages = predictions(spark, sf_dir).select(F.to_json(F.struct(*TIME_COLS.split(", "))).alias("value"))
    found = [Q.schema_check(messages, f).withColumn("kind", F.lit(k))
             for k, f in (("point", POINT_FIELDS), ("quantile", QUANTILE_FIELDS))]
    return rounded(found[0].unionByName(found[1]))


@query("stability", with_pred(f"SELECT {r('stddev_pop(main_prediction)', 'stability')} FROM p"))
def stability(spark, sf_dir):
    return rounded(Q.stability(main_predictions(spark, sf_dir)))


@query("cross_horizon", with_pred("""SELECT event_time, count(*) AS horizons, coalesce(bool_and(step <= 10), true) AS is_consistent FROM (
    SELECT event_time, abs(v - lag(v) OVER (PARTITION BY event_time ORDER BY horizon_hours)) AS step FROM (
      SELECT event_time, horizon_hours, arg_max(main_prediction, id) AS v FROM p GROUP BY ALL)) GROUP BY event_time"""))
def cross_horizon(spark, sf_dir):
    return Q.cross_horizon_consistency(main_predictions(spark, sf_dir), ["event_time"], "id")


@query("confidence_intervals", with_pred(f"SELECT {', '.join(r(f'quantile_cont(main_prediction, {q})', n) for n, q in (('p10', 0.1), ('p50', 0.5), ('p90', 0.9)))} FROM p"))
def confidence_intervals(spark, sf_dir):
    return rounded(Q.confidence_intervals(main_predictions(spark, sf_dir)))


@query("throughput", with_pred(f"SELECT count(*) AS message_count, {r(f'count(*) / {MINUTES}.0', 'per_minute')} FROM p WHERE {RECENT}"))
def throughput(spark, sf_dir):
    recent = filters.recent_window(predictions(spark, sf_dir), now(), MINUTES)
    return rounded(Q.throughput(recent, MINUTES))


@query("stream_status", with_pred(f"SELECT CASE WHEN count(*) > 0 THEN 'OK' ELSE 'STOP' END AS status FROM p WHERE {RECENT}"))
def stream_status(spark, sf_dir):
    return Q.stream_status(filters.recent_window(predictions(spark, sf_dir), now(), MINUTES))


@query("per_minute_counts", """WITH c AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1)
  SELECT g.minute, coalesce(n, 0) AS message_count
  FROM (SELECT unnest(generate_series((SELECT min(minute) FROM c), (SELECT max(minute) FROM c), INTERVAL 1 MINUTE)) AS minute) g LEFT JOIN c USING (minute)""")
def per_minute_counts(spark, sf_dir):
    c = Q.per_minute_counts(table(spark, sf_dir, "events"), "ts")
    return c.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("median_latency", with_pred(f"SELECT {r('quantile_cont(epoch_us(created_at) / 1e6 - epoch_us(event_time) / 1e6, 0.5)', 'median_latency_sec')} FROM p"))
def median_latency(spark, sf_dir):
    return rounded(Q.median_latency(predictions(spark, sf_dir)))


BOX = (("minimum", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("maximum", 1))


@query("horizon_distribution", with_pred(f"SELECT horizon_hours, {', '.join(r(f'quantile_cont(main_prediction, {q})', n) for n, q in BOX)} FROM p GROUP BY horizon_hours"))
def horizon_distribution(spark, sf_dir):
    return rounded(Q.horizon_distribution(main_predictions(spark, sf_dir)))


@query("histogram", with_obs(f"""SELECT CASE WHEN event_time >= TIMESTAMP '{SPLIT_DAY}' THEN 'current' ELSE 'reference' END AS side,
    CAST(least(floor((temperature - (SELECT min(temperature) FROM obs)) / (SELECT max(temperature) - min(temperature) FROM obs) * 20), 19) AS INTEGER) AS bin,
    count(*) AS n FROM obs WHERE temperature IS NOT NULL GROUP BY 1, 2"""))
def histogram(spark, sf_dir):
    return Q.distribution_histogram(*halves(observations(spark, sf_dir)), "temperature")


# Stored scores: the naive forecast as one model; a second one that always says 20 °C knows only two horizons. ---

SCORES = f"""{NAIVE}, perf AS (SELECT horizon || 'h' AS horizon, mae AS test_mae, r2 AS test_r2 FROM (
    SELECT horizon, {SCORE} FROM naive WHERE y IS NOT NULL GROUP BY horizon)),
  flat AS (SELECT horizon || 'h' AS horizon, avg(abs(y - 20.0)) AS test_mae FROM naive WHERE y IS NOT NULL AND horizon <> 6 GROUP BY horizon)"""


def _scores(df: DataFrame) -> DataFrame:
    m = M.regression_metrics(df, "y", "p", ["horizon"])
    return m.select(F.concat(F.col("horizon").cast("string"), F.lit("h")).alias("horizon"),
                    F.col("mae").alias("test_mae"), F.col("r2").alias("test_r2"))


def performance(spark, sf_dir) -> DataFrame:
    return _scores(naive_forecasts(spark, sf_dir))


@query("offline_scores", with_clean(f", {SCORES} SELECT horizon, {r('test_mae', 'test_mae')}, {r('test_r2', 'test_r2')} FROM perf"))
def offline_scores(spark, sf_dir):
    return rounded(Q.offline_scores(performance(spark, sf_dir)))


@query("r2_vs_target", with_clean(f", {SCORES} SELECT horizon, {r('greatest(least(test_r2, 1), -1)', 'r2_test')}, 0.85::DOUBLE AS target FROM perf"))
def r2_vs_target(spark, sf_dir):
    return rounded(Q.r2_vs_target(performance(spark, sf_dir)))


@query("mae_vs_target", with_clean(f""", {SCORES} SELECT horizon, {r('test_mae', 'mae')},
    CAST(CASE WHEN starts_with(horizon, '1') THEN 2.0 WHEN starts_with(horizon, '3') THEN 3.0 ELSE 4.0 END AS DOUBLE) AS target FROM perf"""))
def mae_vs_target(spark, sf_dir):
    return rounded(Q.mae_vs_target(performance(spark, sf_dir)))


@query("model_compare", with_clean(f", {SCORES} SELECT perf.horizon, {r('perf.test_mae', 'naive_mae')}, {r('flat.test_mae', 'flat_mae')} FROM perf LEFT JOIN flat USING (horizon)"))
def model_compare(spark, sf_dir):
    flat = naive_forecasts(spark, sf_dir).filter(F.col("horizon") != 6).withColumn("p", F.lit(20.0))
    return rounded(Q.compare_models(performance(spark, sf_dir), _scores(flat), ("naive_mae", "flat_mae")))


# Alerts -------------------------------------------------------------------------------------------------------

WATCHED = ("temperature", "humidity")
LIMITS = {"drift_score_critical": 0.005, "completeness_warning": 99.0}
BACKLOG_ALERTS = """SELECT CASE WHEN total_messages > 1000 THEN 'CRITICAL' ELSE 'WARNING' END AS level, 'System' AS category,
    CASE WHEN total_messages > 1000 THEN 'High' ELSE 'Increased' END || ' Kafka lag on ' || topic || ': ' || total_messages || ' messages' AS message,
    CAST(total_messages AS DOUBLE) AS value FROM backlog WHERE total_messages > 500"""
DRIFT_ALERTS = f"""SELECT 'CRITICAL' AS level, 'Data Quality' AS category,
    printf('Feature drift detected: %s (score: %.2f)', feature, ks) AS message, {r('ks', 'value')}
  FROM ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {_ks_sql(c)} AS ks" for c in WATCHED)}) WHERE ks > 0.005"""
COMPLETENESS_ALERTS = f"""SELECT 'INFO' AS level, 'Data Quality' AS category,
    printf('Low feature completeness: %s (%.1f%%)', feature, pct) AS message, {r('pct', 'value')}
  FROM ({' UNION ALL '.join(f"SELECT '{n}' AS feature, count({n}) * 100.0 / count(*) AS pct FROM feats" for n in MODEL_FEATURES)}) WHERE pct < 99"""
FEATS = f"feats AS (SELECT {', '.join(f'CAST({B_BY_NAME.get(n, n)} AS DOUBLE) AS {n}' for n in MODEL_FEATURES)} FROM clean)"
STABILITY_ALERTS = f"""SELECT 'WARNING' AS level, 'Model' AS category,
    printf('High prediction instability detected (std: %.2f)', s) AS message, {r('s', 'value')}
  FROM (SELECT stddev_pop(temperature_prediction) AS s FROM pred) WHERE s > 5.0"""


def drift_table(spark, sf_dir) -> DataFrame:
    return Q.ks_drifts(*halves(observations(spark, sf_dir)), WATCHED).select("feature", "ks_score")


@query("backlog_alerts", f"{BACKLOG} {BACKLOG_ALERTS}")
def backlog_alerts(spark, sf_dir):
    return A.backlog_alerts(backlog(spark, sf_dir))


@query("drift_alerts", with_obs(DRIFT_ALERTS))
def drift_alerts(spark, sf_dir):
    return rounded(A.drift_alerts(drift_table(spark, sf_dir), LIMITS))


@query("completeness_alerts", f"WITH {OBS}, {CLEAN}, {FEATS} {COMPLETENESS_ALERTS}")
def completeness_alerts(spark, sf_dir):
    return rounded(A.completeness_alerts(feature_completeness(spark, sf_dir), LIMITS))


@query("stability_alerts", f"WITH {PRED} {STABILITY_ALERTS}")
def stability_alerts(spark, sf_dir):
    return rounded(A.stability_alerts(stability(spark, sf_dir)))


ALERT_PARTS = (BACKLOG_ALERTS, DRIFT_ALERTS, COMPLETENESS_ALERTS, STABILITY_ALERTS)


@query("check_alerts", f"{BACKLOG}, {OBS}, {CLEAN}, {FEATS}, {PRED} " + " UNION ALL ".join(
    f"SELECT *, {i}::INTEGER AS rule_no FROM ({part})" for i, part in enumerate(ALERT_PARTS, 1)))
def check_alerts(spark, sf_dir):
    return rounded(A.check_alerts(backlog(spark, sf_dir), drift_table(spark, sf_dir), feature_completeness(spark, sf_dir),
                                  stability(spark, sf_dir), LIMITS))


# Alert history: the busiest kind of event of each hour raises an alert; those from a day on arrive after the others.
HOURLY_ALERTS = f"""al AS (SELECT CAST(epoch(h) AS BIGINT) // 3600 AS pos, event_type AS message FROM (
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h, event_type, count(*) AS n FROM events GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY h ORDER BY n DESC, event_type) = 1),
  hist AS (SELECT * FROM al WHERE pos < epoch(TIMESTAMP '{SPLIT_DAY}') / 3600),
  fresh AS (SELECT *, row_number() OVER (ORDER BY pos) AS k FROM al WHERE pos >= epoch(TIMESTAMP '{SPLIT_DAY}') / 3600)"""


@query("alert_history", f"""WITH RECURSIVE {HOURLY_ALERTS}, f AS (
    SELECT 0::BIGINT AS k, (SELECT list(message ORDER BY pos DESC) FROM (SELECT * FROM hist ORDER BY pos DESC LIMIT 5)) AS top, NULL::BIGINT AS pos, NULL::VARCHAR AS message
    UNION ALL
    SELECT n.k, CASE WHEN list_contains(f.top, n.message) THEN f.top ELSE (list_prepend(n.message, f.top))[1:5] END,
      CASE WHEN NOT list_contains(f.top, n.message) THEN n.pos END, n.message FROM f JOIN fresh n ON n.k = f.k + 1)
  SELECT pos, message FROM (SELECT pos, message, 1 AS z FROM f WHERE pos IS NOT NULL UNION ALL SELECT pos, message, 0 FROM hist)""")
def alert_history(spark, sf_dir):
    hour = F.window("ts", "1 hour")["start"]
    counts = table(spark, sf_dir, "events").groupBy(hour.alias("h"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    busiest = Window.partitionBy("h").orderBy(F.desc("n"), "event_type")
    pos = F.floor(F.unix_seconds(F.col("h").cast("timestamp")) / 3600)
    al = counts.withColumn("k", F.row_number().over(busiest)).filter("k = 1").select(
        pos.alias("pos"), F.col("event_type").alias("message"))
    split = F.floor(F.unix_seconds(F.lit(SPLIT_DAY).cast("timestamp")) / 3600)
    return A.alert_history(al.filter(F.col("pos") < split), al.filter(F.col("pos") >= split), "pos")
