"""Queries over observations: normalisation, filters, features, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.book import query
from registry.views import CLEAN, KEY, OBS, ORDER, RAW, observations, r, raw_records, rounded
from skygrain.functions import series as S, values as V
from skygrain.operators import features as X, filters, normalize as N, windows as W
from skygrain.sources.contracts import parse_once
from skygrain.sources.tables import explode_hourly

CONVERT_T = """CASE WHEN t_unit IN ('K') THEN {v} - 273.15 WHEN t_unit IN ('°F') THEN ({v} - 32) * 5 / 9 ELSE {v} END"""
CONVERT_W = """CASE WHEN w_unit = 'm/s' THEN {v} * 3.6 WHEN w_unit = 'mph' THEN {v} * 1.60934 ELSE {v} END"""
CONVERT_P = """CASE WHEN p_unit = 'Pa' THEN {v} / 100 WHEN p_unit = 'kPa' THEN {v} * 10 ELSE {v} END"""
T, WS, P = CONVERT_T.format(v="temperature"), CONVERT_W.format(v="wind_speed"), CONVERT_P.format(v="pressure")


def with_obs(body: str) -> str:
    return f"WITH {OBS} {body}"


def with_raw(body: str) -> str:
    return f"WITH {OBS}, {RAW} {body}"


def with_clean(body: str) -> str:
    return f"WITH {OBS}, {CLEAN} {body}"


def cleaned_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.physical_range_filter(observations(spark, sf_dir))


# Normalisation ------------------------------------------------------------------------------------------------


@query("safe_cast", with_obs(f"""SELECT id, {r('try_cast(txt AS DOUBLE)', 'text_float')},
    CASE WHEN regexp_full_match(txt, '\\s*[+-]?\\d+\\s*') THEN CAST(trim(txt) AS INTEGER) END AS text_int,
    CAST(trunc(-temperature) AS INTEGER) AS number_int
  FROM (SELECT *, CASE id % 4 WHEN 0 THEN CAST(humidity AS VARCHAR) WHEN 1 THEN ' ' || CAST(cloud_cover AS VARCHAR) || ' '
    WHEN 2 THEN CAST(cloud_cover AS VARCHAR) || '.5' ELSE 'n/a' END AS txt FROM obs)"""))
def safe_cast(spark, sf_dir):
    n = F.col("id") % 4
    text = (
        F.when(n == 0, F.col("humidity").cast("string"))
        .when(n == 1, F.concat(F.lit(" "), F.col("cloud_cover").cast("string"), F.lit(" ")))
        .when(n == 2, F.concat(F.col("cloud_cover").cast("string"), F.lit(".5")))
        .otherwise("n/a")
    )
    o = observations(spark, sf_dir).withColumn("txt", text)
    return rounded(o.select(
        "id", V.to_float(F.col("txt")).alias("text_float"), V.to_int(F.col("txt")).alias("text_int"),
        V.to_int(-F.col("temperature")).alias("number_int"),
    ))


def _unit_query(name, convert, column, unit, sql_expr):
    @query(name, with_raw(f"SELECT id, {r(sql_expr, 'converted')} FROM raw"))
    def run(spark, sf_dir):
        raw = raw_records(spark, sf_dir)
        return rounded(raw.select("id", convert(F.col(f"current.{column}"), F.col(f"current_units.{unit}")).alias("converted")))


_unit_query("unit_temperature", V.convert_temperature, "temperature_2m", "temperature_2m", T)
_unit_query("unit_speed", V.convert_speed, "wind_speed_10m", "wind_speed_10m", WS)
_unit_query("unit_pressure", V.convert_pressure, "pressure_msl", "pressure_msl", P)

CURRENT_SQL = f"""id, time_text AS time, {r(T, 'temperature_2m')}, humidity AS relative_humidity_2m, {r('precipitation', 'precipitation')},
    {r(WS, 'wind_speed_10m')}, CAST(id % 360 AS INTEGER) AS wind_direction_10m, cloud_cover, {r(P, 'pressure_msl')},
    coalesce(r_unit, 'mm') AS precipitation_unit, '°C' AS temperature_unit"""


@query("clean_current", with_raw(f"SELECT {CURRENT_SQL} FROM raw"))
def clean_current(spark, sf_dir):
    c = raw_records(spark, sf_dir).select("id", N.clean_current().alias("c"))
    return rounded(c.select(
        "id", *[F.col(f"c.{n}") for n in ("time", "temperature_2m", "relative_humidity_2m", "precipitation",
                                         "wind_speed_10m", "wind_direction_10m", "cloud_cover", "pressure_msl")],
        F.col("c.units.precipitation").alias("precipitation_unit"),
        F.col("c.units.temperature").alias("temperature_unit"),
    ))


def _scaled_text(array, digits: int = 4):
    """Array of doubles as text of whole multiples, so that both engines print it alike."""
    return F.array_join(F.transform(array, lambda x: F.round(x * 10 ** digits).cast("bigint").cast("string")), ",", "-")


def _sql_list(expr: str, digits: int = 4) -> str:
    return f"""array_to_string(list_transform(range(hours), lambda i:
      coalesce(CAST(CAST(round(({expr}) * {10 ** digits}) AS BIGINT) AS VARCHAR), '-')), ',')"""


@query("clean_hourly", with_raw(f"""SELECT id, hours AS hourly_rows,
    {_sql_list(CONVERT_T.format(v='(temperature + i * 0.5)'))} AS temperature_2m,
    {_sql_list('humidity + i', 0)} AS relative_humidity_2m, {_sql_list('i * 10', 0)} AS precipitation_probability,
    {_sql_list(CONVERT_W.format(v='(wind_speed + i)'))} AS wind_speed_10m,
    CASE WHEN id % 2 = 0 THEN {_sql_list(CONVERT_P.format(v='(pressure - i)'))} ELSE '' END AS pressure_msl,
    CASE WHEN hours > 0 THEN time_text END AS first_hour
  FROM raw"""))
def clean_hourly(spark, sf_dir):
    h = raw_records(spark, sf_dir).select("id", N.clean_hourly().alias("h"))
    return h.select(
        "id", F.size("h.time").alias("hourly_rows"),
        _scaled_text(F.col("h.temperature_2m")).alias("temperature_2m"),
        _scaled_text(F.col("h.relative_humidity_2m"), 0).alias("relative_humidity_2m"),
        _scaled_text(F.col("h.precipitation_probability"), 0).alias("precipitation_probability"),
        _scaled_text(F.col("h.wind_speed_10m")).alias("wind_speed_10m"),
        _scaled_text(F.col("h.pressure_msl")).alias("pressure_msl"),
        F.get("h.time", F.lit(0)).alias("first_hour"),
    )


COMPLETE_SQL = """(CAST(temperature IS NOT NULL AS INT) + CAST(humidity IS NOT NULL AS INT)
    + CAST(precipitation IS NOT NULL AS INT) + CAST(wind_speed IS NOT NULL AS INT) + CAST(pressure IS NOT NULL AS INT)) / 5.0"""
ANOMALY_SQL = f"""concat_ws(',', CASE WHEN ({T}) < -50 OR ({T}) > 60 THEN 'temperature_out_of_range' END,
    CASE WHEN humidity < 0 OR humidity > 100 THEN 'humidity_out_of_range' END)"""


@query("row_completeness", with_raw(f"SELECT id, {r(COMPLETE_SQL, 'completeness')} FROM raw"))
def row_completeness(spark, sf_dir):
    return rounded(raw_records(spark, sf_dir).select("id", V.completeness("current").alias("completeness")))


@query("anomaly_flags", with_raw(f"""SELECT id, {ANOMALY_SQL} AS validation_errors,
    ({ANOMALY_SQL}) <> '' AS has_anomalies FROM raw"""))
def anomaly_flags(spark, sf_dir):
    c = raw_records(spark, sf_dir).select("id", N.clean_current().alias("c"))
    codes = V.anomaly_codes(F.col("c.temperature_2m"), F.col("c.relative_humidity_2m"))
    return c.select("id", F.array_join(codes, ",").alias("validation_errors"), (F.size(codes) > 0).alias("has_anomalies"))


@query("normalize", with_raw(f"""SELECT {CURRENT_SQL}, latitude, longitude, coalesce(elevation, 0.0) AS elevation,
    time_text AS event_time, hours AS hourly_rows, {r(COMPLETE_SQL, 'completeness')},
    {ANOMALY_SQL} AS validation_errors FROM raw"""))
def normalize(spark, sf_dir):
    n = N.normalize(raw_records(spark, sf_dir).drop("location"))
    c = "current"
    return rounded(n.select(
        "id", *[F.col(f"{c}.{x}") for x in ("time", "temperature_2m", "relative_humidity_2m", "precipitation",
                                           "wind_speed_10m", "wind_direction_10m", "cloud_cover", "pressure_msl")],
        F.col("current.units.precipitation").alias("precipitation_unit"),
        F.col("current.units.temperature").alias("temperature_unit"),
        "location.latitude", "location.longitude", "location.elevation", "event_time",
        F.size("hourly.time").alias("hourly_rows"),
        F.col("metadata.data_quality.completeness").alias("completeness"),
        F.array_join("metadata.data_quality.validation_errors", ",").alias("validation_errors"),
    ))


# The same records as JSON messages: by its id a record has its temperature as text, and its humidity as text, with a
# fraction (cut) or as text with a fraction (no whole number, so null); every other one has text inside ``hourly``.
@query("normalize_json", with_raw(f""", sent AS (SELECT * REPLACE (CASE WHEN id % 4 <> 3 THEN humidity END AS humidity),
    humidity AS hourly_humidity FROM raw)
  SELECT {CURRENT_SQL}, latitude, longitude, coalesce(elevation, 0.0) AS elevation, hours AS hourly_rows,
    CASE WHEN hours > 0 THEN hourly_humidity END AS first_humidity, {r(COMPLETE_SQL, 'completeness')},
    {ANOMALY_SQL} AS validation_errors FROM sent"""))
def normalize_json(spark, sf_dir):
    raw, n = raw_records(spark, sf_dir), F.col("id")
    value = F.to_json(F.struct(*[c for c in raw.columns if c not in ("id", "location")]))
    as_text, as_is = F.lit('"$1"'), F.lit("$1")
    humidity = F.when(n % 4 == 1, as_text).when(n % 4 == 2, "$1.7").when(n % 4 == 3, '"$1.7"').otherwise(as_is)
    for before, number, after in (
        ('"temperature_2m":', "[-0-9.E]+", F.when(n % 3 == 0, as_text).otherwise(as_is)),
        ('"relative_humidity_2m":', "[0-9]+", humidity),
        ('"relative_humidity_2m":[', "[0-9]+", F.when(n % 2 == 0, as_text).otherwise(as_is)),
    ):
        pattern = F.lit(before.replace("[", r"\[") + f"({number})")
        value = F.regexp_replace(value, pattern, F.concat(F.lit(before), after))
    messages = parse_once(raw, value.alias("value")).select("id", "value")
    out = N.normalize(N.parse_raw(messages))
    return rounded(out.select(
        "id", *[F.col(f"current.{x}") for x in ("time", "temperature_2m", "relative_humidity_2m", "precipitation",
                                                "wind_speed_10m", "wind_direction_10m", "cloud_cover", "pressure_msl")],
        F.col("current.units.precipitation").alias("precipitation_unit"),
        F.col("current.units.temperature").alias("temperature_unit"),
        "location.latitude", "location.longitude", "location.elevation", F.size("hourly.time").alias("hourly_rows"),
        F.get("hourly.relative_humidity_2m", F.lit(0)).alias("first_humidity"),
        F.col("metadata.data_quality.completeness").alias("completeness"),
        F.array_join("metadata.data_quality.validation_errors", ",").alias("validation_errors"),
    ))


@query("explode_hourly", with_raw(f"""SELECT id, CAST(date_trunc('second', event_time) + to_hours(CAST(i AS INTEGER)) AS TIMESTAMP) AS hour_time,
    {r('temperature + i * 0.5', 'temperature')}, CAST(humidity + i AS INTEGER) AS humidity, {r('wind_speed + i', 'wind_speed')},
    {r('CASE WHEN id % 2 = 0 THEN pressure - i END', 'pressure')}, cloud_cover, {r('precipitation', 'precipitation')}
  FROM (SELECT *, unnest(range(hours)) AS i FROM raw)"""))
def exploded(spark, sf_dir):
    return rounded(explode_hourly(raw_records(spark, sf_dir), ["id"]).withColumnRenamed("timestamp", "hour_time"))


@query("message_key", with_obs("""SELECT id, 'weather:' || CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR) || ':' ||
    strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS message_key FROM obs"""))
def message_key(spark, sf_dir):
    place = V.location_text(F.col("latitude"), F.col("longitude"))
    return observations(spark, sf_dir).select("id", V.message_key(place, F.col("event_time")).alias("message_key"))


# Filters ------------------------------------------------------------------------------------------------------

OBS_OUT = "id, location, temperature, humidity, wind_speed, pressure, cloud_cover, precipitation"


@query("drop_nulls", with_obs(f"SELECT {OBS_OUT} FROM obs WHERE temperature IS NOT NULL AND humidity IS NOT NULL"))
def drop_nulls(spark, sf_dir):
    return filters.drop_nulls(observations(spark, sf_dir), ["temperature", "humidity"]).select(*OBS_OUT.split(", "))


@query("range_filter", with_clean(f"SELECT {OBS_OUT} FROM clean"))
def range_filter(spark, sf_dir):
    return cleaned_observations(spark, sf_dir).select(*OBS_OUT.split(", "))


@query("clean_report", with_clean("""SELECT a AS rows_before, b AS rows_after, a - b AS rows_removed
  FROM (SELECT (SELECT count(*) FROM obs) AS a, (SELECT count(*) FROM clean) AS b)"""))
def clean_report(spark, sf_dir):
    return filters.removed_rows(observations(spark, sf_dir))


# Streaming features, in batch form ----------------------------------------------------------------------------


def _frame(n: int) -> str:
    return f"(PARTITION BY location ORDER BY event_time, id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rolling_sql(s: str, n: int) -> list[str]:
    col, f = X.SERIES[s], _frame(n)
    out = []
    for stat, fn in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")):
        out.append((f"CASE WHEN count(*) OVER {f} >= {n} THEN {fn}({col}) OVER {f} END", f"{s}_{stat}_{n}h"))
    return out


def lag_sql(col: str, n: int) -> str:
    return f"lag({col}, {n}) OVER (PARTITION BY location ORDER BY event_time, id)"


def delta_sql(col: str, n: int) -> str:
    return f"{col} - {lag_sql(col, n)}"


ROLL = {s: [c for n in S.ROLLING_ROWS for c in rolling_sql(s, n)] for s in S.ROLLING_SERIES}
DELTAS = [(delta_sql(X.SERIES[s], n), f"{s}_delta_{n}h") for s, ns in S.DELTA_ROWS.items() for n in ns]
RATES = [(f"({delta_sql(X.SERIES[s], n)}) / {n}.0", f"{s}_roc_{n}h") for s, n in S.RATE_ROWS]
LAGS = [(lag_sql(X.SERIES[s], n), f"{s}_lag_{n}h") for s, ns in S.LAG_ROWS.items() for n in ns]
VOLATILITY = [(rolling_sql("temp", 6)[1][0], "temp_volatility_6h")]
HISTORY = [c for s in S.ROLLING_SERIES for c in ROLL[s]] + DELTAS + RATES + LAGS + VOLATILITY


def as_double(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _history_query(name: str, columns, sql_cols):
    names = [n for _, n in sql_cols]

    @query(name, with_obs(f"SELECT id, {', '.join(r(e, n) for e, n in sql_cols)} FROM obs"))
    def run(spark, sf_dir):
        out = X.over_history(observations(spark, sf_dir), KEY, ORDER, columns)
        return rounded(as_double(out.select("id", *names), names))


for _s in S.ROLLING_SERIES:
    _history_query(f"rolling_{_s}", lambda w, s=_s: X.rolling_columns(s, w), ROLL[_s])
_history_query("deltas", X.delta_columns, DELTAS)
_history_query("rate_of_change", X.rate_columns, RATES)
_history_query("lags", X.lag_columns, LAGS)
_history_query("volatility", lambda w: {"temp_volatility_6h": S.volatility(F.col("temperature"), w)}, VOLATILITY)

CYCLE_SQL = [
    ("sin(2 * pi() * hour(event_time) / 24)", "hour_sin"), ("cos(2 * pi() * hour(event_time) / 24)", "hour_cos"),
    ("sin(2 * pi() * (isodow(event_time) - 1) / 7)", "day_sin"), ("cos(2 * pi() * (isodow(event_time) - 1) / 7)", "day_cos"),
]
FLAGS_SQL = """CAST(hour(event_time) BETWEEN 6 AND 20 AS INTEGER) AS is_day, CAST(isodow(event_time) >= 6 AS INTEGER) AS is_weekend"""


@query("cyclical", with_obs(f"SELECT id, {', '.join(r(e, n) for e, n in CYCLE_SQL)}, {FLAGS_SQL} FROM obs"))
def cyclical(spark, sf_dir):
    t = F.col("event_time")
    cols = S.cyclical(t) | S.day_flags(t)
    return rounded(observations(spark, sf_dir).select("id", *[c.alias(n) for n, c in cols.items()]))


@query("positional_targets", with_raw(f"""SELECT id, {', '.join(
    r(f'CASE WHEN hours > {h} THEN temperature + {h} * 0.5 END', f'temp_target_{h}h') for h in (1, 3, 6))} FROM raw"""))
def positional_targets(spark, sf_dir):
    t = S.positional_targets(F.col("hourly.temperature_2m"))
    return rounded(raw_records(spark, sf_dir).select("id", *[c.alias(n) for n, c in t.items()]))


def feature_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the time text and the forecast that the feature record needs."""
    hours = F.when(F.col("id") % 9 > 0, F.sequence(F.lit(0), (F.col("id") % 9 - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))
    return observations(spark, sf_dir).withColumns({
        "time_text": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"),
        "forecast": F.transform(hours, lambda i: F.col("temperature") + i * 0.5),
    })


def feature_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.engineer_features(feature_input(spark, sf_dir), KEY, ORDER)


BASE_SQL = [(c, n) for n, c in X.BASE.items()]
COUNT_SQL = " + ".join(f"CAST(({e}) IS NOT NULL AS INTEGER)" for e, _ in BASE_SQL + HISTORY) + " + 6"
SAMPLES_SQL = "row_number() OVER (PARTITION BY location ORDER BY event_time, id)"


@query("feature_count", with_obs(f"""SELECT id, CAST({COUNT_SQL} AS INTEGER) AS feature_count,
    CAST(least({SAMPLES_SQL}, 168) AS INTEGER) AS history_size, CAST({SAMPLES_SQL} AS INTEGER) AS samples_accumulated FROM obs"""))
def feature_count(spark, sf_dir):
    m = "metadata"
    return feature_records(spark, sf_dir).select("id", f"{m}.feature_count", f"{m}.history_size", f"{m}.samples_accumulated")


TARGET_SQL = [(f"CASE WHEN id % 9 > {h} THEN temperature + {h} * 0.5 END", f"temp_target_{h}h") for h in (1, 3, 6)]


def history_leaves() -> list:
    h, cols = "historical_features", []
    for s in S.ROLLING_SERIES:
        for n in S.ROLLING_ROWS:
            cols += [F.col(f"{h}.{s}_rolling_{n}h.{x}_{n}h").alias(f"{s}_{x}_{n}h") for x in ("mean", "std", "min", "max")]
    cols += [F.col(f"{h}.{s}_deltas.delta_{n}h").alias(f"{s}_delta_{n}h") for s, ns in S.DELTA_ROWS.items() for n in ns]
    cols += [F.col(f"{h}.{s}_roc_{n}h") for s, n in S.RATE_ROWS]
    cols += [F.col(f"{h}.{s}_lags.lag_{n}h").cast("double").alias(f"{s}_lag_{n}h") for s, ns in S.LAG_ROWS.items() for n in ns]
    return [*cols, F.col(f"{h}.temp_volatility_6h")]


@query("engineer_features", with_obs(f"""SELECT id, latitude, longitude, elevation,
    strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS time_text, {', '.join(r(e, n) for e, n in BASE_SQL + HISTORY + CYCLE_SQL + TARGET_SQL)},
    {FLAGS_SQL}, CAST({SAMPLES_SQL} AS INTEGER) AS samples_accumulated FROM obs"""))
def engineer_features(spark, sf_dir):
    return rounded(feature_records(spark, sf_dir).select(
        "id", "location.*", F.col("timestamp").alias("time_text"), "base_features.*", *history_leaves(),
        "cyclical_features.*", "target_labels.*", "metadata.samples_accumulated"))


@query("history_summary", with_obs("""SELECT location, count(*) AS samples, 168 AS max_capacity, min(temperature) AS temp_min,
    max(temperature) AS temp_max, min(event_time) AS oldest, max(event_time) AS newest
  FROM (SELECT *, row_number() OVER (PARTITION BY location ORDER BY event_time DESC, id DESC) AS k FROM obs)
  WHERE k <= 168 GROUP BY location"""))
def history_summary(spark, sf_dir):
    return X.history_summary(observations(spark, sf_dir), KEY, ORDER)


# Offline features ---------------------------------------------------------------------------------------------

B_LAGS = [(lag_sql(c, n), X._named(c, f"lag_{n}h")) for c, ns in X.BATCH_LAGS.items() for n in ns]
B_MEANS = [(f"avg({c}) OVER {_frame(n)}", X._named(c, f"rolling_mean_{n}h")) for c, ns in X.BATCH_MEANS.items() for n in ns]
B_DIFFS = [(delta_sql(c, n), X._named(c, f"delta_{n}h")) for c, ns in X.BATCH_DIFFS.items() for n in ns]
B_TARGETS = [(f"lead(temperature, {h}) OVER (PARTITION BY location ORDER BY event_time, id)", f"target_temperature_{h}h")
             for h in (1, 3, 6)]


def _batch_query(name, columns, sql_cols, ahead=0):
    names = [n for _, n in sql_cols]

    @query(name, with_clean(f"SELECT id, {', '.join(r(e, n) for e, n in sql_cols)} FROM clean"))
    def run(spark, sf_dir):
        c = cleaned_observations(spark, sf_dir)
        out = X.over_history(c, KEY, ORDER, lambda w: columns(c.columns, w), X.BATCH_BACK, ahead)
        return rounded(as_double(out.select("id", *names), names))


_batch_query("batch_lags", X.batch_lag_columns, B_LAGS)
_batch_query("rolling_mean_min1", X.batch_mean_columns, B_MEANS)
_batch_query("batch_diffs", X.batch_diff_columns, B_DIFFS)
_batch_query("lead_targets", lambda cols, w: X.target_columns(w), B_TARGETS, 6)


@query("batch_cyclical", with_clean(f"SELECT id, {', '.join(r(e, n) for e, n in CYCLE_SQL)} FROM clean"))
def batch_cyclical(spark, sf_dir):
    c = cleaned_observations(spark, sf_dir)
    return rounded(c.select("id", *[x.alias(n) for n, x in S.cyclical(F.col("event_time")).items()]))


B_ALL = B_LAGS + B_MEANS + B_DIFFS + CYCLE_SQL


@query("batch_features", with_clean(f"SELECT id, location, event_time, {', '.join(r(e, n) for e, n in B_ALL)} FROM clean"))
def batch_features(spark, sf_dir):
    out = X.engineer_features_batch(cleaned_observations(spark, sf_dir), KEY, ORDER, "event_time")
    names = [n for _, n in B_ALL]
    return rounded(as_double(out.select("id", "location", "event_time", *names), names))


# Windows ------------------------------------------------------------------------------------------------------


def tumbling_sql(h: int) -> str:
    extra = ", avg(humidity) AS humidity_mean_1h, avg(wind_speed) AS wind_mean_1h" if h == 1 else ""
    return f"""t{h} AS (SELECT latitude, longitude, time_bucket(INTERVAL {h} HOUR, event_time) AS window_start,
      time_bucket(INTERVAL {h} HOUR, event_time) + INTERVAL {h} HOUR AS window_end, avg(temperature) AS temp_mean_{h}h,
      stddev_samp(temperature) AS temp_std_{h}h, min(temperature) AS temp_min_{h}h, max(temperature) AS temp_max_{h}h,
      arg_max(temperature, id) AS temp_last, arg_min(temperature, id) AS temp_first{extra} FROM obs GROUP BY ALL)"""


def tumbling_out(h: int) -> str:
    extra = f", {r('humidity_mean_1h', 'humidity_mean_1h')}, {r('wind_mean_1h', 'wind_mean_1h')}" if h == 1 else ""
    return f"""latitude, longitude, window_start, window_end, {', '.join(r(f'temp_{x}_{h}h', f'temp_{x}_{h}h')
      for x in ('mean', 'std', 'min', 'max'))}, temp_last, temp_first{extra}"""


def _tumbling_query(h: int):
    @query(f"tumbling_{h}h", with_obs(f", {tumbling_sql(h)} SELECT {tumbling_out(h)} FROM t{h}"))
    def run(spark, sf_dir):
        return rounded(W.tumbling(observations(spark, sf_dir), h))


for _h in (1, 3, 6):
    _tumbling_query(_h)


@query("first_last_window", with_obs("""SELECT location, time_bucket(INTERVAL 3 HOUR, event_time) AS window_start,
    arg_min(humidity, id) AS first_humidity, arg_max(humidity, id) AS last_humidity FROM obs GROUP BY ALL"""))
def first_last_window(spark, sf_dir):
    first, last = W.first_last("humidity", "id")
    o = observations(spark, sf_dir).groupBy("location", F.window("event_time", "3 hours"))
    return o.agg(first.alias("first_humidity"), last.alias("last_humidity")).select(
        "location", F.col("window.start").alias("window_start"), "first_humidity", "last_humidity")


def coarse_out(h: int) -> str:
    return f"""t{h}.window_end AS end_{h}h, {', '.join(r(f't{h}.temp_{x}_{h}h', f'temp_{x}_{h}h') for x in
      ('mean', 'std', 'min', 'max'))}, t{h}.temp_last AS temp_last_{h}h, t{h}.temp_first AS temp_first_{h}h"""


THREE = ", ".join(("", tumbling_sql(1), tumbling_sql(3), tumbling_sql(6)))
JOIN_OUT = f"""t1.latitude, t1.longitude, t1.window_end, t1.temp_last, t1.temp_first, {coarse_out(3)}, {coarse_out(6)}"""
CONTAINING = """FROM t1
    LEFT JOIN t3 ON t1.latitude = t3.latitude AND t1.longitude = t3.longitude AND time_bucket(INTERVAL 3 HOUR, t1.window_start) = t3.window_start
    LEFT JOIN t6 ON t1.latitude = t6.latitude AND t1.longitude = t6.longitude AND time_bucket(INTERVAL 6 HOUR, t1.window_start) = t6.window_start"""
JOIN_COLS = ["latitude", "longitude", "window_end", "temp_last", "temp_first"] + [
    c for h in (3, 6) for c in (f"end_{h}h", f"temp_mean_{h}h", f"temp_std_{h}h", f"temp_min_{h}h", f"temp_max_{h}h",
                                f"temp_last_{h}h", f"temp_first_{h}h")]


@query("window_join", with_obs(f"{THREE} SELECT {JOIN_OUT} {CONTAINING}"))
def window_join(spark, sf_dir):
    return rounded(W.rolled_up_windows(observations(spark, sf_dir)).select(*JOIN_COLS))


@query("window_join_within", with_obs(f"""{THREE} SELECT {JOIN_OUT} FROM t1
    LEFT JOIN t3 ON t1.latitude = t3.latitude AND t1.longitude = t3.longitude
      AND t3.window_end BETWEEN t1.window_end - INTERVAL 3 HOUR AND t1.window_end + INTERVAL 3 HOUR
    LEFT JOIN t6 ON t1.latitude = t6.latitude AND t1.longitude = t6.longitude
      AND t6.window_end BETWEEN t1.window_end - INTERVAL 6 HOUR AND t1.window_end + INTERVAL 6 HOUR"""))
def window_join_within(spark, sf_dir):
    return rounded(W.join_windows_within(*W.tumbling_from_hourly(observations(spark, sf_dir))).select(*JOIN_COLS))


ENRICHED = [("t1.temp_last", "temp_current")] + [
    (f"t{h}.temp_{x}_{h}h", f"{x}_{h}h") for h in (3, 6) for x in ("mean", "std", "min", "max")] + [
    (f"t{h}.temp_last - t{h}.temp_first", f"delta_{h}h") for h in (1, 3, 6)] + [
    (f"(t{h}.temp_last - t{h}.temp_first) / {h}.0", f"temp_roc_{h}h") for h in (3, 6)] + [
    (f"t{h}.temp_first", f"lag_{h}h") for h in (1, 3, 6)] + [("t6.temp_std_6h", "temp_volatility_6h")] + [
    ("NULL", n) for n in ("humidity_current", "wind_current", "pressure_current", "cloud_cover_current",
                          "precipitation_current", "delta_12h", "lag_2h", "lag_12h")]


def flat_enriched(nested: DataFrame) -> DataFrame:
    h = "historical_features"
    return rounded(nested.select(
        "latitude", "longitude", "feature_time", "base_features.*", f"{h}.temp_rolling_3h.*", f"{h}.temp_rolling_6h.*",
        f"{h}.temp_deltas.*", f"{h}.temp_roc_3h", f"{h}.temp_roc_6h", f"{h}.temp_lags.*", f"{h}.temp_volatility_6h"))


@query("hourly_enriched", with_obs(f"""{THREE} SELECT t1.latitude, t1.longitude, t1.window_end AS feature_time,
    {', '.join(r(e, n) for e, n in ENRICHED)} {CONTAINING}"""))
def hourly_enriched(spark, sf_dir):
    return flat_enriched(W.hourly_enriched(W.rolled_up_windows(observations(spark, sf_dir))))
