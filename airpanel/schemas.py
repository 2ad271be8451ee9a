"""Declared schemas and column lists. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = "series_id"
HOUR = "hr"  # hours since 1970-01-01T00:00Z; the integer axis every hourly window uses

POLLUTANTS = ["pm25", "pm10", "o3", "no2", "so2", "co"]

# Payload component name -> column name.
COMPONENTS = {
    "pm2_5": "pm25",
    "pm10": "pm10",
    "o3": "o3",
    "no2": "no2",
    "so2": "so2",
    "co": "co",
}

LEGACY_WEATHER = ["temperature", "humidity", "wind", "pressure"]

# Hourly weather variables a weather archive may carry.
WEATHER_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "surface_pressure",
    "wind_speed_10m",
    "wind_direction_10m",
    "wind_gusts_10m",
    "precipitation",
    "cloud_cover",
    "boundary_layer_height",
    "temperature_100m",
]

HOURLY_HORIZONS = [1, 3, 6, 12, 24, 36, 48, 60, 72]
REPORT_HORIZONS = [24, 48, 72]
DAILY_HORIZONS = [1, 2, 3]

HOURLY_FEATURES = [
    *POLLUTANTS,
    "aqi",
    "aqi_lag1", "aqi_lag2", "aqi_lag3", "aqi_diff1", "aqi_diff3",
    "aqi_lag24", "aqi_lag48", "aqi_lag168",
    "aqi_roll24", "aqi_roll72", "aqi_roll168",
    "aqi_minus_roll24", "aqi_minus_roll168", "aqi_minus_hourly_norm",
    "hour_sin", "hour_cos", "doy_sin", "doy_cos", "day_of_week",
]

DAILY_FEATURES = [
    *POLLUTANTS,
    "aqi", "aqi_change_rate", "aqi_lag1", "aqi_lag2",
    "aqi_rolling_mean_3", "aqi_rolling_mean_7",
    "aqi_minus_rolling_3", "aqi_minus_rolling_7",
    "doy_sin", "doy_cos",
]

# Rows that a change at one hour can influence: the longest feature look-back
# (168 h lag) on top of the 24 h concentration mean (23 h back).
FEATURE_LOOKBACK_HOURS = 168 + 23

_COMPONENT_STRUCT = T.StructType([
    T.StructField(name, T.DoubleType())
    for name in ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]
])

_POLLUTION_ENTRY = T.StructType([
    T.StructField("main", T.StructType([T.StructField("aqi", T.IntegerType())])),
    T.StructField("components", _COMPONENT_STRUCT),
    T.StructField("dt", T.LongType()),
])

OBSERVATION_PAYLOAD = T.StructType([
    T.StructField("fetched_at_utc", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("pollution", T.StructType([
        T.StructField("list", T.ArrayType(_POLLUTION_ENTRY)),
    ])),
    T.StructField("weather", T.StructType([
        T.StructField("main", T.StructType([
            T.StructField("temp", T.DoubleType()),
            T.StructField("pressure", T.DoubleType()),
            T.StructField("humidity", T.DoubleType()),
        ])),
        T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
        T.StructField("dt", T.LongType()),
        T.StructField("name", T.StringType()),
    ])),
])

HISTORY_PAYLOAD = T.StructType([T.StructField("list", T.ArrayType(_POLLUTION_ENTRY))])

STATION_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("aqi", T.IntegerType()),
        T.StructField("idx", T.LongType()),
        T.StructField("city", T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("geo", T.ArrayType(T.DoubleType())),
        ])),
        T.StructField("dominentpol", T.StringType()),
        T.StructField("iaqi", T.MapType(
            T.StringType(), T.StructType([T.StructField("v", T.DoubleType())]))),
        T.StructField("time", T.StructType([
            T.StructField("s", T.StringType()),
            T.StructField("tz", T.StringType()),
            T.StructField("v", T.LongType()),
            T.StructField("iso", T.StringType()),
        ])),
    ])),
])


def weather_payload(variables: list[str] | None = None) -> T.StructType:
    """Struct-of-arrays schema for the variables an archive is known to carry."""
    chosen = WEATHER_VARIABLES if variables is None else variables
    return T.StructType([
        T.StructField("hourly", T.StructType(
            [T.StructField("time", T.ArrayType(T.StringType()))]
            + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in chosen])),
    ])


METRICS = T.StructType([
    T.StructField(SERIES, T.StringType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_folds", T.LongType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("rmse_std", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("delta_r2", T.DoubleType()),
    T.StructField("k", T.DoubleType()),
])
