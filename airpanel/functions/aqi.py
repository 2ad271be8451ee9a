"""Air-quality index as native column expressions (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# US-EPA PM2.5 breakpoints before the 2024 revision, as
# (concentration low, concentration high, index low, index high).
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]

# EPA category per integer index band.
EPA_CATEGORIES = [
    (0, 50, "Good"),
    (51, 100, "Moderate"),
    (101, 150, "Unhealthy for Sensitive Groups"),
    (151, 200, "Unhealthy"),
    (201, 300, "Very Unhealthy"),
    (301, 500, "Hazardous"),
]

# Display ladder as (upper bound, label, colour, guidance).
DISPLAY_CATEGORIES = [
    (50, "Good", "#5b9c78", "Fine for outdoor activity."),
    (100, "Moderate", "#c9a94e",
     "Unusually sensitive people may want to limit long spells outdoors."),
    (150, "Unhealthy for sensitive groups", "#d18448",
     "Children, older adults and people with heart or lung conditions should "
     "ease off prolonged exertion outdoors."),
    (200, "Unhealthy", "#c25f4e", "Everyone should cut back on prolonged exertion outdoors."),
    (300, "Very unhealthy", "#9a5b8c", "Avoid prolonged exertion outdoors."),
    (500, "Hazardous", "#8d4a52", "Stay indoors where you can."),
]
UNKNOWN_COLOUR = "#7c93a8"

MAX_INDEX = 500
TOP_CONCENTRATION = PM25_BREAKPOINTS[-1][1]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def aqi_from_pm25(c: Column | str) -> Column:
    """EPA index (INT) of a concentration; NULL for missing, negative or non-numeric input.

    The concentration is truncated to one decimal before the lookup, which makes
    the bands contiguous, and the interpolated index is rounded half to even.
    """
    value = _col(c).try_cast("double")
    truncated = F.floor(value * 10) / 10
    index = F.when(value.isNull() | F.isnan(value) | (value < 0), F.lit(None).cast("double"))
    for c_low, c_high, i_low, i_high in PM25_BREAKPOINTS:
        slope = (i_high - i_low) / (c_high - c_low)
        index = index.when(truncated <= c_high, F.lit(slope) * (truncated - c_low) + i_low)
    return F.rint(index.otherwise(float(MAX_INDEX))).cast("int")


def aqi_capped(c: Column | str) -> Column:
    """The index, or 500 where a non-null input has no index (only negatives reach that)."""
    value = _col(c)
    return F.coalesce(
        aqi_from_pm25(value),
        F.when(value.isNotNull() & ~F.isnan(value.try_cast("double")), F.lit(MAX_INDEX)),
    )


def aqi_category(c: Column | str) -> Column:
    """EPA label; NULL for negatives and for fractions that fall between two bands."""
    value = _col(c)
    label = F.when(value > MAX_INDEX, EPA_CATEGORIES[-1][2])
    for low, high, name in EPA_CATEGORIES:
        label = label.when(value.between(low, high), name)
    return label


def categorise(c: Column | str) -> Column:
    """struct<label, colour, guidance> from the upper-bound display ladder."""
    value = _col(c)

    def entry(label: str, colour: str, guidance: str) -> Column:
        return F.struct(
            F.lit(label).alias("label"), F.lit(colour).alias("colour"),
            F.lit(guidance).alias("guidance"))

    ladder = F.when(
        value.isNull() | F.isnan(value.cast("double")), entry("Unknown", UNKNOWN_COLOUR, ""))
    for bound, label, colour, guidance in DISPLAY_CATEGORIES:
        ladder = ladder.when(value <= bound, entry(label, colour, guidance))
    return ladder.otherwise(entry(*DISPLAY_CATEGORIES[-1][1:]))


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Expose the three lookups to SQL users as SQL functions, inlined by Catalyst."""
    bands = " ".join(
        f"WHEN t <= {high}D THEN {(i_high - i_low) / (high - low)!r}D * (t - {low}D) + {i_low}"
        for low, high, i_low, i_high in PM25_BREAKPOINTS)
    names = " ".join(f"WHEN v BETWEEN {lo} AND {hi} THEN '{n}'" for lo, hi, n in EPA_CATEGORIES)
    ladder = " ".join(f"WHEN v <= {b} THEN '{n}'" for b, n, _, _ in DISPLAY_CATEGORIES)
    statements = {
        "airpanel_truncate": "(v DOUBLE) RETURNS DOUBLE RETURN floor(v * 10) / 10",
        "airpanel_band": (
            f"(t DOUBLE) RETURNS INT RETURN CAST(rint(CASE {bands} ELSE {MAX_INDEX} END) AS INT)"),
        "airpanel_aqi": (
            "(v DOUBLE) RETURNS INT RETURN CASE WHEN v IS NULL OR isnan(v) OR v < 0 THEN NULL "
            "ELSE airpanel_band(airpanel_truncate(v)) END"),
        "airpanel_category": (
            f"(v DOUBLE) RETURNS STRING RETURN CASE WHEN v > {MAX_INDEX} THEN "
            f"'{EPA_CATEGORIES[-1][2]}' {names} END"),
        "airpanel_display_label": (
            "(v DOUBLE) RETURNS STRING RETURN CASE WHEN v IS NULL OR isnan(v) THEN 'Unknown' "
            f"{ladder} ELSE '{DISPLAY_CATEGORIES[-1][1]}' END"),
    }
    for name, body in statements.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(statements)
