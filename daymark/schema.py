"""Column layouts, fixed metadata tables and Spark schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Measure columns of the daily table, in their published order.
MEASURES = (
    "t2m",
    "t2m_min",
    "t2m_max",
    "rh2m",
    "prectotcorr",
    "ws2m",
    "allsky_sfc_sw_dwn",
)

# Code, display name, unit and description of every variable.
VARIABLE_METADATA = (
    ("T2M", "Mean air temperature at 2 metres", "degC",
     "Daily mean air temperature at 2 metres"),
    ("T2M_MIN", "Minimum air temperature at 2 metres", "degC",
     "Daily minimum air temperature at 2 metres"),
    ("T2M_MAX", "Maximum air temperature at 2 metres", "degC",
     "Daily maximum air temperature at 2 metres"),
    ("RH2M", "Relative humidity at 2 metres", "%",
     "Daily relative humidity at 2 metres"),
    ("PRECTOTCORR", "Corrected precipitation", "mm/day",
     "Daily corrected precipitation"),
    ("WS2M", "Wind speed at 2 metres", "m/s",
     "Daily wind speed at 2 metres"),
    ("ALLSKY_SFC_SW_DWN", "All-sky surface shortwave downward irradiance", "MJ/m2/day",
     "Daily surface shortwave solar radiation"),
)

# Name, provider, resolution and description of the known source.
SOURCE_METADATA = (
    ("NASA_POWER", "NASA POWER", "daily", "NASA POWER daily meteorological data"),
)

# Numeric codes that providers use in place of a missing reading.
SENTINELS = (-9999, -999, -99, 999, 9999)

DEFAULT_SOURCE = "NASA_POWER"
DEFAULT_COUNTRY = "Tanzania"


@dataclass(frozen=True)
class Layout:
    """Names of the columns an operator works on, and the rules tied to them."""

    date: str = "date"
    location: str = "location"
    latitude: str = "latitude"
    longitude: str = "longitude"
    source: str = "source"
    measures: tuple[str, ...] = MEASURES
    mean_temperature: str = "t2m"
    min_temperature: str = "t2m_min"
    max_temperature: str = "t2m_max"
    humidity: str = "rh2m"
    precipitation: str = "prectotcorr"
    non_negative: tuple[str, ...] = ("prectotcorr", "ws2m", "allsky_sfc_sw_dwn")
    expected_source: str = DEFAULT_SOURCE
    fill_value: float = -999.0

    @property
    def required(self) -> tuple[str, ...]:
        return (self.date, self.location, self.latitude, self.longitude, self.source,
                *self.measures)

    @property
    def numeric(self) -> tuple[str, ...]:
        return (self.latitude, self.longitude, *self.measures)

    @property
    def series(self) -> tuple[str, str]:
        return (self.location, self.source)

    def wide_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.date, T.DateType()),
             T.StructField(self.location, T.StringType()),
             T.StructField(self.latitude, T.DoubleType()),
             T.StructField(self.longitude, T.DoubleType()),
             T.StructField(self.source, T.StringType())]
            + [T.StructField(m, T.DoubleType()) for m in self.measures])

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.required])


WIDE = Layout()
MART = Layout(date="observation_date", location="location_name", source="source_name")


def code_of(measure: str) -> str:
    """Variable code of a measure column."""
    return measure.upper()


PAYLOAD_SCHEMA = T.StructType([
    T.StructField("properties", T.StructType([
        T.StructField("parameter", T.MapType(
            T.StringType(), T.MapType(T.StringType(), T.DoubleType())))]))])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("parameters", T.ArrayType(T.StringType())),
    T.StructField("raw_file", T.StringType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_verified_at", T.TimestampType())])

# Dimension and label of each basic problem, and the total that counts it.
CANDIDATE_PROBLEMS = (
    ("Completeness", "Missing daily dates", "missing_days"),
    ("Uniqueness", "Duplicate location-date records", "duplicate_location_date_rows"),
    ("Consistency", "Invalid min/mean/max temperature ordering",
     "temperature_consistency_violations"),
    ("Validity", "Relative humidity outside 0-100%", "invalid_relative_humidity"),
    ("Validity", "Negative precipitation values", "negative_precipitation"),
    ("Validity", "Negative wind-speed values", "negative_wind_speed"))
