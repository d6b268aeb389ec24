"""Flatten parsed responses into readings and derive columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from skyledger.functions import derive

# Fixed value: the origin every reading is stamped with.
SOURCE_SYSTEM = "openweathermap"

# Fields both profiles take unchanged. get() gives null on an empty array,
# where [0] fails in ANSI mode.
MEASURES = {
    "city": "parsed.name",
    "temperature": "parsed.main.temp",
    "humidity": "parsed.main.humidity",
    "pressure": "parsed.main.pressure",
    "wind_speed": "parsed.wind.speed",
    "weather_condition": "get(parsed.weather, 0).main",
    "weather_description": "get(parsed.weather, 0).description",
    "event_time": derive.epoch_time("parsed.dt"),
    "country": "parsed.sys.country",
    "latitude": "parsed.coord.lat",
    "longitude": "parsed.coord.lon",
    "visibility": "parsed.visibility",
}


def _derived(rain: str, sunrise: str, sunset: str, as_of: datetime | str | None) -> dict[str, str]:
    return {
        "event_date": "CAST(event_time AS DATE)",
        "event_hour": "hour(event_time)",
        "temperature_band": derive.temperature_band("temperature"),
        "weather_severity_score": derive.severity_score("temperature", rain, "wind_speed"),
        "is_daytime": derive.daytime("event_time", sunrise, sunset),
        "source_system": f"'{SOURCE_SYSTEM}'",
        "ingestion_time": derive.moment(as_of),
    }


def _with(df: DataFrame, columns: list[str], added: dict[str, str]) -> DataFrame:
    kept = [f"`{name}`" for name in columns if name not in added]
    return df.selectExpr(*kept, *[f"{value} AS {name}" for name, value in added.items()])


def enrich(parsed: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Readings of the standard profile; all input columns stay, ``parsed`` too.

    Rain is that of the last hour, else of the last three, else 0.
    ``ingestion_time`` is replaced by the time of this step.
    """
    fields = MEASURES | {
        "feels_like": "parsed.main.feels_like",
        "rain_fall": "coalesce(parsed.rain.`1h`, parsed.rain.`3h`, 0D)",
        "sunrise_time": derive.epoch_time("parsed.sys.sunrise"),
        "sunset_time": derive.epoch_time("parsed.sys.sunset"),
    }
    readings = _with(parsed, parsed.columns, fields)
    return _with(readings, readings.columns, _derived("rain_fall", "sunrise_time", "sunset_time", as_of))


def enrich_located(parsed: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Readings of the located profile: coordinates kept, sun times as epochs.

    Rain is that of the last hour, else 0.
    """
    captured = ["requested_city", "status_code", "raw_response", "call_timestamp", "latency_ms", "load_date"]
    fields = MEASURES | {
        "feels_like_temperature": "parsed.main.feels_like",
        "rainfall": "coalesce(parsed.rain.`1h`, 0D)",
        "sunrise_epoch": "parsed.sys.sunrise",
        "sunset_epoch": "parsed.sys.sunset",
    }
    readings = _with(parsed, captured, fields)
    rise, fall = derive.epoch_time("sunrise_epoch"), derive.epoch_time("sunset_epoch")
    return _with(readings, readings.columns, _derived("rainfall", rise, fall, as_of))
