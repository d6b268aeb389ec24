"""Derived values, each a built-in SQL expression."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band limits, severity weights and alert limits.
COLD_BELOW = 15
NORMAL_UP_TO = 30
HOT_UP_TO = 40
SEVERITY_POINTS = {"temperature": (40, 3), "rain": (30, 2), "wind": (40, 2)}
HEATWAVE_SCORE = 4
HIGH_WIND_ABOVE = 50
HEAVY_RAIN_ABOVE = 50


def moment(as_of: datetime | str | None) -> str:
    """``as_of`` as a timestamp; the time of the query when it is None.

    A time without zone is read in the session's zone.
    """
    if as_of is None:
        return "current_timestamp()"
    at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    return f"TIMESTAMP_LTZ '{at.isoformat(sep=' ')}'"


def request_url(
    city: str,
    base_url: str,
    units: str = "metric",
    api_key: str | None = None,
    encode: bool = True,
) -> Column:
    """Request address of one city; without ``api_key`` the key is left out.

    Form encoding keeps ``~`` and escapes ``*``; ``url_encode`` does the
    reverse for these two, hence the replacements. A column, as it holds
    texts from outside.
    """
    name = F.expr(f"replace(replace(url_encode({city}), '*', '%2A'), '%7E', '~')" if encode else city)
    key = f"&appid={api_key}" if api_key else ""
    return F.concat(F.lit(f"{base_url}?q="), name, F.lit(f"{key}&units={units}"))


def epoch_time(seconds: str) -> str:
    """Epoch seconds as a timestamp, right in every zone and in DST folds."""
    return f"timestamp_seconds({seconds})"


def temperature_band(temperature: str) -> str:
    """Cold, Normal, Hot or Extreme; null and NaN are Extreme."""
    return f"""CASE WHEN {temperature} < {COLD_BELOW} THEN 'Cold'
        WHEN {temperature} <= {NORMAL_UP_TO} THEN 'Normal'
        WHEN {temperature} <= {HOT_UP_TO} THEN 'Hot'
        ELSE 'Extreme' END"""


def severity_score(temperature: str, rain: str, wind: str) -> str:
    """Points for each limit passed; an unknown measure scores nothing."""
    measures = {"temperature": temperature, "rain": rain, "wind": wind}
    return " + ".join(
        f"CASE WHEN {measures[name]} > {limit} THEN {points} ELSE 0 END"
        for name, (limit, points) in SEVERITY_POINTS.items()
    )


def daytime(at: str, sunrise: str, sunset: str) -> str:
    """Whether ``at`` lies in sunrise..sunset, ends included; null if a bound is."""
    return f"""CASE WHEN {sunrise} IS NOT NULL AND {sunset} IS NOT NULL
        THEN {at} BETWEEN {sunrise} AND {sunset} END"""


def alert_type(
    severity: str,
    condition: str,
    wind: str,
    rain: str,
    heatwave_score: int = HEATWAVE_SCORE,
    high_wind_above: float = HIGH_WIND_ABOVE,
    heavy_rain_above: float = HEAVY_RAIN_ABOVE,
) -> str:
    """First alert that applies, else null.

    A score of 4 can come from rain and wind alone; it is a heatwave all the
    same, and heat alone (3) is none. Raise or lower ``heatwave_score`` for
    other readings of the term.
    """
    return f"""CASE WHEN {severity} >= {heatwave_score} THEN 'heatwave'
        WHEN contains(lower({condition}), 'storm') OR contains(lower({condition}), 'thunder') THEN 'storm'
        WHEN {wind} > {high_wind_above} THEN 'high_wind'
        WHEN {rain} > {heavy_rain_above} THEN 'heavy_rain' END"""


def stale(latest_success: str, as_of: str, within: str = "1 HOUR", never: bool = False) -> str:
    """Whether the latest success is older than ``within``; ``never`` if there is none."""
    return f"coalesce({latest_success} < {as_of} - INTERVAL {within}, {never})"


def broken_json(body: str) -> str:
    """Whether a body is present but not JSON text."""
    return f"({body} IS NOT NULL AND try_parse_json({body}) IS NULL)"
