"""The tables users read, from clean readings and from raw calls."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import derive
from skyledger.functions.rules import BROKEN_LINE_STATUS
from skyledger.operators.latest import AT, BODY_HASH, Period, latest_per_key, since_latest, with_body_hash


def city_current(clean: DataFrame, period: Period | None = None) -> DataFrame:
    """The latest reading of each city."""
    return latest_per_key(with_body_hash(clean), period=period)


def recent_readings(
    clean: DataFrame, hours: float = 24, period: Period | None = None, newest: Column | None = None
) -> DataFrame:
    """All readings of the last ``hours`` of data."""
    return since_latest(clean, hours, period, newest).drop(BODY_HASH)


def hourly_summary(
    clean: DataFrame, hours: float = 24, period: Period | None = None, newest: Column | None = None
) -> DataFrame:
    """Averages of each city and hour over the last ``hours`` of data."""
    return (
        since_latest(clean, hours, period, newest)
        .groupBy("city", F.date_trunc("hour", AT).alias("event_hour_start"))
        .agg(
            F.count("*").alias("n_readings"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("wind_speed").alias("avg_wind_speed"),
            F.sum("rain_fall").alias("total_rainfall"),
        )
    )


#: Sums, counts and maxima that merge: of two sets of readings, those of both together.
HOUR_MEASURES = ("temperature", "humidity", "wind_speed")


def hourly_parts(clean: DataFrame) -> DataFrame:
    """What the hourly averages are made of, for each city and hour of some readings."""
    return clean.groupBy("city", F.date_trunc("hour", AT).alias("event_hour_start")).agg(
        F.count("*").alias("n_readings"),
        *[F.sum(F.col(m).cast("double")).alias(f"{m}_sum") for m in HOUR_MEASURES],
        *[F.count(m).alias(f"{m}_n") for m in HOUR_MEASURES],
        F.sum("rain_fall").alias("total_rainfall"),
    )


def hourly_from_parts(parts: DataFrame) -> DataFrame:
    """The averages of :func:`hourly_summary` from any parts of its readings."""
    sums = ["n_readings", *[f"{m}_{x}" for m in HOUR_MEASURES for x in ("sum", "n")], "total_rainfall"]
    merged = parts.groupBy("city", "event_hour_start").agg(*[F.sum(name).alias(name) for name in sums])
    return merged.selectExpr(
        "city",
        "event_hour_start",
        "n_readings",
        *[f"{m}_sum / nullif({m}_n, 0) AS avg_{m}" for m in HOUR_MEASURES],
        "total_rainfall",
    )


def _time_of_peak(measure: str, latest_wins: bool) -> Column:
    order = f"struct({measure}, {AT})" if latest_wins else measure
    # rows without the measure must not count as a peak
    return F.expr(f"max_by({AT}, {order}) FILTER (WHERE {measure} IS NOT NULL)")


def daily_extremes(clean: DataFrame, latest_wins: bool = True) -> DataFrame:
    """Highs, lows and peak times of each city and day.

    Of equal peaks the latest is named. A pair cannot sit in a hash
    aggregation buffer, so that costs a local sort; ``latest_wins=False``
    names any of them and aggregates by hash, about twice as fast.
    Either way tasks send one row of a group to the shuffle.
    """
    return clean.groupBy("city", "event_date").agg(
        F.max("temperature").alias("max_temp"),
        _time_of_peak("temperature", latest_wins).alias("max_temp_time"),
        F.min("temperature").alias("min_temp"),
        F.max("wind_speed").alias("peak_wind"),
        _time_of_peak("wind_speed", latest_wins).alias("peak_wind_time"),
        F.sum("rain_fall").alias("total_rainfall"),
        F.max("weather_severity_score").alias("max_severity"),
    )


def severe_alerts(
    clean: DataFrame, hours: float = 2, period: Period | None = None, newest: Column | None = None, **limits: float
) -> DataFrame:
    """The latest alerting reading of each city in the last ``hours`` of data.

    Ranking comes after the alert filter: a calm reading does not hide an
    earlier alert. ``limits`` go to :func:`skyledger.functions.derive.alert_type`.
    """
    alert = derive.alert_type("weather_severity_score", "weather_condition", "wind_speed", "rain_fall", **limits)
    recent = since_latest(with_body_hash(clean), hours, period, newest)
    alerting = recent.selectExpr("*", f"{alert} AS alert_type").where("alert_type IS NOT NULL")
    return latest_per_key(alerting).selectExpr(
        "city",
        AT,
        "temperature",
        "wind_speed",
        "rain_fall AS rainfall",
        "weather_condition",
        "weather_severity_score",
        "alert_type",
        f"{AT} AS alert_triggered_at",
    )


_OK = "status_code = 200"


def _call_facts(bronze: DataFrame, stored: bool, count_malformed: bool) -> DataFrame:
    """What health asks of each call; ``call`` is 0 in rows that only add a fact.

    Broken lines of the landing zone are no calls.
    """
    bronze = bronze.where(f"NOT (status_code <=> {BROKEN_LINE_STATUS})")
    keys = [F.col("requested_city").alias("city"), F.col("load_date")]
    broken = f"if({_OK} AND {derive.broken_json('raw_response')}, 1L, 0L)" if count_malformed else "0L"
    missing = f"{_OK} AND raw_response IS NULL"

    def facts(rows: DataFrame, *values: str) -> DataFrame:
        names = ["status_code", "latency_ms", "ingestion_time", "bodiless", "malformed", "call"]
        return rows.select(*keys, *[F.expr(f"{v} AS {n}") for v, n in zip(values, names, strict=True)])

    call = ("status_code", "latency_ms", "ingestion_time")
    if not stored:
        return facts(bronze, *call, f"if({missing}, 1L, 0L)", broken, "1L")
    calls = facts(bronze, *call, "0L", broken, "1L")
    return calls.unionAll(facts(bronze.where(missing), "NULL", "NULL", "NULL", "1L", "0L", "0L"))


def api_health(
    bronze: DataFrame,
    as_of: datetime | str | None = None,
    stale_after: str = "1 HOUR",
    never_succeeded_is_stale: bool = False,
    count_malformed: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Call counts, latency and freshness of each requested city and load date.

    ``parse_errors`` are successful calls without a body. With ``stored`` they
    are looked up by a scan of their own, which skips the bodies of all row
    groups and pages without a null; the counts come from narrow columns. For
    a table of bodies that is nearly all there is to save, for a frame that
    has to be computed twice it is not. ``count_malformed`` adds
    ``malformed_bodies``, successful calls whose body is not JSON, and reads
    all bodies. A call without status is neither successful nor failed.
    """
    parts = health_parts(bronze, count_malformed, stored)
    return health_from_parts(parts, as_of, stale_after, never_succeeded_is_stale)


def health_parts(bronze: DataFrame, count_malformed: bool = False, stored: bool = False) -> DataFrame:
    """What API health is made of, for each requested city and load date of some calls."""
    malformed = [F.sum("malformed").alias("malformed_bodies")] if count_malformed else []
    return _call_facts(bronze, stored, count_malformed).groupBy("city", "load_date").agg(
        F.sum("call").alias("total_calls"),
        F.expr(f"count_if({_OK}) AS successful_calls"),
        F.expr("count_if(status_code <> 200) AS failed_calls"),
        F.sum("bodiless").alias("parse_errors"),
        F.sum("latency_ms").alias("latency_sum"),
        F.count("latency_ms").alias("latency_n"),
        F.expr(f"max(ingestion_time) FILTER (WHERE {_OK}) AS latest_success_time"),
        *malformed,
    )


def health_from_parts(
    parts: DataFrame,
    as_of: datetime | str | None = None,
    stale_after: str = "1 HOUR",
    never_succeeded_is_stale: bool = False,
) -> DataFrame:
    """API health from any parts of its calls (:func:`health_parts`)."""
    counts = ["total_calls", "successful_calls", "failed_calls", "parse_errors", "latency_sum", "latency_n"]
    counts += [name for name in ("malformed_bodies",) if name in parts.columns]
    calls = parts.groupBy("city", "load_date").agg(
        *[F.sum(name).alias(name) for name in counts], F.max("latest_success_time").alias("latest_success_time")
    )
    latency = "round(latency_sum / nullif(latency_n, 0), 2) AS avg_latency_ms"
    calls = calls.selectExpr("* EXCEPT (latency_sum, latency_n)", latency)
    stale = derive.stale("latest_success_time", derive.moment(as_of), stale_after, never_succeeded_is_stale)
    return calls.selectExpr(
        "* EXCEPT (latest_success_time)",
        "round(successful_calls / total_calls * 100, 2) AS success_rate",
        f"{stale} AS is_stale",
    )
