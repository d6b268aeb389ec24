"""Captured API responses: requests and the landing zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import derive
from skyledger.functions.rules import BROKEN_LINE_STATUS
from skyledger.schemas import CAPTURE_DDL

# Fixed value: the feed every bronze row is stamped with.
FEED = "openweather_api"

STAMPS = ("ingestion_time", "load_date", "batch_id", "source")

def plan_requests(cities: DataFrame, base_url: str, units: str = "metric", encode: bool = True) -> DataFrame:
    """One row for each city with its request address, which holds no key."""
    return cities.select(
        "requested_city",
        derive.request_url("requested_city", base_url, units, encode=encode).alias("url"),
    )


def capture_rows(spark: SparkSession, rows: list) -> DataFrame:
    """Captures from local rows; the schema is declared, so rows may be none or all null."""
    return spark.createDataFrame(rows, CAPTURE_DDL)


LANDED_DDL = f"{CAPTURE_DDL}, broken_line string"
_LANDED = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_line"}


def settled(landed: DataFrame) -> DataFrame:
    """Captures from landed lines; no text is lost.

    A call without a status never reached the API and has status 0. A line that is no
    capture, or not of the declared types, keeps its whole text as the body, under a
    status of its own.
    """
    return landed.selectExpr(
        "requested_city",
        f"if(broken_line IS NULL, coalesce(status_code, 0L), {BROKEN_LINE_STATUS}L) AS status_code",
        "coalesce(broken_line, raw_response) AS raw_response",
        "call_timestamp",
        "latency_ms",
    )


def land(captures: DataFrame, path: str) -> None:
    """Append captures to a landing zone as JSON lines, times to the microsecond."""
    captures.write.mode("append").json(path, timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Landing zone of JSON lines, one capture each."""
    return settled(spark.read.schema(LANDED_DDL).options(**_LANDED).json(path))


def stream_captures(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The landing zone as a stream; options as of the file source."""
    return settled(spark.readStream.schema(LANDED_DDL).options(**_LANDED, **options).json(path))


def stamp(captures: DataFrame, as_of: datetime | str | None = None, feed: str = FEED) -> DataFrame:
    """Bronze rows: captures with ingestion time, load date, batch id and feed."""
    now = derive.moment(as_of)
    return captures.selectExpr(
        *[f"`{name}`" for name in captures.columns if name not in STAMPS],
        f"{now} AS ingestion_time",
        f"CAST({now} AS DATE) AS load_date",
        f"date_format({now}, 'yyyyMMddHHmmss') AS batch_id",
    ).withColumn("source", F.lit(feed))
