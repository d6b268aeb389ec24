"""The driver's ``events`` table as captured API responses.

One text that Spark and other SQL engines run alike. It yields every
reachable quarantine reason, all alert types, bands and severity values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CITY = """CASE user_id % 11 WHEN 3 THEN 'Old Town ' || CAST(user_id AS STRING)
   WHEN 5 THEN 'Ash~Elm*Oak&' || CAST(user_id AS STRING) ELSE 'city_' || CAST(user_id AS STRING) END"""

# One row in seven is told by the day alone, so a city has readings of equal time.
_AT = "(1704067200 + event_id * 258 - CASE WHEN event_id % 7 = 0 THEN (event_id * 258) % 86400 ELSE 0 END)"
_DAY = "(1704067200 + event_id * 258 - (event_id * 258) % 86400)"

CAPTURES_SQL = f"""
SELECT event_id,
 {_CITY} AS requested_city,
 CAST(CASE WHEN event_id % 37 = 0 THEN 404 WHEN event_id % 59 = 0 THEN 0 WHEN event_id % 61 = 0 THEN NULL
   ELSE 200 END AS BIGINT) AS status_code,
 CASE WHEN event_id % 59 = 0 OR event_id % 53 = 0 THEN NULL
      WHEN event_id % 47 = 0 THEN ''
      WHEN event_id % 43 = 0 THEN '{{"name":"x", oops'
      WHEN event_id % 37 = 0 THEN '{{"cod":"404","message":"nothing here"}}'
 ELSE '{{' || CASE WHEN event_id % 71 = 0 THEN '' ELSE '"coord":{{"lon":' || CAST(event_id % 360 - 180 AS STRING) ||
   '.5,"lat":' || CAST(event_id % 180 - 90 AS STRING) || '.25}},' END ||
   CASE WHEN event_id % 73 = 0 THEN '"weather":[],' ELSE '"weather":[{{"id":' || CAST(500 + event_id % 300 AS STRING) ||
   ',"main":"' ||
   CASE event_id % 4 WHEN 0 THEN 'Clouds' WHEN 1 THEN 'Clear' WHEN 2 THEN 'Thunderstorm' ELSE 'Rain' END ||
   '","description":"sky ' || CAST(event_id % 9 AS STRING) || '","icon":"7n"}}],' END ||
   '"base":"mast ' || CAST(event_id % 3 AS STRING) || '","main":{{' ||
   CASE WHEN event_id % 29 = 0 THEN '' ELSE '"temp":' || CAST((event_id * 7919) % 125 - 58 AS STRING) || '.5,' END ||
   CASE WHEN event_id % 5 = 0 THEN '' ELSE '"feels_like":' || CAST((event_id * 7919) % 125 - 60 AS STRING) || '.25,' END ||
   CASE WHEN event_id % 31 = 0 THEN '' ELSE '"humidity":' || CAST((event_id * 31) % 110 - 4 AS STRING) || ',' END ||
   '"temp_min":' || CAST((event_id * 7919) % 125 - 61 AS STRING) || '.5,"temp_max":' ||
   CAST((event_id * 7919) % 125 - 55 AS STRING) || '.75,"sea_level":' || CAST(980 + event_id % 60 AS STRING) ||
   ',"grnd_level":' || CAST(940 + event_id % 50 AS STRING) || ',"pressure":' || CAST(970 + event_id % 70 AS STRING) ||
   '}},' || CASE WHEN event_id % 17 = 0 THEN '' ELSE '"visibility":' || CAST((event_id * 13) % 9000 AS STRING) || ',' END ||
   '"wind":{{"speed":' || CAST((event_id * 17) % 60 - 2 AS STRING) || '.25,"deg":' || CAST(event_id % 360 AS STRING) ||
   ',"gust":' || CAST(event_id % 80 AS STRING) || '.5}},' ||
   CASE event_id % 3 WHEN 0 THEN '"rain":{{"1h":' || CAST((event_id * 13) % 70 AS STRING) || '.5}},'
                     WHEN 1 THEN '"rain":{{"3h":' || CAST((event_id * 11) % 70 AS STRING) || '.5}},' ELSE '' END ||
   '"clouds":{{"all":' || CAST(event_id % 101 AS STRING) || '}},' ||
   CASE WHEN event_id % 23 = 0 THEN '' ELSE '"dt":' || CAST({_AT} AS STRING) || ',' END ||
   '"sys":{{"type":' || CAST(event_id % 4 AS STRING) || ',"id":' || CAST(event_id % 9999 AS STRING) || ',"country":"' ||
   CASE event_id % 3 WHEN 0 THEN 'NZ' WHEN 1 THEN 'PE' ELSE 'FI' END || '"' ||
   CASE WHEN event_id % 19 = 0 THEN '' ELSE ',"sunrise":' || CAST({_DAY} + 22500 AS STRING) ||
   ',"sunset":' || CAST({_DAY} + 66600 AS STRING) END || '}},"timezone":' ||
   CAST((event_id % 25 - 12) * 3600 AS STRING) || ',"id":' || CAST(7000000 + user_id AS STRING) || ',' ||
   CASE WHEN event_id % 41 = 0 THEN '' WHEN event_id % 67 = 0 THEN '"name":" ",' ELSE '"name":"' || {_CITY} || '",' END ||
   '"cod":200}}'
 END AS raw_response,
 CASE WHEN event_id % 7 = 0 THEN date_trunc('day', ts) ELSE ts END AS call_timestamp,
 CAST((event_id * 37) % 900 AS BIGINT) AS latency_ms,
 ts AS ingestion_time, CAST(ts AS DATE) AS load_date
FROM {{events}}
"""


def captures_from(events: DataFrame) -> DataFrame:
    """Captures with ``event_id`` kept as a row key; times zoned in the session's zone."""
    # the text's own braces are JSON, so the table goes in as a view name
    events.createOrReplaceTempView("skyledger_event_feed")
    rows = events.sparkSession.sql(CAPTURES_SQL.replace("{events}", "skyledger_event_feed"))
    return rows.withColumns(
        {name: F.col(name).cast("timestamp") for name in ("call_timestamp", "ingestion_time")}
    )


# A body costs about a hundred times the bytes of its event, and a parse after that.
ROWS_PER_TASK = 50_000


def spread(events: DataFrame, rows_per_task: int) -> DataFrame:
    """The events in even parts, in the order of their ids.

    A scan has at most a task for each row group, which may hold a million events: bytes
    enough for no second task, but bodies for minutes of one. The order keeps calls that are
    near in time together, for tables stored by time. The count comes from the footers.
    """
    tasks = -(-events.count() // rows_per_task)
    return events.repartitionByRange(tasks, "event_id") if tasks > 1 else events


def read_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl = "event_id bigint, ts timestamp_ntz, user_id bigint"
    events = spark.read.schema(ddl).parquet(f"{sf_dir}/events.parquet")
    return captures_from(spread(events, ROWS_PER_TASK))
