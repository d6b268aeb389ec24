"""

All queries start from the ``events`` table, read as captured API responses
(:mod:`skyledger.sources.event_feed`), and run over all of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import derive
from skyledger.operators import audit, enrich, parse, products, quality
from skyledger.plans import bronze, gold, recent, silver
from skyledger.schemas import AUDIT_DDL, BRONZE_DDL, CAPTURE_DDL, READING_DDL, column_names
from skyledger.session import bound_listing, bound_methods, even_scans, pin_utc, shared_dir
from skyledger.sources import captures, event_feed, tables
from skyledger.streaming import bronze as stream_bronze
from skyledger.streaming import current as stream_current
from skyledger.streaming import silver as stream_silver

AS_OF = "2025-01-01 00:00:00"
NEXT_DAY = "2025-01-02 00:00:00"
EARLY = "2024-01-03 00:00:00"
# about two days of events in four
EVERY_OTHER_DAY = "event_id % 670 < 335"
# total, so that its negation has the other rows
EARLY_HALF = "coalesce(latency_ms, 0) < 300"
BATCH_BYTES = str(256 << 20)
BASE_URL = "https://api.example.org/data/2.5/weather"

Query = Callable[[SparkSession, str], DataFrame]

# Where the payload holds what no column of a reading does.
PAYLOAD_EXTRAS = {
    "base": "base",
    "temp_min": "main.temp_min",
    "temp_max": "main.temp_max",
    "sea_level": "main.sea_level",
    "grnd_level": "main.grnd_level",
    "wind_deg": "wind.deg",
    "wind_gust": "wind.gust",
    "cloudiness": "clouds.all",
    "sys_type": "sys.type",
    "sys_id": "sys.id",
    "utc_offset": "timezone",
    "place_id": "id",
    "cod": "cod",
}


# -- inputs -------------------------------------------------------------------


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_feed.read_captures(even_scans(bound_methods(bound_listing(pin_utc(spark)))), sf_dir)


def _checked(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return silver.checked_readings(_captures(spark, sf_dir), AS_OF, **options)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_rows(_checked(spark, sf_dir))


def _checked_located(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    return silver.checked_located(_captures(spark, sf_dir), as_of)


def _bronze_table(spark: SparkSession, sf_dir: str) -> str:
    """Captures through the landing zone into a bronze table; returns its path."""
    landing, table = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    captures.land(_captures(spark, sf_dir).select(*column_names(CAPTURE_DDL)), landing)
    bronze.ingest(spark, landing, table, AS_OF)
    return table


def _streamed_store(spark: SparkSession, sf_dir: str) -> silver.SilverStore:
    """Bronze files in micro-batches through the silver stream."""
    source, store = _bronze_files(spark, sf_dir), _new_store(spark)
    stream_silver.drain(source, store, AS_OF)
    return store


def _new_space(spark: SparkSession) -> str:
    """A schema of its own for the tables of one query."""
    space = f"run_{uuid.uuid4().hex[:8]}"
    tables.create_layers(spark, [space], shared_dir(spark, "catalog"))
    return space


def _new_store(spark: SparkSession, unit: str = "month") -> silver.SilverStore:
    # the feed has a few hundred readings a day
    return silver.SilverStore(f"run_{uuid.uuid4().hex[:8]}", shared_dir(spark, "silver"), unit)


def _bronze_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "bronze")
    rows = captures.stamp(_captures(spark, sf_dir), AS_OF).select(*column_names(BRONZE_DDL))
    rows.write.parquet(path)
    return tables.stream(spark, path, BRONZE_DDL, maxBytesPerTrigger=BATCH_BYTES)


def _batch_store(spark: SparkSession, sf_dir: str) -> silver.SilverStore:
    store = _new_store(spark)
    silver.write_batch(_captures(spark, sf_dir), store, 0, AS_OF, cluster=True)
    return store


# -- raw responses ------------------------------------------------------------


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.read(spark, _bronze_table(spark, sf_dir))


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table by name: typed DDL, then an append."""
    name = f"{_new_space(spark)}.calls"
    rows = captures.stamp(_captures(spark, sf_dir), AS_OF).select(*column_names(BRONZE_DDL))
    tables.create_table(spark, name, BRONZE_DDL, ["load_date"])
    tables.append_table(rows, name, ["load_date"])
    return spark.table(name)


def landing_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines of which some break off, as bronze keeps them and why silver does not."""
    landing, table = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    rows = _captures(spark, sf_dir)
    captures.land(rows.where("event_id % 13 <> 0").select(*column_names(CAPTURE_DDL)), landing)
    line = "concat('{\"requested_city\":\"', requested_city, '\",\"latency_ms\":', latency_ms) AS value"
    rows.where("event_id % 13 = 0").selectExpr(line).write.mode("append").text(landing)
    bronze.ingest(spark, landing, table, AS_OF)
    kept = silver.checked_readings(bronze.read(spark, table), AS_OF)
    broken = "if(quarantine_reason = 'landing_broken', quarantine_reason, NULL) AS broken"
    return kept.selectExpr("requested_city", "status_code", "raw_response", "latency_ms", broken)


def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = _captures(spark, sf_dir).select("requested_city").distinct()
    return captures.plan_requests(cities, BASE_URL)


def parse_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.route(_captures(spark, sf_dir)).select("event_id", "route")


def parse_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = parse.route(_captures(spark, sf_dir)).groupBy("route")
    return routes.agg(F.count("*").alias("row_count"), F.sum("latency_ms").alias("latency_ms"))


# -- readings -----------------------------------------------------------------


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(parse.parse_payload(_captures(spark, sf_dir), READING_DDL), AS_OF).drop("parsed")


def enriched_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_located(parse.split_routes(_captures(spark, sf_dir)).parsed, AS_OF)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantined_rows(_checked(spark, sf_dir))


def quarantine_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reason_counts(_checked(spark, sf_dir, strict_json=True))


def rules_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _checked_located(spark, sf_dir, AS_OF)
    return rows.select("requested_city", "call_timestamp", "event_time", quality.REASON)


def rules_located_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged from an early time, when most readings lie in the future."""
    return audit.reason_counts(_checked_located(spark, sf_dir, EARLY))


# -- counts -------------------------------------------------------------------


def breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reason_counts(quality.quarantined_rows(_checked(spark, sf_dir)))


def breakdown_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.breakdown_json(_checked(spark, sf_dir))


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_row(_checked(spark, sf_dir), AS_OF)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.run_summary(_checked_located(spark, sf_dir, AS_OF), AS_OF)


def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ["temperature_band", "weather_severity_score", "is_daytime"]
    return _clean(spark, sf_dir).groupBy(*groups).agg(F.count("*").alias("row_count"))


# -- products -----------------------------------------------------------------


def city_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.city_current(_clean(spark, sf_dir))


def _recent(spark: SparkSession, sf_dir: str, hours: float) -> DataFrame:
    """Readings that hold the last hours, each body parsed once."""
    return recent.stage_recent(_captures(spark, sf_dir), shared_dir(spark, "recent"), hours, AS_OF)


def recent_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.recent_readings(_recent(spark, sf_dir, 24))


def hourly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.hourly_summary(_recent(spark, sf_dir, 24))


def daily_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.daily_extremes(_clean(spark, sf_dir))


def severe_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.severe_alerts(_recent(spark, sf_dir, 2))


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = derive.alert_type("weather_severity_score", "weather_condition", "wind_speed", "rain_fall")
    alerts = _clean(spark, sf_dir).selectExpr("event_id", "city", f"{kind} AS alert_type")
    return alerts.where("alert_type IS NOT NULL")


def api_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.api_health(_captures(spark, sf_dir), AS_OF)


def api_health_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = products.api_health(
        _captures(spark, sf_dir), AS_OF, never_succeeded_is_stale=True, count_malformed=True
    )
    return health.select("city", "load_date", "malformed_bodies", "is_stale")


# -- the stored route ---------------------------------------------------------


def store_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest times first, whole rows from the periods that hold one."""
    store = _batch_store(spark, sf_dir)
    return products.city_current(store.clean(spark, keep_period=True), store.period)


def store_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2 h bound from the period log; other periods are not read."""
    store = _batch_store(spark, sf_dir)
    clean = store.clean(spark, keep_period=True)
    return products.severe_alerts(clean, period=store.period, newest=store.newest(spark))


def store_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 24 h bound from the period log prunes the periods."""
    store = _batch_store(spark, sf_dir)
    clean = store.clean(spark, keep_period=True)
    return products.recent_readings(clean, period=store.period, newest=store.newest(spark))


def store_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _batch_store(spark, sf_dir)
    clean = store.clean(spark, keep_period=True)
    return products.hourly_summary(clean, period=store.period, newest=store.newest(spark))


def refreshed_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch replaced by one of fewer days: its other days go."""
    store, table = _new_store(spark, "day"), shared_dir(spark, "extremes")
    rows = _captures(spark, sf_dir)
    for part in (rows, rows.where(EVERY_OTHER_DAY)):
        silver.write_batch(part, store, 0, AS_OF, cluster=True)
        gold.refresh_daily_extremes(spark, store, 0, table)
    return gold.read_daily_extremes(spark, table)


def published_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product published again with a column more, and once in vain."""
    name, place = f"{_new_space(spark)}.city_current", shared_dir(spark, "current")
    latest = products.city_current(_clean(spark, sf_dir)).select("city", "event_time", "temperature")
    tables.publish(latest, name, place)
    tables.publish(spark.table(name).withColumn("is_hot", F.expr("temperature > 30")), name, place, replace_schema=True)
    try:
        tables.publish(latest, name, place)
    except ValueError:
        return spark.table(name)
    raise AssertionError("columns were lost")


def named_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store by its names in the catalog: empty before the first batch, then with its rows."""
    store = _new_store(spark)
    store.create(spark)
    before = spark.table(f"{store.namespace}.quarantine").count()
    silver.write_batch(_captures(spark, sf_dir), store, 0, AS_OF, cluster=True)
    return spark.table(f"{store.namespace}.quarantine").where(F.lit(before == 0))


def named_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean readings by name, from another session than the one that wrote them."""
    store = _batch_store(spark, sf_dir)
    return pin_utc(spark.newSession()).table(f"{store.namespace}.clean")


def named_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _batch_store(spark, sf_dir)
    return spark.newSession().sql(f"SELECT * FROM {store.namespace}.audit")


def clean_with_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the payload has beyond the columns of a reading."""
    rows = quality.clean_rows(_checked(spark, sf_dir, keep_parsed=True))
    fields = [f"parsed.{path} AS {name}" for name, path in PAYLOAD_EXTRAS.items()]
    return rows.selectExpr("event_id", *fields)


def evolved_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch with a column more: null in the rows of the first."""
    store, rows = _new_store(spark), _captures(spark, sf_dir)
    silver.write_batch(rows.where(EARLY_HALF), store, 0, AS_OF, cluster=True)
    later = rows.where(f"NOT ({EARLY_HALF})").withColumn("station", F.lit("north"))
    silver.write_batch(later, store, 1, AS_OF, cluster=True)
    return store.clean(spark).select("event_id", "city", "event_time", "temperature", "station")


def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, compacted after the second and once more, old files gone."""
    store, rows = _new_store(spark), _captures(spark, sf_dir)
    for number in range(3):
        silver.write_batch(rows.where(f"coalesce(event_id, 0) % 3 = {number}"), store, number, AS_OF)
        if number:
            silver.compact(spark, store)
            silver.forget_replaced(spark, store)
    return store.clean(spark)


def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run again on its checkpoint, and its first batch forced once more."""
    path, store = shared_dir(spark, "bronze"), _new_store(spark)
    rows = captures.stamp(_captures(spark, sf_dir), AS_OF).select(*column_names(BRONZE_DDL))
    rows.write.parquet(path)
    for _ in range(2):
        stream_silver.drain(tables.stream(spark, path, BRONZE_DDL), store, AS_OF)
    silver.write_batch(tables.scan(spark, path, BRONZE_DDL), store, 0, AS_OF)
    return store.clean(spark)


def store_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily extremes kept up by refreshing the periods each batch touched.

    The two batches are the whole table, and periods get rows from both.
    """
    store, table = _new_store(spark), shared_dir(spark, "extremes")
    rows = _captures(spark, sf_dir)
    for number, part in enumerate([rows.where(EARLY_HALF), rows.where(f"NOT ({EARLY_HALF})")]):
        silver.write_batch(part, store, number, AS_OF, cluster=True)
        gold.refresh_daily_extremes(spark, store, number, table)
    return gold.read_daily_extremes(spark, table)


def published_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API health over the bronze table, published and read back."""
    name = f"{_new_space(spark)}.api_health"
    health = products.api_health(bronze.read(spark, _bronze_table(spark, sf_dir)), AS_OF, stored=True)
    tables.publish(health, name, shared_dir(spark, "health"))
    return spark.table(name)


# -- streams ------------------------------------------------------------------


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed captures appended to bronze by a stream."""
    landing, table = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    captures.land(_captures(spark, sf_dir).select(*column_names(CAPTURE_DDL)), landing)
    landed = captures.stream_captures(spark, landing, maxFilesPerTrigger="4")
    stream_bronze.start(landed, table, shared_dir(spark, "bronze-checkpoint"), AS_OF).awaitTermination()
    return bronze.read(spark, table)


def compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed date from the archive, an open one from bronze, each row once."""
    table, archive = shared_dir(spark, "bronze"), shared_dir(spark, "archive")
    rows = _captures(spark, sf_dir).select(*column_names(CAPTURE_DDL))
    bronze.append_captures(rows.where(EARLY_HALF), table, AS_OF)
    bronze.append_captures(rows.where(f"NOT ({EARLY_HALF})"), table, NEXT_DAY)
    bronze.compact(spark, table, archive, AS_OF[:10])
    return bronze.read_whole(spark, table, archive)


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_store(spark, sf_dir).clean(spark)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_store(spark, sf_dir).quarantine(spark)


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _streamed_store(spark, sf_dir).audit(spark)
    return log.groupBy("run_time").agg(
        *[F.sum(name).alias(name) for name in ("total_rows", "valid_rows", "quarantine_rows")],
    )


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, checkpoint = f"{_new_space(spark)}.city_current", shared_dir(spark, "current-checkpoint")
    rows = _bronze_files(spark, sf_dir)
    stream_current.start(rows, name, shared_dir(spark, "current"), checkpoint, AS_OF).awaitTermination()
    return spark.table(name)


def stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a streaming aggregation, restarted from its state for later files."""
    name, checkpoint, path = f"{_new_space(spark)}.city_current", shared_dir(spark, "state"), shared_dir(spark, "bronze")
    rows = captures.stamp(_captures(spark, sf_dir), AS_OF).select(*column_names(BRONZE_DDL))
    place = shared_dir(spark, "current")
    for part in (EARLY_HALF, f"NOT ({EARLY_HALF})"):
        tables.append(rows.where(part), path)
        source = tables.stream(spark, path, BRONZE_DDL, maxBytesPerTrigger=BATCH_BYTES)
        stream_current.start_stateful(source, name, place, checkpoint, AS_OF).awaitTermination()
    return spark.table(name)


def stream_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as a named table, read as a stream by its name, into a named store; the second
    run takes only what came after the first."""
    name, store = f"{_new_space(spark)}.calls", _new_store(spark)
    rows = captures.stamp(_captures(spark, sf_dir), AS_OF).select(*column_names(BRONZE_DDL))
    tables.create_table(spark, name, BRONZE_DDL, ["load_date"])
    for part in (EARLY_HALF, f"NOT ({EARLY_HALF})"):
        tables.append_table(rows.where(part), name, ["load_date"])
        stream_silver.drain(tables.stream_table(spark, name, maxBytesPerTrigger=BATCH_BYTES), store, AS_OF)
    return pin_utc(spark.newSession()).table(f"{store.namespace}.clean")


def audit_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts collected on the write itself."""
    rows, counts = audit.observed(_checked(spark, sf_dir))
    rows.write.parquet(shared_dir(spark, "observed"))
    return audit.observed_row(spark, counts, AS_OF)


def stream_audit_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for each micro-batch of a stream, summed."""
    name, place = f"{_new_space(spark)}.audit", shared_dir(spark, "observed")
    tables.create_table(spark, name, f"{AUDIT_DDL}, micro_batch int", ["micro_batch"], overwrites=True)

    def land(batch: DataFrame, batch_id: int) -> None:
        rows, counts = audit.observed(silver.checked_readings(batch, AS_OF))
        rows.write.mode("overwrite").parquet(f"{place}/{batch_id}")
        line = audit.observed_row(batch.sparkSession, counts, AS_OF)
        tables.insert(line.selectExpr("*", f"{batch_id} AS micro_batch"), name, overwrite=True)

    stream = _bronze_files(spark, sf_dir).writeStream.foreachBatch(land)
    stream = stream.option("checkpointLocation", shared_dir(spark, "checkpoint")).trigger(availableNow=True)
    stream.start().awaitTermination()
    counted = [F.sum(c).alias(c) for c in ("total_rows", "valid_rows", "quarantine_rows")]
    return spark.table(name).groupBy("run_time").agg(*counted)


def refreshed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API health from mergeable parts, one batch of them replaced."""
    name, rows = f"{_new_space(spark)}.health_parts", _captures(spark, sf_dir)
    gold.add_health(rows, 0, name)
    gold.add_health(rows.where(f"NOT ({EARLY_HALF})"), 1, name)
    gold.add_health(rows.where(EARLY_HALF), 0, name)
    return gold.kept_health(spark, name, AS_OF)


def refreshed_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly summary from mergeable parts, one batch of them replaced."""
    name, store, rows = f"{_new_space(spark)}.hourly_parts", _new_store(spark), _captures(spark, sf_dir)
    for number, part in ((0, "true"), (1, f"NOT ({EARLY_HALF})"), (0, EARLY_HALF)):
        silver.write_batch(rows.where(part), store, number, AS_OF, cluster=True)
        gold.add_hours(spark, store, number, name)
    return gold.kept_hours(spark, store, name)


def recreated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named table dropped, made again by its DDL and filled anew; one more reset."""
    space = _new_space(spark)
    rows = captures.stamp(_captures(spark, sf_dir), AS_OF).select(*column_names(BRONZE_DDL))
    for name in ("calls", "spare"):
        tables.create_table(spark, f"{space}.{name}", BRONZE_DDL, ["load_date"])
        tables.append_table(rows, f"{space}.{name}", ["load_date"])
    tables.drop_table(spark, f"{space}.calls")
    tables.reset(spark, tables=[f"{space}.spare"])
    tables.create_table(spark, f"{space}.calls", BRONZE_DDL, ["load_date"])
    tables.append_table(rows.where(EARLY_HALF), f"{space}.calls", ["load_date"])
    return spark.table(f"{space}.calls").where(F.lit(not spark.catalog.tableExists(f"{space}.spare")))


# -- the same in SQL ----------------------------------------------------------

# The feed's text, then readings and reasons derived from it.
_CAPTURES = f"WITH captures AS ({event_feed.CAPTURES_SQL.replace('{events}', 'events')})"

_PARSED = f"""{_CAPTURES},
parsed AS (
  SELECT *, CASE WHEN json_valid(raw_response) THEN CAST(raw_response AS JSON) END AS j,
         raw_response IS NULL OR trim(raw_response) = '' AS no_struct
  FROM captures
),
extracted AS (
  SELECT * EXCLUDE (ingestion_time), TIMESTAMP '{AS_OF}' AS ingestion_time,
    j->>'$.name' AS city,
    CAST(j->>'$.main.temp' AS DOUBLE) AS temperature,
    CAST(j->>'$.main.feels_like' AS DOUBLE) AS feels_like,
    CAST(j->>'$.main.humidity' AS INTEGER) AS humidity,
    CAST(j->>'$.main.pressure' AS INTEGER) AS pressure,
    CAST(j->>'$.wind.speed' AS DOUBLE) AS wind_speed,
    j->>'$.weather[0].main' AS weather_condition,
    j->>'$.weather[0].description' AS weather_description,
    make_timestamp(CAST(j->>'$.dt' AS BIGINT) * 1000000) AS event_time,
    CAST(j->>'$.rain."1h"' AS DOUBLE) AS rain_1h,
    CAST(j->>'$.rain."3h"' AS DOUBLE) AS rain_3h,
    CAST(j->>'$.sys.sunrise' AS BIGINT) AS sunrise_epoch,
    CAST(j->>'$.sys.sunset' AS BIGINT) AS sunset_epoch,
    j->>'$.sys.country' AS country,
    CAST(j->>'$.coord.lat' AS DOUBLE) AS latitude,
    CAST(j->>'$.coord.lon' AS DOUBLE) AS longitude,
    CAST(j->>'$.visibility' AS INTEGER) AS visibility,
    'openweathermap' AS source_system
  FROM parsed
)"""


def _reading_sql(rain: str) -> str:
    return f"""
    CAST(event_time AS DATE) AS event_date,
    CAST(hour(event_time) AS INTEGER) AS event_hour,
    CASE WHEN temperature < 15 THEN 'Cold' WHEN temperature <= 30 THEN 'Normal'
         WHEN temperature <= 40 THEN 'Hot' ELSE 'Extreme' END AS temperature_band,
    CAST(CASE WHEN temperature > 40 THEN 3 ELSE 0 END + CASE WHEN {rain} > 30 THEN 2 ELSE 0 END
         + CASE WHEN wind_speed > 40 THEN 2 ELSE 0 END AS INTEGER) AS weather_severity_score,
    CASE WHEN sunrise_epoch IS NOT NULL AND sunset_epoch IS NOT NULL
         THEN event_time >= make_timestamp(sunrise_epoch * 1000000)
          AND event_time <= make_timestamp(sunset_epoch * 1000000) END AS is_daytime"""


_ENRICHED = f"""{_PARSED},
rained AS (
  SELECT *, coalesce(rain_1h, rain_3h, 0.0) AS rain_fall,
         make_timestamp(sunrise_epoch * 1000000) AS sunrise_time,
         make_timestamp(sunset_epoch * 1000000) AS sunset_time
  FROM extracted
),
enriched AS (SELECT *, {_reading_sql("rain_fall")} FROM rained),
checked AS (
  SELECT *, CASE
    WHEN status_code IS DISTINCT FROM 200 THEN 'api_failed'
    WHEN raw_response IS NULL THEN 'raw_json_missing'
    WHEN no_struct THEN 'json_parse_failed'
    WHEN city IS NULL THEN 'city_missing'
    WHEN temperature IS NULL THEN 'temperature_missing'
    WHEN temperature < -50 OR temperature > 60 THEN 'out_of_range_temperature'
    WHEN humidity IS NULL THEN 'humidity_missing'
    WHEN humidity < 0 OR humidity > 100 THEN 'out_of_range_humidity'
    WHEN wind_speed < 0 THEN 'out_of_range_wind_speed'
    WHEN event_time IS NULL THEN 'event_time_missing'
    WHEN rain_fall IS NULL THEN 'rain_fall_missing' END AS quarantine_reason
  FROM enriched
),
clean AS (SELECT * FROM checked WHERE quarantine_reason IS NULL),
alerting AS (
  SELECT *, CASE
    WHEN weather_severity_score >= 4 THEN 'heatwave'
    WHEN contains(lower(weather_condition), 'storm') THEN 'storm'
    WHEN contains(lower(weather_condition), 'thunder') THEN 'storm'
    WHEN wind_speed > 50 THEN 'high_wind'
    WHEN rain_fall > 50 THEN 'heavy_rain' END AS alert_type
  FROM clean
)"""

_CAPTURED = "requested_city, status_code, raw_response, call_timestamp, latency_ms"
_READING = f"""{_CAPTURED}, load_date, ingestion_time, city, temperature, feels_like, humidity,
  pressure, wind_speed, weather_condition, weather_description, event_time, rain_fall, event_date,
  event_hour, temperature_band, weather_severity_score, sunrise_time, sunset_time, is_daytime,
  source_system, country, latitude, longitude, visibility"""


def _located(as_of: str) -> str:
    return f"""{_PARSED},
rained AS (SELECT *, coalesce(rain_1h, 0.0) AS rainfall FROM extracted),
located AS (
  SELECT *, {_reading_sql("rainfall")} FROM rained
  WHERE status_code = 200 AND j IS NOT NULL AND city IS NOT NULL AND event_time IS NOT NULL
    AND temperature IS NOT NULL
),
checked AS (
  SELECT *, CASE
    WHEN status_code IS DISTINCT FROM 200 THEN 'api_error'
    WHEN city IS NULL OR trim(city) = '' THEN 'null_city'
    WHEN temperature < -50 OR temperature > 60 THEN 'out_of_range_temperature'
    WHEN humidity < 0 OR humidity > 100 THEN 'out_of_range_humidity'
    WHEN wind_speed < 0 THEN 'out_of_range_wind_speed'
    WHEN latitude IS NULL OR longitude IS NULL THEN 'missing_coordinates'
    WHEN event_time > TIMESTAMP '{as_of}' + INTERVAL 1 HOUR THEN 'future_event_time' END AS quarantine_reason
  FROM located
)"""


def _breakdown_sql(counts: str) -> str:
    return f"""(SELECT '{{' || coalesce(string_agg('"' || quarantine_reason || '":' || n, ',' ORDER BY quarantine_reason), '')
      || '}}' FROM (SELECT quarantine_reason, count(*) AS n FROM {counts}
      WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason))"""


_ROUTES = f"""{_PARSED},
routed AS (
  SELECT event_id, latency_ms, CASE WHEN status_code IS DISTINCT FROM 200 THEN 'api_error'
    WHEN city IS NOT NULL AND event_time IS NOT NULL AND temperature IS NOT NULL THEN 'parsed'
    ELSE 'unparseable' END AS route
  FROM extracted
)"""

_REASON_COUNTS = "SELECT quarantine_reason, count(*) AS row_count FROM checked"

_STAMPED = f"""{_CAPTURED}, TIMESTAMP '{AS_OF}' AS ingestion_time, CAST(TIMESTAMP '{AS_OF}' AS DATE) AS load_date,
  strftime(TIMESTAMP '{AS_OF}', '%Y%m%d%H%M%S') AS batch_id, 'openweather_api' AS source"""

# as the landing zone hands them on: a call without a status has status 0
_LANDED = _STAMPED.replace("status_code", "coalesce(status_code, 0) AS status_code")

_COUNTS = """CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) FILTER (WHERE quarantine_reason IS NULL) AS BIGINT) AS valid_rows,
  CAST(count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS BIGINT) AS quarantine_rows"""


def _current(columns: str) -> str:
    return f"""{_ENRICHED}
SELECT {columns} FROM clean
QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_time DESC, call_timestamp DESC, md5(raw_response) DESC) = 1"""


_ALERTS = f"""{_ENRICHED}
SELECT city, event_time, temperature, wind_speed, rain_fall AS rainfall, weather_condition,
  weather_severity_score, alert_type, event_time AS alert_triggered_at
FROM alerting
WHERE alert_type IS NOT NULL AND event_time >= (SELECT max(event_time) FROM clean) - INTERVAL 2 HOUR
QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_time DESC, call_timestamp DESC, md5(raw_response) DESC) = 1"""

_EXTREMES = f"""{_ENRICHED}
SELECT city, event_date, max(temperature) AS max_temp,
  arg_max(event_time, row(temperature, event_time)) AS max_temp_time,
  min(temperature) AS min_temp, max(wind_speed) AS peak_wind,
  arg_max(event_time, row(wind_speed, event_time)) FILTER (WHERE wind_speed IS NOT NULL) AS peak_wind_time,
  sum(rain_fall) AS total_rainfall, max(weather_severity_score) AS max_severity
FROM clean GROUP BY city, event_date"""


def _health(load_date: str, ingestion_time: str) -> str:
    # integer arithmetic rounds half up exactly where round(double) may not
    return f"""{_CAPTURES}
SELECT requested_city AS city, {load_date} AS load_date, count(*) AS total_calls,
  count(*) FILTER (WHERE status_code = 200) AS successful_calls,
  count(*) FILTER (WHERE status_code <> 200) AS failed_calls,
  count(*) FILTER (WHERE status_code = 200 AND raw_response IS NULL) AS parse_errors,
  CAST(CAST((sum(latency_ms) * 200 + count(*)) // (2 * count(*)) AS BIGINT) AS DOUBLE) / 100 AS avg_latency_ms,
  CAST((count(*) FILTER (WHERE status_code = 200) * 20000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS success_rate,
  coalesce(max({ingestion_time}) FILTER (WHERE status_code = 200) < TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR, false)
    AS is_stale
FROM captures GROUP BY ALL"""


def _entries() -> dict[str, tuple[Query, str | None]]:
    run_time = f"TIMESTAMP '{AS_OF}'"
    event_reading = f"event_id, {_READING}"
    # stored bronze has the batch id and feed in place of the row key
    bronze_reading = f"""{_READING.replace("load_date", f"CAST({run_time} AS DATE) AS load_date")},
      strftime({run_time}, '%Y%m%d%H%M%S') AS batch_id, 'openweather_api' AS source"""
    quarantined = """SELECT requested_city, status_code, latency_ms, raw_response, ingestion_time, quarantine_reason
FROM checked WHERE quarantine_reason IS NOT NULL"""
    recent = "event_time >= (SELECT max(event_time) FROM clean) - INTERVAL 24 HOUR"
    hourly = f"""{_ENRICHED} SELECT city, date_trunc('hour', event_time) AS event_hour_start, count(*) AS n_readings,
  avg(temperature) AS avg_temperature, avg(humidity) AS avg_humidity, avg(wind_speed) AS avg_wind_speed,
  sum(rain_fall) AS total_rainfall FROM clean WHERE {recent} GROUP BY ALL"""
    return {
        "bronze_ingest": (bronze_ingest, f"{_CAPTURES} SELECT {_LANDED} FROM captures"),
        "bronze_table": (bronze_table, f"{_CAPTURES} SELECT {_STAMPED} FROM captures"),
        "landing_broken": (
            landing_broken,
            f"""{_CAPTURES}, landed AS (
  SELECT *, event_id % 13 = 0 AS is_broken, '{{"requested_city":"' || requested_city || '","latency_ms":' || latency_ms AS line
  FROM captures)
SELECT CASE WHEN NOT is_broken THEN requested_city END AS requested_city,
  CASE WHEN is_broken THEN -1 ELSE coalesce(status_code, 0) END AS status_code,
  CASE WHEN is_broken THEN line ELSE raw_response END AS raw_response,
  CASE WHEN NOT is_broken THEN latency_ms END AS latency_ms,
  CASE WHEN is_broken THEN 'landing_broken' END AS broken FROM landed""",
        ),
        "request_plan": (
            request_plan,
            f"""{_CAPTURES} SELECT DISTINCT requested_city, '{BASE_URL}?q='
  || replace(replace(replace(requested_city, '&', '%26'), '*', '%2A'), ' ', '+') || '&units=metric' AS url FROM captures""",
        ),
        "parse_routes": (parse_routes, f"{_ROUTES} SELECT event_id, route FROM routed"),
        "parse_split": (
            parse_split,
            f"""{_ROUTES} SELECT route, count(*) AS row_count, CAST(sum(latency_ms) AS BIGINT) AS latency_ms
FROM routed GROUP BY route""",
        ),
        "enrich": (enriched, f"{_ENRICHED} SELECT {event_reading} FROM enriched"),
        "enrich_located": (
            enriched_located,
            f"""{_located(AS_OF)} SELECT {_CAPTURED}, load_date, city, country, latitude, longitude, event_time,
  temperature, feels_like AS feels_like_temperature, humidity, pressure, wind_speed, weather_condition,
  weather_description, rainfall, visibility, sunrise_epoch, sunset_epoch, event_date, event_hour,
  temperature_band, weather_severity_score, is_daytime, source_system, ingestion_time FROM located""",
        ),
        "clean": (clean, f"{_ENRICHED} SELECT {event_reading} FROM clean"),
        "quarantine": (quarantine, f"{_ENRICHED} {quarantined}"),
        "quarantine_strict": (
            quarantine_strict,
            f"""{_ENRICHED}, strict AS (
  SELECT CASE WHEN quarantine_reason = 'city_missing' AND NOT json_valid(raw_response) THEN 'json_parse_failed'
    ELSE quarantine_reason END AS quarantine_reason FROM checked)
SELECT quarantine_reason, count(*) AS row_count FROM strict GROUP BY quarantine_reason""",
        ),
        "rules_located": (
            rules_located,
            f"{_located(AS_OF)} SELECT requested_city, call_timestamp, event_time, quarantine_reason FROM checked",
        ),
        "rules_located_early": (
            rules_located_early,
            f"{_located(EARLY)} {_REASON_COUNTS} GROUP BY quarantine_reason",
        ),
        "breakdown": (
            breakdown,
            f"{_ENRICHED} {_REASON_COUNTS} WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason",
        ),
        "breakdown_json": (
            breakdown_json,
            f"{_ENRICHED} SELECT {_breakdown_sql('checked')} AS quarantine_breakdown",
        ),
        "audit": (audit_log, f"{_ENRICHED} SELECT {run_time} AS run_time, {_COUNTS} FROM checked"),
        "run_summary": (
            run_summary,
            f"""{_located(AS_OF)} SELECT {run_time} AS run_timestamp, count(*) AS total_rows_read,
  count(*) FILTER (WHERE quarantine_reason IS NULL) AS valid_rows,
  count(*) FILTER (WHERE quarantine_reason IS NOT NULL) AS quarantined_rows,
  {_breakdown_sql('checked')} AS quarantine_breakdown FROM checked""",
        ),
        "band_counts": (
            band_counts,
            f"""{_ENRICHED} SELECT temperature_band, weather_severity_score, is_daytime, count(*) AS row_count
FROM clean GROUP BY ALL""",
        ),
        "city_current": (city_current, _current(event_reading)),
        "recent_24h": (recent_24h, f"{_ENRICHED} SELECT {event_reading} FROM clean WHERE {recent}"),
        "hourly_summary": (hourly_summary, hourly),
        "daily_extremes": (daily_extremes, _EXTREMES),
        "severe_alerts": (severe_alerts, _ALERTS),
        "alert_history": (
            alert_history,
            f"{_ENRICHED} SELECT event_id, city, alert_type FROM alerting WHERE alert_type IS NOT NULL",
        ),
        "api_health": (api_health, _health("load_date", "ingestion_time")),
        "api_health_malformed": (
            api_health_malformed,
            f"""{_CAPTURES} SELECT requested_city AS city, load_date,
  count(*) FILTER (WHERE status_code = 200 AND raw_response IS NOT NULL AND NOT json_valid(raw_response))
    AS malformed_bodies,
  coalesce(max(ingestion_time) FILTER (WHERE status_code = 200) < {run_time} - INTERVAL 1 HOUR, true) AS is_stale
FROM captures GROUP BY ALL""",
        ),
        "store_current": (store_current, _current(event_reading)),
        "store_alerts": (store_alerts, _ALERTS),
        "store_extremes": (store_extremes, _EXTREMES),
        "store_recent": (store_recent, f"{_ENRICHED} SELECT {event_reading} FROM clean WHERE {recent}"),
        "store_hourly": (store_hourly, hourly),
        "refreshed_extremes": (
            refreshed_extremes,
            _EXTREMES.replace("FROM captures\n", f"FROM captures WHERE {EVERY_OTHER_DAY}\n"),
        ),
        "published_schema_change": (
            published_schema_change,
            f"""{_ENRICHED} SELECT city, event_time, temperature, temperature > 30 AS is_hot FROM clean
QUALIFY row_number() OVER (PARTITION BY city ORDER BY event_time DESC, call_timestamp DESC, md5(raw_response) DESC) = 1""",
        ),
        "named_quarantine": (named_quarantine, f"{_ENRICHED} {quarantined}"),
        "named_clean": (named_clean, f"{_ENRICHED} SELECT {event_reading} FROM clean"),
        "named_audit": (named_audit, f"{_ENRICHED} SELECT {run_time} AS run_time, {_COUNTS} FROM checked"),
        "clean_with_payload": (
            clean_with_payload,
            f"""{_ENRICHED} SELECT event_id, j->>'$.base' AS base, CAST(j->>'$.main.temp_min' AS DOUBLE) AS temp_min,
  CAST(j->>'$.main.temp_max' AS DOUBLE) AS temp_max, CAST(j->>'$.main.sea_level' AS INTEGER) AS sea_level,
  CAST(j->>'$.main.grnd_level' AS INTEGER) AS grnd_level, CAST(j->>'$.wind.deg' AS INTEGER) AS wind_deg,
  CAST(j->>'$.wind.gust' AS DOUBLE) AS wind_gust, CAST(j->>'$.clouds.all' AS INTEGER) AS cloudiness,
  CAST(j->>'$.sys.type' AS INTEGER) AS sys_type, CAST(j->>'$.sys.id' AS INTEGER) AS sys_id,
  CAST(j->>'$.timezone' AS INTEGER) AS utc_offset, CAST(j->>'$.id' AS INTEGER) AS place_id,
  CAST(j->>'$.cod' AS INTEGER) AS cod FROM clean""",
        ),
        "evolved_clean": (
            evolved_clean,
            f"""{_ENRICHED} SELECT event_id, city, event_time, temperature,
  CASE WHEN latency_ms >= 300 THEN 'north' END AS station FROM clean""",
        ),
        "compacted_silver": (compacted_silver, f"{_ENRICHED} SELECT {event_reading} FROM clean"),
        "stream_replayed": (stream_replayed, f"{_ENRICHED} SELECT {bronze_reading} FROM clean"),
        "published_health": (
            published_health,
            _health(f"CAST({run_time} AS DATE)", run_time).replace(
                "FROM captures GROUP", "FROM (SELECT * REPLACE (coalesce(status_code, 0) AS status_code) FROM captures) GROUP"
            ),
        ),
        "compacted_bronze": (
            compacted_bronze,
            f"""{_CAPTURES} SELECT {_STAMPED} FROM captures WHERE {EARLY_HALF}
UNION ALL SELECT {_STAMPED.replace(AS_OF, NEXT_DAY)} FROM captures WHERE NOT ({EARLY_HALF})""",
        ),
        "stream_ingest": (stream_ingest, f"{_CAPTURES} SELECT {_LANDED} FROM captures"),
        "stream_clean": (stream_clean, f"{_ENRICHED} SELECT {bronze_reading} FROM clean"),
        "stream_quarantine": (stream_quarantine, f"{_ENRICHED} {quarantined}"),
        "stream_audit": (stream_audit, f"{_ENRICHED} SELECT {run_time} AS run_time, {_COUNTS} FROM checked"),
        "stream_current": (stream_latest, _current(bronze_reading)),
        "stream_current_state": (stream_current_state, _current(bronze_reading)),
        "stream_named": (stream_named, f"{_ENRICHED} SELECT {bronze_reading} FROM clean"),
        "audit_observed": (audit_observed, f"{_ENRICHED} SELECT {run_time} AS run_time, {_COUNTS} FROM checked"),
        "stream_audit_observed": (
            stream_audit_observed,
            f"{_ENRICHED} SELECT {run_time} AS run_time, {_COUNTS} FROM checked",
        ),
        "refreshed_health": (refreshed_health, _health("load_date", "ingestion_time")),
        "refreshed_hourly": (refreshed_hourly, hourly),
        "recreated_table": (recreated_table, f"{_CAPTURES} SELECT {_STAMPED} FROM captures WHERE {EARLY_HALF}"),
    }


# -- contract -----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The latest clean reading of each city."""
    return city_current(spark, "/root/testdata/sf0.001")


def _optional_entries() -> dict[str, tuple[Query, str | None]]:
    """The training-data operators and their pipeline, where they are installed."""
    found: dict[str, tuple[Query, str | None]] = {}
    try:
        from skyledger.llm.queries import ENTRIES

        found |= ENTRIES
        import corpus_pipeline

        found["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    except ModuleNotFoundError as missing:
        if missing.name not in ("skyledger.llm", "skyledger.llm.queries", "corpus_pipeline"):
            raise
    return found


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in (_entries() | _optional_entries()).items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in (_entries() | _optional_entries()).items() if sql}
