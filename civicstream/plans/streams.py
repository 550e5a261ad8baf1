"""Registered streaming queries over the driver tables.

Spark derives the feed messages from ``events`` (JSON values in the message envelope) and
writes them as files into the shared checkpoint folder, one slice of event time after another;
after each the streaming job runs with an ``availableNow`` trigger into its sink, going on from
its checkpoint. The sink's rows are returned as a DataFrame.
Each call uses fresh folders, so the result depends only on the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.plans import feeds
from civicstream.plans import queries as Q
from civicstream.schemas import ENVELOPE, RAW_SCHEMAS, topic_name
from civicstream.session import PACKED_STATE_ROWS, STATE_ROWS, state_partitions, unique_scratch_path
from civicstream.sinks import commits
from civicstream.sources import jsonl
from civicstream.sources.topics import read_topic
from civicstream.streaming import jobs, stateful

ISO_S = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ONCE = {"availableNow": True}
SLICES = 3
MEASURES = ["total_kwh_consumed", "avg_power_factor", "peak_voltage"]
SUMMARY = "ward_id string, window_start timestamp, window_end timestamp, " + ", ".join(f"{c} double" for c in MEASURES)


def _messages(spark: SparkSession, sf_dir: str, feed: str, copies: int = 1) -> DataFrame:
    """The feed as envelope rows (JSON value with an ISO ``timestamp``). Offsets are the record
    ids; ``copies`` > 1 replays every record."""
    f = feeds.feed(spark, sf_dir, feed)
    payload = f.withColumn("timestamp", F.date_format("event_time", ISO_S))
    cols = RAW_SCHEMAS[feed].fieldNames()
    key_field = {"bus_gps": "route_id", "air_quality": "sensor_id",
                 "traffic_signals": "junction_id", "smart_meters": "ward_id"}[feed]
    msgs = payload.select(F.col(key_field).cast("string").alias("key"),
                          F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"),
                          F.lit(topic_name(feed)).alias("topic"),
                          F.lit(0).alias("partition"),
                          F.col("record_id").alias("offset"),
                          F.col("event_time").cast("timestamp").alias("timestamp"))
    if copies > 1:
        msgs = msgs.unionByName(msgs)
    return msgs.select(*ENVELOPE.fieldNames())


class _Delivery:
    """Delivers messages into topic folders in ``SLICES`` slices of event time, and runs a query
    over all that has arrived after each: several micro-batches, in event order as a topic would
    have it, with a restart from the checkpoint between them."""

    def __init__(self, spark: SparkSession, messages: dict[str, DataFrame], delayed: str = "false",
                 state_rows: int = STATE_ROWS):
        """Messages that meet the condition ``delayed`` arrive one slice after their own. One partition
        of the query's state is made for ``state_rows``."""
        self.messages, self.delayed, self.state_rows = messages, delayed, state_rows
        self.spark, self.root = spark, unique_scratch_path(spark, "topics")
        times = [m.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count(F.lit(1)).alias("n"))
                 for m in messages.values()]
        lo, hi, self.rows = reduce(DataFrame.unionByName, times).agg(F.min("lo"), F.max("hi"), F.sum("n")).first()
        self.edges = [lo + (hi - lo) * i / SLICES for i in range(1, SLICES)] if lo is not None else []
        for feed, m in messages.items():  # an empty folder, so that the stream can be declared
            m.limit(0).write.parquet(f"{self.root}/{topic_name(feed)}")

    def run(self, start) -> None:
        for i in range(SLICES):
            for feed, m in self.messages.items():
                slice_no = sum((F.coalesce(F.col("timestamp") >= F.lit(e), F.lit(False)).cast("int")
                                for e in self.edges), F.lit(0))
                arrival = F.least(slice_no + F.expr(self.delayed).cast("int"), F.lit(SLICES - 1))
                m.where(arrival == i).write.mode("append").parquet(f"{self.root}/{topic_name(feed)}")
            with state_partitions(self.spark, self.rows, self.state_rows):
                start().awaitTermination()


def _stream_valid(spark, root: str, feed: str) -> DataFrame:
    env = read_topic(spark, topic_name(feed), root=root, streaming=True)
    tagged = jobs.parsed_feed(env, feed, keep_raw=False)
    return Q.validate.valid_rows(tagged, feed)


def stream_ward_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-1 append + SNK-2/6/7: closed 15-minute windows, read back from the archive (with its
    ``date``) and from the topic."""
    feed = _Delivery(spark, {"smart_meters": _messages(spark, sf_dir, "smart_meters")})
    meters = _stream_valid(spark, feed.root, "smart_meters")
    out = unique_scratch_path(spark, "ward-out")
    feed.run(lambda: jobs.ward_energy_job(meters, f"{out}/archive", f"{out}/topics", f"{out}/ckpt",
                                          trigger=ONCE, decimals=2, pf_decimals=6))
    arc = commits.committed_archive(spark, f"{out}/topics", f"{out}/archive", "archive")
    log = commits.read_committed(spark, f"{out}/topics", topic_name("ward_energy_summary"))
    sent = log.select("key", F.from_json("value", SUMMARY).alias("r")).select("key", "r.*")
    both = arc.join(sent.select("key", "window_start", *(F.col(c).alias(f"topic_{c}") for c in MEASURES)),
                    (arc["ward_id"] == sent["key"]) & (arc["window_start"] == sent["window_start"]), "full")
    return both.select("ward_id", F.col("date").cast("string").alias("date"),
                       arc["window_start"].cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                       *MEASURES, *(f"topic_{c}" for c in MEASURES))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 input: one JSON line of the air feed per event, in order of the record id; a few are cut
    off. Numbers are written with three decimals."""
    air = feeds.feed(spark, sf_dir, "air_quality").select("*", F.pmod("record_id", F.lit(61)).alias("_cut"))
    number = lambda c: f"coalesce(CAST(CAST({c} AS DECIMAL(18,3)) AS STRING), 'null')"
    line = ("concat('{\"sensor_id\":\"', sensor_id, '\",\"zone\":\"', zone, "
            + ", ".join(f"'{q}\"{c}\":', {number(c)}" for q, c in
                        (('",', "pm25"), (",", "pm10"), (",", "no2"), (",", "aqi")))
            + f", ',\"timestamp\":\"', date_format(event_time, \"{ISO_S}\"), '\"}}')")
    return air.orderBy("record_id").selectExpr(
        f"CASE WHEN _cut = 7 THEN substring({line}, 1, 25) ELSE {line} END AS value")


def jsonl_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 from end to end: text files -> a stream of lines with their numbers -> topic -> rules ->
    dead letters with their raw text (VAL-5), valid rows -> detector. One row per line."""
    base = unique_scratch_path(spark, "jsonl")
    raw_lines(spark, sf_dir).write.text(f"{base}/in")
    placed = jsonl.stream_jsonl(spark, f"{base}/in")
    jsonl.ingest_job(placed, "air_quality", f"{base}/topics", f"{base}/ckpt", trigger=ONCE).awaitTermination()
    env = read_topic(spark, topic_name("air_quality"), root=f"{base}/topics")
    tagged = jobs.parsed_feed(env, "air_quality")
    dead = Q.validate.dlq_records(tagged.select("*"), "air_quality", raw_col="value", extra=("offset",))
    alerts = Q.detect.cooldown_alerts(
        Q.validate.valid_rows(tagged, "air_quality"), "sensor_id", "event_time", "aqi", "offset",
        threshold=Q.AQI_THRESHOLD, cooldown_ms=Q.AQI_COOLDOWN_MS).select("offset", F.lit(True).alias("alerted"))
    return (tagged.select("key", "offset").join(dead.select("offset", "error_reason", "original_record"), "offset", "left")
            .join(alerts, "offset", "left")
            .select("offset", "key", "error_reason", "original_record", F.coalesce("alerted", F.lit(False)).alias("alerted")))


def stream_health_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2 + JOIN-3 as streaming SQL in update mode; the keyed changelog is read back
    and the latest value per (zone, window) kept (a consumer's upsert); a window that fell back
    to the threshold or below is emitted too, and taken back."""
    feed = _Delivery(spark, {"air_quality": _messages(spark, sf_dir, "air_quality")})
    air = _stream_valid(spark, feed.root, "air_quality")
    profile = Q.zone_profile(Q._valid(spark, sf_dir, "air_quality"))
    out = unique_scratch_path(spark, "advisory-out")
    feed.run(lambda: jobs.health_advisory_job(
        spark, air, profile, f"{out}/topics", f"{out}/ckpt", trigger=ONCE, width=Q.ADVISORY_WIDTH,
        slide=Q.ADVISORY_SLIDE, threshold=Q.ADVISORY_THRESHOLD, decimals=2, retract=True))
    log = spark.read.parquet(f"{out}/topics/{topic_name('health_advisories')}")
    schema = ("zone string, zone_name string, population int, num_schools int, "
              "window_start timestamp, window_end timestamp, rolling_avg_aqi double")
    rows = log.select("batch", F.from_json("value", schema).alias("r")).select("batch", "r.*")
    latest = rows.groupBy("zone", "window_start").agg(
        F.max_by(F.struct(*[c for c in rows.columns if c not in ("batch",)]),
                 F.col("batch")).alias("x")).select("x.*")
    latest = latest.where(F.col("rolling_avg_aqi") > Q.ADVISORY_THRESHOLD)  # others were retracted
    return latest.select("zone", "zone_name", "population", "num_schools",
                         F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                         "rolling_avg_aqi")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6: every air message delivered twice; deduplicated within the watermark."""
    feed = _Delivery(spark, {"air_quality": _messages(spark, sf_dir, "air_quality", copies=2)})
    env = read_topic(spark, topic_name("air_quality"), root=feed.root, streaming=True)
    parsed = jobs.parsed_feed(env, "air_quality", keep_raw=False)
    d = jobs.dedup_stream(parsed, ["sensor_id", "event_time"])
    out = unique_scratch_path(spark, "dedup-out")
    rows = d.select("sensor_id", "event_time", F.col("offset").alias("record_id"))
    feed.run(lambda: rows.writeStream.format("parquet").option("path", f"{out}/rows")
             .option("checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start())
    r = spark.read.parquet(f"{out}/rows")
    return r.select("sensor_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"),
                    "record_id")


def stream_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET-1..4 streaming: three stateful detectors over three message streams into the incident
    topic (SNK-5), read back from its JSON values. Rows newer than the final watermark are still
    waiting when the stream stops, so the result is the batch incidents up to that watermark, and
    for pairs of buses up to the freshness limit before it."""
    names = ("air_quality", "traffic_signals", "bus_gps")
    feed = _Delivery(spark, {n: _messages(spark, sf_dir, n) for n in names}, state_rows=PACKED_STATE_ROWS)
    air, tr, gps = (_stream_valid(spark, feed.root, n) for n in names)
    params = {"aqi": {"threshold": Q.AQI_THRESHOLD, "cooldown_ms": Q.AQI_COOLDOWN_MS},
              "gridlock": {"threshold": Q.WAIT_THRESHOLD, "cycles": Q.WAIT_CYCLES},
              "bunching": {"distance_m": Q.BUNCH_DISTANCE_M, "duration_ms": Q.BUNCH_DURATION_MS,
                           "fresh_ms": Q.BUNCH_FRESH_MS}}
    inc = jobs.incidents_stream(air, tr, gps, tie_col="offset",
                                params=params, groups=stateful.state_groups(feed.rows))
    out = unique_scratch_path(spark, "incidents-out")
    feed.run(lambda: jobs.incidents_job(inc, f"{out}/topics", f"{out}/ckpt", trigger=ONCE))
    log = spark.read.parquet(f"{out}/topics/{topic_name('incidents')}")
    return log.select(F.from_json("value", stateful.INCIDENT_DDL).alias("r")).select("r.*")


def stream_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-6 + SNK-1: the four validation jobs write five topics, the DLQ together, in three batches
    each. Per topic, source and key: its messages, partitions, and first and last event time by
    offset; and for the topic's partitions the offsets that are missing, and those given twice."""
    feed = _Delivery(spark, {n: _messages(spark, sf_dir, n) for n in feeds.FEEDS})
    out = unique_scratch_path(spark, "validation-out")

    def start():
        jobs_ = [jobs.validation_job(read_topic(spark, topic_name(n), root=feed.root, streaming=True), n,
                                     f"{out}/topics", f"{out}/ckpt-{n}", partitions=3, trigger=ONCE) for n in feeds.FEEDS]
        return _All(jobs_)

    feed.run(start)
    parts = [commits.read_committed(spark, f"{out}/topics", topic_name(n)) for n in [*feeds.FEEDS, "dlq"]]
    log = reduce(DataFrame.unionByName, parts)
    when = lambda c: F.get_json_object(c, "$.timestamp").try_cast("timestamp").cast("timestamp_ntz")
    log = log.withColumn("source", F.coalesce(F.get_json_object("value", "$.source_topic"), F.col("topic"))).withColumn(
        "time", F.when(F.col("topic") != topic_name("dlq"), when("value")))
    by_key = log.groupBy("topic", "source", "key").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("partition").alias("partitions"),
        F.min_by("time", "offset").alias("first_time"), F.max_by("time", "offset").alias("last_time"))
    places = log.groupBy("topic", "partition").agg(
        (F.max("offset") + 1 - F.count(F.lit(1))).alias("missing"),
        (F.count(F.lit(1)) - F.count_distinct("offset")).alias("repeated"))
    places = places.groupBy("topic").agg(F.sum("missing").alias("missing"), F.sum("repeated").alias("repeated"))
    return by_key.join(places, "topic")


class _All:
    """Several running queries, awaited as one."""

    def __init__(self, running: list):
        self.running = running

    def awaitTermination(self) -> None:
        for q in self.running:
            q.awaitTermination()


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1: one message in 37 arrives a third of the time span late; every one ends in the topic or,
    with its raw text, in the DLQ."""
    feed = _Delivery(spark, {"air_quality": _messages(spark, sf_dir, "air_quality")}, delayed="offset % 37 = 5")
    env = read_topic(spark, topic_name("air_quality"), root=feed.root, streaming=True)
    out = unique_scratch_path(spark, "late-out")
    feed.run(lambda: jobs.lateness_job(env, "air_quality", f"{out}/topics", f"{out}/ckpt", trigger=ONCE))
    kept = commits.read_committed(spark, f"{out}/topics", topic_name("air_quality"))
    dead = commits.read_committed(spark, f"{out}/topics", topic_name("dlq"))
    rows = kept.select("key", "value", F.lit(None).cast("string").alias("error_reason")).unionByName(dead.select(
        "key", F.get_json_object("value", "$.original_record").alias("value"),
        F.get_json_object("value", "$.error_reason").alias("error_reason")))
    return rows.select("key", "error_reason", F.get_json_object("value", "$.zone").alias("zone"),
                       F.get_json_object("value", "$.timestamp").alias("timestamp"))


STREAM_QUERIES = {
    "stream_validation": stream_validation,
    "stream_late": stream_late,
    "jsonl_ingest": jsonl_ingest,
    "stream_ward_energy": stream_ward_energy,
    "stream_health_advisories": stream_health_advisories,
    "stream_dedup": stream_dedup,
    "stream_incidents": stream_incidents,
}
