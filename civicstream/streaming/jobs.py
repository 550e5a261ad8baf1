"""Streaming jobs: each wires a source, the shared operators and a sink, with its own
checkpoint. Operators are the batch ones; only output modes and state differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicstream.functions.jsoncols import parse_value
from civicstream.operators import validate
from civicstream.operators.enrich import enrich_eta, route_key, sized_broadcast
from civicstream.operators.incidents import union_incidents
from civicstream.operators.windows import ward_energy
from civicstream.schemas import (ADVISORY_SLIDE, ADVISORY_WATERMARK, ADVISORY_WINDOW,
                                 RAW_SCHEMAS, UNHEALTHY_AQI, WARD_WATERMARK, WARD_WINDOW,
                                 topic_name)
from civicstream.sinks.archive import with_date
from civicstream.sinks import commits
from civicstream.sinks.keyed import stream_keyed, write_keyed, write_raw, writer_id
from civicstream.streaming import stateful


def _start(w, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    w = w.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def parsed_feed(env: DataFrame, feed: str, keep_raw: bool = True) -> DataFrame:
    """PRJ-1/2 + VAL-1..4 on an envelope stream (or batch): typed columns, event time,
    ``error_reason`` (``MALFORMED_JSON`` for text that is not a JSON object)."""
    p = parse_value(env, RAW_SCHEMAS[feed], keep_raw=keep_raw)
    return validate.with_error_reason(p, feed)


# ------------------------------------------------------------------ SNK-1 / SNK-7

def _is_committed(batch: DataFrame, root: str, bootstrap: str | None, checkpoint: str, batch_id: int) -> bool:
    return not bootstrap and commits.is_committed(batch.sparkSession, root, writer_id(checkpoint), batch_id)


def _commit(batch: DataFrame, root: str, bootstrap: str | None, checkpoint: str, batch_id: int,
            parts: list) -> None:
    """All outputs of the batch become visible together. Kafka keeps its own offsets."""
    if not bootstrap:
        commits.commit(batch.sparkSession, root, writer_id(checkpoint), batch_id, parts)


# ------------------------------------------------------------------ VAL-6 / VAL-7

DLQ_FIELDS = ["source_topic", "original_record", "error_reason"]
LATE_EVENT = "LATE_EVENT"


def validation_job(env: DataFrame, feed: str, out_root: str, checkpoint: str,
                   partitions: int | None = None, trigger: dict | None = None,
                   name: str | None = None, bootstrap: str | None = None) -> StreamingQuery:
    """Route every record: valid -> the feed's topic (keyed), invalid -> the DLQ with
    its raw text and reason. Nothing is dropped. Counters (sent / routed_to_dlq) are
    streamed as an ``observe`` metric on each micro-batch's progress."""
    tagged = parsed_feed(env, feed).observe(
        f"{feed}_counts",
        F.count_if(F.col("error_reason").isNull()).alias("sent"),
        F.count_if(F.col("error_reason").isNotNull()).alias("routed_to_dlq"))
    key_field = {"bus_gps": "route_id", "air_quality": "sensor_id",
                 "traffic_signals": "junction_id", "smart_meters": "ward_id"}[feed]
    fields = RAW_SCHEMAS[feed].fieldNames()

    def each(batch: DataFrame, batch_id: int) -> None:
        if _is_committed(batch, out_root, bootstrap, checkpoint, batch_id):
            return
        batch = batch.persist()
        try:
            good = validate.valid_rows(batch, feed).select(*fields, "event_time")
            to = dict(root=out_root, bootstrap=bootstrap, partitions=partitions, batch_id=batch_id,
                      writer=checkpoint, commit=False)
            parts = write_keyed(good, key_field, topic_name(feed), cols=fields, order_col="event_time", **to)
            bad = validate.dlq_records(batch, feed, raw_col="value")
            parts += write_keyed(bad.select("source_topic", "original_record", "error_reason", "key"),
                                 "key", topic_name("dlq"), cols=DLQ_FIELDS, **to)
            _commit(batch, out_root, bootstrap, checkpoint, batch_id, parts)
        finally:
            batch.unpersist()

    return _start(tagged.writeStream.foreachBatch(each), checkpoint, trigger, name)


# ------------------------------------------------------------------ STR-1

def lateness_job(env: DataFrame, feed: str, out_root: str, checkpoint: str, delay: str = WARD_WATERMARK,
                 partitions: int | None = None, trigger: dict | None = None, name: str | None = None,
                 bootstrap: str | None = None) -> StreamingQuery:
    """Late rows as an output, where a watermark would drop them. A record goes to the DLQ as
    ``LATE_EVENT``, with its raw text, if its event time is more than ``delay`` before the latest of
    all earlier batches; every other one, also without an event time, goes to the feed's
    topic as it is. The latest event time stands in the log's entries, so a batch that is run again is
    split alike; it is kept with files only (``out_root`` holds the log also if messages go to Kafka)."""
    times = parse_value(env, RAW_SCHEMAS[feed], keep_raw=True)
    rows = times.select("key", "value", F.col("event_time").cast("timestamp").alias("event_time"))
    writer = writer_id(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, out_root, writer, batch_id):
            return
        batch = batch.persist()
        try:
            before = commits.newest_before(spark, out_root, writer, batch_id)
            late = F.lit(False) if before is None else F.coalesce(
                F.col("event_time") < F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            to = dict(root=out_root, bootstrap=bootstrap, partitions=partitions, batch_id=batch_id,
                      writer=checkpoint, commit=False)
            parts = write_raw(batch.where(~late), topic_name(feed), order_col="event_time", **to)
            dead = batch.where(late).select(
                F.coalesce("key", F.lit("unknown")).alias("key"), F.lit(topic_name(feed)).alias("source_topic"),
                F.col("value").alias("original_record"), F.lit(LATE_EVENT).alias("error_reason"))
            parts += write_keyed(dead, "key", topic_name("dlq"), cols=DLQ_FIELDS, **to)
            newest = batch.agg(F.max(F.unix_micros("event_time"))).head()[0]
            newest = max((t for t in (newest, before) if t is not None), default=None)
            commits.commit(spark, out_root, writer, batch_id, parts, newest)
        finally:
            batch.unpersist()

    return _start(rows.writeStream.foreachBatch(each), checkpoint, trigger, name)


# ------------------------------------------------------------------ AGG-1 + SNK-6/7

def ward_energy_stream(meters: DataFrame, delay: str = WARD_WATERMARK,
                       width: str = WARD_WINDOW, decimals: int | None = None,
                       pf_decimals: int | None = None) -> DataFrame:
    """Watermarked 15-minute tumbling aggregate (append: each window once, when closed)."""
    m = meters.withColumn("event_time", F.col("event_time").cast("timestamp"))
    return ward_energy(m.withWatermark("event_time", delay), width=width, decimals=decimals,
                       pf_decimals=pf_decimals)


def ward_energy_job(meters: DataFrame, archive_path: str, out_root: str, checkpoint: str,
                    partitions: int | None = None, trigger: dict | None = None,
                    name: str | None = None, delay: str = WARD_WATERMARK,
                    width: str = WARD_WINDOW, decimals: int | None = None,
                    pf_decimals: int | None = None, bootstrap: str | None = None) -> StreamingQuery:
    """SNK-7: one aggregation and one state store feeding two sinks. Each micro-batch of
    closed windows is persisted once and written to the keyed topic and to the
    ``ward_id``/``date`` archive; both writes are keyed by batch id (the archive's
    lowest partition level, below ward and date, overwritten dynamically), so a
    replayed batch overwrites its own output instead of duplicating it. One entry of the log in
    ``out_root`` then commits both halves (``commits.read_committed``, ``committed_archive``)."""
    summary = ward_energy_stream(meters, delay, width, decimals, pf_decimals)

    def each(batch: DataFrame, batch_id: int) -> None:
        if _is_committed(batch, out_root, bootstrap, checkpoint, batch_id):
            return
        batch = batch.persist()
        try:
            parts = write_keyed(batch, "ward_id", topic_name("ward_energy_summary"), root=out_root,
                                bootstrap=bootstrap, partitions=partitions, batch_id=batch_id,
                                writer=checkpoint, order_col="window_start", commit=False)
            (with_date(batch).withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("ward_id", "date", "batch").parquet(archive_path))
            archived = ("archive", None, sum(n for _, _, n in parts))
            _commit(batch, out_root, bootstrap, checkpoint, batch_id, [*parts, archived])
        finally:
            batch.unpersist()

    return _start(summary.writeStream.outputMode("append").foreachBatch(each),
                  checkpoint, trigger, name)


# ------------------------------------------------------------------ AGG-2 + JOIN-3

ADVISORY_SQL = """
    SELECT a.zone, z.zone_name, z.population, z.num_schools,
           a.window_start, a.window_end, a.rolling_avg_aqi
    FROM (SELECT zone, w.start AS window_start, w.end AS window_end,
                 {avg} AS rolling_avg_aqi
          FROM (SELECT zone, aqi, window(event_time, '{width}', '{slide}') AS w
                FROM {readings})
          GROUP BY zone, w
          {having}) a
    JOIN {profile} z ON a.zone = z.zone
"""


def health_advisory_stream(spark: SparkSession, air: DataFrame, profile: DataFrame,
                           delay: str = ADVISORY_WATERMARK, width: str = ADVISORY_WINDOW,
                           slide: str = ADVISORY_SLIDE, threshold: float = UNHEALTHY_AQI,
                           readings_view: str = "air_quality_stream",
                           profile_view: str = "zone_profile",
                           decimals: int | None = None, retract: bool = False) -> DataFrame:
    """The advisory as streaming SQL over temp views: the window is written once, the
    zone average is aggregated before the join (the static profile is small and joins
    the aggregated rows), ``HAVING`` keeps unhealthy windows. Update mode re-emits a
    window whenever its average changes; a window falling back below the threshold is
    simply no longer emitted. With ``retract`` it is, so that a consumer who keeps the latest
    value of each window sees that it is not unhealthy any more."""
    a = air.withColumn("event_time", F.col("event_time").cast("timestamp")) \
           .withWatermark("event_time", delay)
    a.createOrReplaceTempView(readings_view)
    profile.distinct().createOrReplaceTempView(profile_view)  # a repeated row must not repeat advisories
    avg = ("AVG(aqi)" if decimals is None else
           f"CAST(SUM(CAST(aqi AS DECIMAL(18,{decimals}))) AS DOUBLE) / COUNT(aqi)")
    having = "" if retract else f"HAVING {avg} > {threshold}"
    return spark.sql(ADVISORY_SQL.format(width=width, slide=slide, having=having,
                                         readings=readings_view, profile=profile_view, avg=avg))


def health_advisory_job(spark: SparkSession, air: DataFrame, profile: DataFrame, out_root: str,
                        checkpoint: str, trigger: dict | None = None, name: str | None = None,
                        bootstrap: str | None = None, **params) -> StreamingQuery:
    adv = health_advisory_stream(spark, air, profile, **params)
    return stream_keyed(adv, "zone", topic_name("health_advisories"), checkpoint,
                        root=out_root, bootstrap=bootstrap, output_mode="update", trigger=trigger,
                        query_name=name, order_col="window_start")


# ------------------------------------------------------------------ JOIN-1/2

def enrichment_job(gps: DataFrame, routes: DataFrame, out_root: str, checkpoint: str,
                   trigger: dict | None = None, name: str | None = None,
                   bootstrap: str | None = None) -> StreamingQuery:
    """Stream-static inner join on the route key (message key, else payload route);
    joined / unmatched / missing-key counters ride along as an ``observe`` metric."""
    g = route_key(gps)
    g = g.withColumn("timestamp", F.col("timestamp").cast("string"))
    lk = sized_broadcast(routes.select(F.col("route_id").alias("_rk")))
    counted = g.join(lk, g["route_key"] == lk["_rk"], "left").observe(
        "enrichment", F.count_if(F.col("_rk").isNotNull()).alias("joined"),
        F.count_if(F.col("_rk").isNull()).alias("unmatched"),
        F.count_if(F.col("key").isNull()).alias("missing_key")).drop("_rk")
    out = enrich_eta(counted, routes, broadcast_checked=False)
    return stream_keyed(out, "route_id", topic_name("bus_eta_enriched"), checkpoint,
                        root=out_root, bootstrap=bootstrap, trigger=trigger, query_name=name,
                        order_col="gps_timestamp")


# ------------------------------------------------------------------ STR-6

def dedup_stream(df: DataFrame, keys: list[str], time_col: str = "event_time",
                 delay: str = ADVISORY_WATERMARK) -> DataFrame:
    """Drop replayed duplicates (same keys) seen within the watermark delay."""
    d = df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, delay)
    return d.dropDuplicatesWithinWatermark(keys)


# ------------------------------------------------------------------ DET-4 / SNK-5

def incidents_stream(air: DataFrame | None = None, traffic: DataFrame | None = None,
                     gps: DataFrame | None = None, tie_col: str = "offset",
                     params: dict | None = None, groups: int = stateful.GROUPS) -> DataFrame:
    """Union of the three stateful detectors' alerts (any subset), with their state in ``groups``."""
    params = params or {}
    parts = []
    if air is not None:
        parts.append(stateful.stream_aqi(air, tie_col=tie_col, groups=groups, **params.get("aqi", {})))
    if traffic is not None:
        parts.append(stateful.stream_gridlock(traffic, tie_col=tie_col, groups=groups,
                                              **params.get("gridlock", {})))
    if gps is not None:
        parts.append(stateful.stream_bunching(gps, tie_col=tie_col, groups=groups,
                                              **params.get("bunching", {})))
    return union_incidents(*parts)


def incidents_job(incidents: DataFrame, out_root: str, checkpoint: str,
                  trigger: dict | None = None, name: str | None = None,
                  bootstrap: str | None = None) -> StreamingQuery:
    return stream_keyed(incidents, None, topic_name("incidents"), checkpoint, root=out_root,
                        bootstrap=bootstrap, trigger=trigger, query_name=name,
                        order_col="detected_at_event_time")


# ------------------------------------------------------------------ STR-5 / OPS-2

def independent_readers(spark: SparkSession, source: DataFrame, slow: DataFrame,
                        checkpoints: tuple[str, str], trigger: dict | None = None):
    """Two consumers of one topic with separate checkpoints (their own offsets): a
    fast one and a rate-limited one (``slow`` is the same source read with a small
    ``maxFilesPerTrigger``/``maxOffsetsPerTrigger``). Each counts what it processed."""
    fast_q = _start(source.groupBy().count().writeStream.outputMode("complete")
                    .format("memory"), checkpoints[0], trigger, "high_priority")
    slow_q = _start(slow.groupBy().count().writeStream.outputMode("complete")
                    .format("memory"), checkpoints[1], trigger, "standard_priority")
    return fast_q, slow_q


def progress_lag(query: StreamingQuery) -> dict:
    """Live lag/throughput of a query from its last progress (OPS-2, OPS-5, AGG-7)."""
    p = query.lastProgress or {}
    src = (p.get("sources") or [{}])[0]
    return {"name": p.get("name"), "batch": p.get("batchId"),
            "num_input_rows": p.get("numInputRows"), "end_offset": src.get("endOffset"),
            "latest_offset": src.get("latestOffset"),
            "observed": p.get("observedMetrics", {})}
