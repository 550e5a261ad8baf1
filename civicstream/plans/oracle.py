"""DuckDB SQL for each registered query (same column names), written independently
of the Spark plans: detectors use a recursive walk / gaps-and-islands / all-pairs
as-of, windows use direct bucketing."""

from __future__ import annotations

from civicstream.plans.feeds import SQL_FEEDS, SQL_K, SQL_ROUTES
from civicstream.plans.queries import (ADVISORY_THRESHOLD, AQI_COOLDOWN_MS, AQI_THRESHOLD,
                                       BUNCH_DISTANCE_M, BUNCH_DURATION_MS, BUNCH_FRESH_MS,
                                       WAIT_CYCLES, WAIT_THRESHOLD)

_IDS = "coalesce({a} = '', true) OR coalesce({b} = '', true)"
SQL_RULES = {
    "bus_gps": f"""CASE
        WHEN lat IS NULL OR lon IS NULL THEN 'NULL_COORDINATES'
        WHEN NOT (lat BETWEEN -90 AND 90) OR NOT (lon BETWEEN -180 AND 180) THEN 'IMPOSSIBLE_GPS_COORDINATES'
        WHEN speed_kmh IS NULL OR speed_kmh < 0 OR speed_kmh > 120 THEN 'SPEED_OUT_OF_RANGE'
        WHEN occupancy_pct IS NULL OR occupancy_pct < 0 OR occupancy_pct > 100 THEN 'OCCUPANCY_OUT_OF_RANGE'
        WHEN {_IDS.format(a='route_id', b='bus_id')} THEN 'MISSING_ID_FIELD' END""",
    "air_quality": f"""CASE
        WHEN aqi IS NULL THEN 'NULL_AQI'
        WHEN aqi < 0 OR aqi > 500 THEN 'AQI_OUT_OF_RANGE'
        WHEN pm25 IS NULL OR pm25 < 0 THEN 'NEGATIVE_OR_MISSING_PM25'
        WHEN pm10 IS NULL OR pm10 < 0 THEN 'NEGATIVE_OR_MISSING_PM10'
        WHEN no2 IS NULL OR no2 < 0 THEN 'NEGATIVE_OR_MISSING_NO2'
        WHEN {_IDS.format(a='sensor_id', b='zone')} THEN 'MISSING_ID_FIELD' END""",
    "traffic_signals": f"""CASE
        WHEN vehicle_count IS NULL OR vehicle_count < 0 THEN 'NEGATIVE_VEHICLE_COUNT'
        WHEN avg_wait_sec IS NULL OR avg_wait_sec < 0 OR avg_wait_sec > 600 THEN 'WAIT_TIME_OUT_OF_RANGE'
        WHEN NOT coalesce(signal_phase IN ('GREEN', 'RED', 'AMBER'), false) THEN 'INVALID_SIGNAL_PHASE'
        WHEN {_IDS.format(a='junction_id', b='zone')} THEN 'MISSING_ID_FIELD' END""",
    "smart_meters": f"""CASE
        WHEN kwh_reading IS NULL OR kwh_reading < 0 THEN 'NEGATIVE_KWH_READING'
        WHEN voltage IS NULL OR voltage < 180 OR voltage > 260 THEN 'VOLTAGE_OUT_OF_RANGE'
        WHEN power_factor IS NULL OR power_factor < 0 OR power_factor > 1 THEN 'POWER_FACTOR_OUT_OF_RANGE'
        WHEN {_IDS.format(a='meter_id', b='ward_id')} THEN 'MISSING_ID_FIELD' END""",
}
KEYS = {"bus_gps": "route_id", "air_quality": "sensor_id", "traffic_signals": "junction_id",
        "smart_meters": "ward_id"}
PARTS = {"bus_gps": 6, "traffic_signals": 6, "air_quality": 3, "smart_meters": 4}
RETENTION = {"bus_gps": 86400000, "traffic_signals": 604800000, "air_quality": 7776000000,
             "smart_meters": 31536000000}
ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def tagged(feed: str) -> str:
    return f"(SELECT *, {SQL_RULES[feed]} AS error_reason FROM ({SQL_FEEDS[feed]}))"


def valid(feed: str) -> str:
    casts = {"bus_gps": "* REPLACE (CAST(occupancy_pct AS INTEGER) AS occupancy_pct)",
             "traffic_signals": "* REPLACE (CAST(vehicle_count AS INTEGER) AS vehicle_count)"}
    sel = casts.get(feed, "*")
    return f"(SELECT {sel} FROM {tagged(feed)} WHERE error_reason IS NULL)"


def all_dlq() -> str:
    parts = [f"SELECT coalesce(CAST({KEYS[f]} AS VARCHAR), 'unknown') AS key, "
             f"'city.{f}' AS source_topic, error_reason, record_id, event_time "
             f"FROM {tagged(f)} WHERE error_reason IS NOT NULL" for f in SQL_FEEDS]
    return "(" + " UNION ALL ".join(parts) + ")"


def envelopes() -> str:
    parts = [f"SELECT {KEYS[f]} AS key, 'city.{f}' AS topic, "
             f"CAST(record_id % {PARTS[f]} AS INTEGER) AS partition, record_id AS \"offset\", "
             f"event_time AS timestamp FROM ({SQL_FEEDS[f]})" for f in SQL_FEEDS]
    return "(" + " UNION ALL ".join(parts) + ")"


def _catalog_values() -> str:
    from civicstream.operators.dlq import RULE_DESCRIPTIONS
    from civicstream.schemas import REASONS
    rows = [f"('city.{f}', {i + 1}, '{r}', '{RULE_DESCRIPTIONS[r]}')"
            for f, rs in REASONS.items() for i, r in enumerate(rs)]
    return "(VALUES " + ", ".join(rows) + ") AS c(source_topic, rule_order, error_reason, description)"


HAV = ("2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({la2} - {la1}) / 2), 2) "
       "+ cos(radians({la1})) * cos(radians({la2})) * pow(sin(radians({lo2} - {lo1}) / 2), 2))))")


def _aqi_sql() -> str:
    return f"""
    WITH RECURSIVE cand AS (
        SELECT sensor_id, zone, aqi, record_id, event_time, (epoch_us(event_time) // 1000) AS t,
               row_number() OVER (PARTITION BY sensor_id ORDER BY (epoch_us(event_time) // 1000), record_id) AS rn
        FROM {valid('air_quality')} WHERE aqi > {AQI_THRESHOLD}),
    nx AS (SELECT c.*, (SELECT min(c2.rn) FROM cand c2 WHERE c2.sensor_id = c.sensor_id
                        AND c2.t >= c.t + {AQI_COOLDOWN_MS}) AS nxt FROM cand c),
    chain AS (SELECT sensor_id, rn, nxt FROM nx WHERE rn = 1
              UNION ALL
              SELECT n.sensor_id, n.rn, n.nxt FROM chain ch JOIN nx n
                ON n.sensor_id = ch.sensor_id AND n.rn = ch.nxt)
    SELECT n.sensor_id, n.zone, n.aqi, n.record_id, n.event_time, n.t AS detected_at_event_time
    FROM nx n JOIN chain USING (sensor_id, rn)"""


def _gridlock_sql() -> str:
    return f"""
    WITH r AS (SELECT *, (epoch_us(event_time) // 1000) AS t FROM {valid('traffic_signals')}
               WHERE avg_wait_sec IS NOT NULL),
    q AS (SELECT *, sum(CASE WHEN avg_wait_sec > {WAIT_THRESHOLD} THEN 0 ELSE 1 END) OVER (
              PARTITION BY junction_id ORDER BY t, record_id ROWS UNBOUNDED PRECEDING) AS streak
          FROM r),
    s AS (SELECT *, row_number() OVER (PARTITION BY junction_id, streak ORDER BY t, record_id) AS n
          FROM q WHERE avg_wait_sec > {WAIT_THRESHOLD})
    SELECT junction_id, zone, avg_wait_sec, {WAIT_CYCLES} AS consecutive_cycles_over_threshold,
           record_id, event_time, t AS detected_at_event_time
    FROM s WHERE n = {WAIT_CYCLES}"""


def _bunching_core() -> str:
    dist = HAV.format(la1="lat", lo1="lon", la2="olat", lo2="olon")
    return f"""
    fx AS (SELECT route_id, bus_id, lat, lon, (epoch_us(event_time) // 1000) AS t, record_id AS tie,
                  event_time FROM {valid('bus_gps')}),
    obs0 AS (SELECT e.route_id, e.bus_id AS rep, o.bus_id AS other, e.t, e.tie, e.event_time,
                    e.lat, e.lon, o.lat AS olat, o.lon AS olon, o.t AS ot,
                    row_number() OVER (PARTITION BY e.route_id, e.bus_id, e.tie, o.bus_id
                                       ORDER BY o.t DESC, o.tie DESC) AS rn
             FROM fx e JOIN fx o ON e.route_id = o.route_id AND e.bus_id <> o.bus_id
                  AND (o.t < e.t OR (o.t = e.t AND o.tie < e.tie))),
    obs AS (SELECT *, {dist} AS dist, least(rep, other) AS a, greatest(rep, other) AS b
            FROM obs0 WHERE rn = 1 AND t - ot <= {BUNCH_FRESH_MS}),
    st AS (SELECT *, sum(CASE WHEN dist <= {BUNCH_DISTANCE_M} THEN 0 ELSE 1 END) OVER (
               PARTITION BY route_id, a, b ORDER BY t, tie ROWS UNBOUNDED PRECEDING) AS streak
           FROM obs),
    cl AS (SELECT *, min(t) OVER (PARTITION BY route_id, a, b, streak) AS first
           FROM st WHERE dist <= {BUNCH_DISTANCE_M}),
    al AS (SELECT *, row_number() OVER (PARTITION BY route_id, a, b, streak ORDER BY t, tie) AS k
           FROM cl WHERE t - first >= {BUNCH_DURATION_MS}),
    bunch AS (SELECT route_id, rep AS bus_id_1, other AS bus_id_2, round(dist, 1) AS distance_m,
                     (t - first) // 1000 AS continuous_proximity_sec, tie AS record_id,
                     t AS detected_at_event_time, event_time FROM al WHERE k = 1)"""


def _incidents_sql() -> str:
    aqi = _aqi_sql().replace("WITH RECURSIVE", "", 1)
    aqi_body, aqi_select = aqi.rsplit("SELECT n.sensor_id", 1)
    grid = _gridlock_sql().replace("WITH ", "", 1)
    grid_body, grid_select = grid.rsplit("SELECT junction_id", 1)
    grid_body = grid_body.replace(" r AS (", " gr AS (", 1).replace("FROM r)", "FROM gr)") \
                         .replace(" q AS (", " gq AS (", 1).replace("FROM q WHERE", "FROM gq WHERE") \
                         .replace(" s AS (", " gs AS (", 1)
    grid_select = grid_select.replace("FROM s WHERE", "FROM gs WHERE")
    return f"""
    WITH RECURSIVE {aqi_body.strip().rstrip(',')},
    aqi AS (SELECT n.sensor_id{aqi_select}),
    {grid_body.strip().rstrip(',')},
    grid AS (SELECT junction_id{grid_select}),
    {_bunching_core()}
    SELECT 'AQI_EMERGENCY' AS incident_type, 'HAZARDOUS' AS severity,
           strftime(event_time, {ISO}) AS source_timestamp, detected_at_event_time,
           sensor_id, zone, aqi, NULL::VARCHAR AS junction_id,
           NULL::INTEGER AS consecutive_cycles_over_threshold, NULL::DOUBLE AS avg_wait_sec,
           NULL::VARCHAR AS route_id, NULL::VARCHAR AS bus_id_1, NULL::VARCHAR AS bus_id_2,
           NULL::DOUBLE AS distance_m, NULL::BIGINT AS continuous_proximity_sec FROM aqi
    UNION ALL
    SELECT 'TRAFFIC_GRIDLOCK', 'HIGH', strftime(event_time, {ISO}), detected_at_event_time,
           NULL, zone, NULL, junction_id, consecutive_cycles_over_threshold, avg_wait_sec,
           NULL, NULL, NULL, NULL, NULL FROM grid
    UNION ALL
    SELECT 'BUS_BUNCHING', 'MEDIUM', strftime(event_time, {ISO}), detected_at_event_time,
           NULL, NULL, NULL, NULL, NULL, NULL, route_id, bus_id_1, bus_id_2, distance_m,
           continuous_proximity_sec FROM bunch"""


def _gps_keyed() -> str:
    return f"""(SELECT g.*, k.key, coalesce(k.key, g.route_id) AS route_key
        FROM {valid('bus_gps')} g JOIN (
            SELECT event_id AS record_id,
                   CASE WHEN {SQL_K} < 3 THEN NULL
                        ELSE 'R' || CAST(user_id // 5 AS VARCHAR) END AS key
            FROM events) k USING (record_id))"""


ORACLE = {
    **{f"validate_{f}": f"SELECT record_id, error_reason FROM {tagged(f)}" for f in SQL_FEEDS},
    "split_counts": " UNION ALL ".join(
        f"SELECT 'city.{f}' AS source_topic, count(*) FILTER (WHERE error_reason IS NULL) AS sent, "
        f"count(*) FILTER (WHERE error_reason IS NOT NULL) AS routed_to_dlq FROM {tagged(f)}"
        for f in SQL_FEEDS),
    "dlq_messages": f"SELECT key, source_topic, error_reason, record_id FROM {all_dlq()}",
    "dlq_by_reason": f"""SELECT error_reason, count(*) AS cnt,
        100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct
        FROM {all_dlq()} GROUP BY error_reason""",
    "dlq_by_topic": f"""SELECT source_topic, error_reason, count(*) AS cnt
        FROM {all_dlq()} GROUP BY ALL""",
    "dlq_windows": f"""SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
        time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
        source_topic, error_reason, count(*) AS cnt FROM {all_dlq()} GROUP BY ALL""",
    "rule_hits": f"""SELECT c.source_topic, c.rule_order, c.error_reason, c.description,
        CAST(coalesce(h.hits, 0) AS BIGINT) AS hits FROM {_catalog_values()}
        LEFT JOIN (SELECT source_topic, error_reason, count(*) AS hits FROM {all_dlq()}
                   GROUP BY ALL) h USING (source_topic, error_reason)""",
    "ward_energy": f"""SELECT ward_id, time_bucket(INTERVAL 15 MINUTE, event_time) AS window_start,
        time_bucket(INTERVAL 15 MINUTE, event_time) + INTERVAL 15 MINUTE AS window_end,
        CAST(sum(CAST(kwh_reading AS DECIMAL(18,2))) AS DOUBLE) AS total_kwh_consumed,
        CAST(sum(CAST(power_factor AS DECIMAL(18,6))) AS DOUBLE) / count(power_factor) AS avg_power_factor,
        max(voltage) AS peak_voltage
        FROM {valid('smart_meters')} GROUP BY ALL""",
    "ward_totals": f"""SELECT ward_id, CAST(sum(t) AS DOUBLE) AS total_kwh FROM (
        SELECT ward_id, sum(CAST(kwh_reading AS DECIMAL(18,2))) AS t
        FROM {valid('smart_meters')} GROUP BY ward_id, time_bucket(INTERVAL 15 MINUTE, event_time))
        GROUP BY ward_id""",
    "health_advisories": f"""WITH v AS {valid('air_quality')},
        prof AS (SELECT zone, upper(zone) AS zone_name, CAST(count(*) AS INTEGER) AS population,
                        CAST(count(DISTINCT sensor_id) AS INTEGER) AS num_schools FROM v GROUP BY zone),
        w AS (SELECT zone, aqi, time_bucket(INTERVAL 1 HOUR, event_time) - to_hours(CAST(r.k AS BIGINT)) AS window_start
              FROM v, range(10) r(k)),
        g AS (SELECT zone, window_start, window_start + INTERVAL 10 HOUR AS window_end,
                     CAST(sum(CAST(aqi AS DECIMAL(18,2))) AS DOUBLE) / count(aqi) AS rolling_avg_aqi
              FROM w GROUP BY zone, window_start)
        SELECT g.zone, zone_name, population, num_schools, window_start, window_end, rolling_avg_aqi
        FROM g JOIN prof USING (zone) WHERE rolling_avg_aqi > {ADVISORY_THRESHOLD}""",
    "eta_enriched": f"""SELECT bus_id, route_key AS route_id, lat, lon, speed_kmh, occupancy_pct,
        strftime(event_time, {ISO}) AS gps_timestamp, route_name, terminal, scheduled_arrival_time
        FROM {_gps_keyed()} g JOIN ({SQL_ROUTES}) r ON g.route_key = r.route_id""",
    "eta_misses": f"""SELECT record_id, bus_id, route_key FROM {_gps_keyed()} g
        WHERE route_key NOT IN (SELECT route_id FROM ({SQL_ROUTES}))""",
    "eta_counts": f"""SELECT count(r.route_id) AS joined,
        count(*) FILTER (WHERE r.route_id IS NULL) AS unmatched,
        count(*) FILTER (WHERE g.key IS NULL) AS missing_key
        FROM {_gps_keyed()} g LEFT JOIN ({SQL_ROUTES}) r ON g.route_key = r.route_id""",
    "aqi_alerts": _aqi_sql(),
    "gridlock_alerts": _gridlock_sql(),
    "bunching_alerts": "WITH " + _bunching_core() + """
        SELECT route_id, bus_id_1, bus_id_2, distance_m, continuous_proximity_sec, record_id,
               detected_at_event_time FROM bunch""",
    "incidents": _incidents_sql(),
    "latest_per_topic": f"""SELECT topic, rank, key, partition, "offset", timestamp FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY timestamp DESC, partition,
                                     "offset" DESC) AS rank FROM {envelopes()}) WHERE rank <= 120""",
    "retention": f"""WITH env AS {envelopes()},
        cat(topic, retention_ms) AS (VALUES {", ".join(f"('city.{f}', {RETENTION[f]})" for f in SQL_FEEDS)}),
        newest AS (SELECT topic, max(timestamp) AS m FROM env GROUP BY topic)
        SELECT env.topic, count(*) AS kept, min(timestamp) AS oldest_kept
        FROM env JOIN newest USING (topic) JOIN cat USING (topic)
        WHERE epoch_ms(timestamp) >= epoch_ms(m) - retention_ms GROUP BY env.topic""",
    "consumer_lag": f"""WITH env AS (SELECT * FROM {envelopes()} WHERE topic = 'city.traffic_signals'),
        cut AS (SELECT max(timestamp) - INTERVAL 1 DAY AS c FROM env)
        SELECT 'high_priority' AS "group", CAST(0 AS BIGINT) AS lag
        UNION ALL
        SELECT 'standard_priority', count(*) FROM env, cut WHERE timestamp > c""",
    "dedup": """SELECT DISTINCT sensor_id, event_time, record_id FROM (
        SELECT * FROM ({a}) UNION ALL SELECT * FROM ({a}))""".format(a=SQL_FEEDS["air_quality"]),
    "json_roundtrip": f"""SELECT ward_id AS key, meter_id, kwh_reading, voltage, power_factor,
        strftime(event_time, {ISO}) AS timestamp, event_time FROM ({SQL_FEEDS['smart_meters']})""",
}


def _stream_incidents() -> str:
    """Incidents up to the final watermark; those of pairs up to the freshness limit before it."""
    newest = " , ".join(f"(SELECT max(epoch_us(event_time) // 1000) FROM {valid(f)})"
                        for f in ("air_quality", "traffic_signals", "bus_gps"))
    return (f"SELECT * FROM ({_incidents_sql()}) WHERE detected_at_event_time <= least({newest}) - 30000 "
            f"- CASE WHEN incident_type = 'BUS_BUNCHING' THEN {BUNCH_FRESH_MS} ELSE 0 END")


def _jsonl_ingest() -> str:
    """Lines are numbered by record id. A cut line has lost its fields, the zone's end included."""
    number = lambda c: f"coalesce(CAST(CAST({c} AS DECIMAL(18,3)) AS VARCHAR), 'null')"
    line = ("'{\"sensor_id\":\"' || sensor_id || '\",\"zone\":\"' || zone || '\",\"pm25\":' || " + number("pm25")
            + " || ',\"pm10\":' || " + number("pm10") + " || ',\"no2\":' || " + number("no2")
            + " || ',\"aqi\":' || " + number("aqi")
            + f" || ',\"timestamp\":\"' || strftime(event_time, {ISO}) || '\"}}'")
    body, _ = _aqi_sql().replace("WITH RECURSIVE", "", 1).rsplit("SELECT n.sensor_id", 1)
    body = body.replace("WHERE aqi >", "WHERE record_id % 61 <> 7 AND aqi >", 1)
    return f"""
    WITH RECURSIVE {body.strip().rstrip(',')},
    fired AS (SELECT n.record_id FROM nx n JOIN chain USING (sensor_id, rn)),
    lines AS (SELECT *, {line} AS line, row_number() OVER (ORDER BY record_id) - 1 AS "offset",
                     record_id % 61 = 7 AS cut FROM {tagged('air_quality')})
    SELECT "offset", CASE WHEN cut THEN 'unknown' ELSE sensor_id END AS key,
           CASE WHEN cut THEN 'MALFORMED_JSON' ELSE error_reason END AS error_reason,
           CASE WHEN cut THEN substr(line, 1, 25) WHEN error_reason IS NOT NULL THEN line END AS original_record,
           record_id IN (SELECT record_id FROM fired) AS alerted
    FROM lines"""


def _stream_validation() -> str:
    """Per topic and key; the DLQ per source. Offsets are dense, a key has one partition."""
    good = " UNION ALL ".join(
        f"SELECT 'city.{f}' AS topic, 'city.{f}' AS source, CAST({KEYS[f]} AS VARCHAR) AS key, event_time FROM {valid(f)}"
        for f in SQL_FEEDS)
    return f"""SELECT topic, source, key, count(*) AS messages, CAST(1 AS BIGINT) AS partitions,
               min(event_time) AS first_time, max(event_time) AS last_time,
               CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS repeated
        FROM ({good} UNION ALL SELECT 'city.dlq', source_topic, key, NULL FROM {all_dlq()}) GROUP BY topic, source, key"""


def _stream_late() -> str:
    """Arrival by thirds of the time span, late ones a third on; behind the latest of earlier thirds."""
    return f"""WITH f AS ({SQL_FEEDS['air_quality']}),
        span AS (SELECT epoch_us(min(event_time)) AS lo, epoch_us(max(event_time)) AS hi FROM f),
        a AS (SELECT f.*, least(2, CAST(epoch_us(event_time) >= lo + round((hi - lo) / 3) AS INTEGER)
                     + CAST(epoch_us(event_time) >= lo + round((hi - lo) * 2 / 3) AS INTEGER)
                     + CAST(record_id % 37 = 5 AS INTEGER)) AS slice FROM f, span),
        m AS (SELECT s.slice, (SELECT max(event_time) FROM a WHERE a.slice < s.slice) AS newest
              FROM (SELECT DISTINCT slice FROM a) s)
        SELECT sensor_id AS key, CASE WHEN event_time < newest - INTERVAL 45 MINUTE THEN 'LATE_EVENT' END AS error_reason,
               zone, strftime(event_time, {ISO}) AS timestamp
        FROM a JOIN m USING (slice)"""


_TRAFFIC_ENV = f"""(SELECT * FROM {envelopes()} WHERE topic = 'city.traffic_signals')"""

ORACLE.update({
    "lag_series": f"""WITH env AS {_TRAFFIC_ENV},
        span AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM env),
        s AS (SELECT r.k AS sample,
                     lo + to_microseconds(CAST(((epoch_us(hi) - epoch_us(lo)) / 5) * r.k AS BIGINT)) AS sample_time
              FROM span, range(6) r(k)),
        p AS (SELECT sample, sample_time, 'high_priority' AS "group", sample_time AS read_until FROM s
              UNION ALL
              SELECT sample, sample_time, 'standard_priority', sample_time - INTERVAL 1 DAY FROM s)
        SELECT sample, "group", (SELECT count(*) FROM env WHERE timestamp > p.read_until
                                 AND timestamp <= p.sample_time) AS lag FROM p""",
    "consumer_counts": f"""WITH env AS {_TRAFFIC_ENV},
        cut AS (SELECT max(timestamp) - INTERVAL 1 DAY AS c FROM env)
        SELECT 'high_priority' AS consumer, count(*) AS processed FROM env
        UNION ALL
        SELECT 'standard_priority-' || CAST(CAST(partition // 2 AS INTEGER) + 1 AS VARCHAR), count(*)
        FROM env, cut WHERE timestamp <= c GROUP BY 1""",
    "stream_ward_energy": f"""SELECT *, strftime(window_start, '%Y-%m-%d') AS date,
               total_kwh_consumed AS topic_total_kwh_consumed, avg_power_factor AS topic_avg_power_factor,
               peak_voltage AS topic_peak_voltage FROM ({ORACLE['ward_energy']})
        WHERE window_end <= (SELECT max(event_time) FROM {valid('smart_meters')}) - INTERVAL 45 MINUTE""",
    "stream_health_advisories": ORACLE["health_advisories"],
    "stream_dedup": ORACLE["dedup"],
    "jsonl_ingest": _jsonl_ingest(),
    "stream_validation": _stream_validation(),
    "stream_late": _stream_late(),
    "stream_incidents": _stream_incidents(),
})
