"""VAL-1..8 and PRJ-1: every rule at, inside and just outside its bound; nulls; empty
ids; precedence; malformed JSON; DLQ wrapping and reports."""

import pytest

from civicstream.operators import dlq, validate
from helpers import parsed

BUS = dict(bus_id="B1", route_id="R1", lat=19.0, lon=72.8, speed_kmh=30.0,
           occupancy_pct=50, timestamp="2026-07-01T06:00:00Z")
AIR = dict(sensor_id="S1", zone="Z01", pm25=10.0, pm10=20.0, no2=5.0, aqi=100.0,
           timestamp="2026-07-01T06:00:00Z")
TRAFFIC = dict(junction_id="J1", zone="Z01", vehicle_count=10, avg_wait_sec=30.0,
               signal_phase="GREEN", timestamp="2026-07-01T06:00:00Z")
METER = dict(meter_id="M1", ward_id="W01", kwh_reading=1.0, voltage=230.0,
             power_factor=0.9, timestamp="2026-07-01T06:00:00Z")
BASE = {"bus_gps": BUS, "air_quality": AIR, "traffic_signals": TRAFFIC, "smart_meters": METER}


def reasons(spark, feed, variants):
    recs = [{**BASE[feed], **v} if isinstance(v, dict) else v for v in variants]
    df = validate.with_error_reason(parsed(spark, recs, feed), feed)
    got = {r["offset"]: r["error_reason"] for r in df.select("offset", "error_reason").collect()}
    return [got[i] for i in range(len(recs))]


def test_bus_rules(spark):
    cases = [
        ({}, None),
        ({"lat": 90}, None), ({"lat": 90.0001}, "IMPOSSIBLE_GPS_COORDINATES"),
        ({"lat": None}, "NULL_COORDINATES"), ({"lon": -180}, None),
        ({"lon": -180.0001}, "IMPOSSIBLE_GPS_COORDINATES"),
        ({"speed_kmh": 0}, None), ({"speed_kmh": 120}, None),
        ({"speed_kmh": 120.1}, "SPEED_OUT_OF_RANGE"), ({"speed_kmh": -0.1}, "SPEED_OUT_OF_RANGE"),
        ({"speed_kmh": None}, "SPEED_OUT_OF_RANGE"),
        ({"occupancy_pct": 0}, None), ({"occupancy_pct": 100}, None),
        ({"occupancy_pct": 120.0 - 20.0}, None),
        ({"occupancy_pct": 101}, "OCCUPANCY_OUT_OF_RANGE"),
        ({"occupancy_pct": None}, "OCCUPANCY_OUT_OF_RANGE"),
        ({"route_id": ""}, "MISSING_ID_FIELD"), ({"bus_id": None}, "MISSING_ID_FIELD"),
        # precedence: first failing rule wins
        ({"lat": None, "speed_kmh": 300, "bus_id": ""}, "NULL_COORDINATES"),
        ({"lat": 95, "speed_kmh": 300}, "IMPOSSIBLE_GPS_COORDINATES"),
        ({"speed_kmh": "fast"}, "SPEED_OUT_OF_RANGE"),
    ]
    assert reasons(spark, "bus_gps", [c for c, _ in cases]) == [r for _, r in cases]


def test_air_rules(spark):
    cases = [
        ({}, None), ({"aqi": 0}, None), ({"aqi": 500}, None),
        ({"aqi": 500.1}, "AQI_OUT_OF_RANGE"), ({"aqi": -1}, "AQI_OUT_OF_RANGE"),
        ({"aqi": None}, "NULL_AQI"),
        ({"pm25": -1, "no2": None}, "NEGATIVE_OR_MISSING_PM25"),
        ({"pm10": None}, "NEGATIVE_OR_MISSING_PM10"), ({"no2": -0.5}, "NEGATIVE_OR_MISSING_NO2"),
        ({"zone": ""}, "MISSING_ID_FIELD"), ({"aqi": None, "pm25": -1}, "NULL_AQI"),
    ]
    assert reasons(spark, "air_quality", [c for c, _ in cases]) == [r for _, r in cases]


def test_traffic_rules(spark):
    cases = [
        ({}, None), ({"vehicle_count": -1}, "NEGATIVE_VEHICLE_COUNT"),
        ({"vehicle_count": None}, "NEGATIVE_VEHICLE_COUNT"),
        ({"avg_wait_sec": 600}, None), ({"avg_wait_sec": 600.1}, "WAIT_TIME_OUT_OF_RANGE"),
        ({"avg_wait_sec": -1}, "WAIT_TIME_OUT_OF_RANGE"),
        ({"signal_phase": None}, "INVALID_SIGNAL_PHASE"),
        ({"signal_phase": "green"}, "INVALID_SIGNAL_PHASE"),
        ({"signal_phase": "AMBER"}, None), ({"junction_id": ""}, "MISSING_ID_FIELD"),
    ]
    assert reasons(spark, "traffic_signals", [c for c, _ in cases]) == [r for _, r in cases]


def test_meter_rules(spark):
    cases = [
        ({}, None), ({"kwh_reading": 0}, None), ({"kwh_reading": -0.01}, "NEGATIVE_KWH_READING"),
        ({"voltage": 180}, None), ({"voltage": 260}, None),
        ({"voltage": 179.9}, "VOLTAGE_OUT_OF_RANGE"), ({"voltage": None}, "VOLTAGE_OUT_OF_RANGE"),
        ({"power_factor": 1}, None), ({"power_factor": 1.01}, "POWER_FACTOR_OUT_OF_RANGE"),
        ({"power_factor": -0.01}, "POWER_FACTOR_OUT_OF_RANGE"),
        ({"ward_id": None}, "MISSING_ID_FIELD"),
    ]
    assert reasons(spark, "smart_meters", [c for c, _ in cases]) == [r for _, r in cases]


def test_malformed_line_goes_to_dlq(spark):
    got = reasons(spark, "smart_meters", ["{bad", "[1, 2]", {}])
    assert got == ["MALFORMED_JSON", "MALFORMED_JSON", None]


def test_dlq_wrap_keeps_raw_record_and_default_key(spark):
    recs = [{**METER, "voltage": 10.0}, {**METER, "ward_id": None, "kwh_reading": -1.0}]
    t = validate.with_error_reason(_with_value(spark, recs), "smart_meters")
    d = validate.dlq_records(t, "smart_meters").orderBy("error_reason").collect()
    assert [r.error_reason for r in d] == ["NEGATIVE_KWH_READING", "VOLTAGE_OUT_OF_RANGE"]
    assert d[0].key == "unknown" and d[1].key == "W01"
    assert '"voltage": 10.0' in d[1].original_record
    assert d[0].source_topic == "city.smart_meters"


def _with_value(spark, recs):
    from civicstream.functions.jsoncols import parse_value
    from civicstream.schemas import RAW_SCHEMAS
    from helpers import messages
    return parse_value(messages(spark, recs, "smart_meters"), RAW_SCHEMAS["smart_meters"],
                       keep_raw=True)


def test_split_and_routing_never_drop(spark):
    recs = [METER, {**METER, "voltage": 0.0}, {**METER, "kwh_reading": -2.0}, "{bad"]
    t = validate.with_error_reason(_with_value(spark, recs), "smart_meters")
    c = validate.split_counts(t, "smart_meters").collect()[0]
    assert (c.sent, c.routed_to_dlq) == (1, 3)
    r = validate.routed(t, "smart_meters")
    assert r.count() == 4
    assert r.where("destination = 'city.dlq'").count() == 3


def test_dlq_reports(spark):
    rows = [("city.bus_gps", "A")] * 3 + [("city.air_quality", "B")]
    d = spark.createDataFrame(rows, "source_topic string, error_reason string")
    rep = dlq.by_reason(d).collect()
    assert [(r.error_reason, r.cnt, r.pct) for r in rep] == [("A", 3, 75.0), ("B", 1, 25.0)]
    empty = spark.createDataFrame([], "source_topic string, error_reason string")
    assert dlq.by_reason(empty).count() == 0
    by_t = dlq.by_topic(d).collect()
    assert [(r.source_topic, r.cnt) for r in by_t] == [("city.air_quality", 1), ("city.bus_gps", 3)]
    cat = dlq.rule_catalog(spark)
    assert cat.count() == 19
    hits = dlq.catalog_hits(cat, spark.createDataFrame(
        [("city.bus_gps", "SPEED_OUT_OF_RANGE")], "source_topic string, error_reason string"))
    assert hits.where("hits = 0").count() == 18


@pytest.mark.parametrize("value,expected", [("2026-07-01T06:00:00Z", True), ("not a time", False)])
def test_event_time_parse_is_null_safe(spark, value, expected):
    df = _with_value(spark, [{**METER, "timestamp": value}])
    assert (df.collect()[0].event_time is not None) == expected
