"""Plan shape: pruning and pushdown reach the scan, lookups are broadcast only after a
size check, detectors never plan a cartesian product or a per-key collect."""

from civicstream.plans import queries as Q
from civicstream.plans import streams

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_scan(spark):
    p = plan(Q.ward_energy(spark, SF))
    # meter feed needs ts, event_type, value, props (user_id for meter id) - not event_id
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln or "ReadSchema" in ln]
    assert scan and all("event_id" not in ln for ln in scan)


def test_lookup_is_broadcast_after_check(spark):
    assert "BroadcastHashJoin" in plan(Q.eta_enriched(spark, SF))


def test_detectors_no_cartesian_or_collect(spark):
    for fn in (Q.aqi_alerts, Q.gridlock_alerts, Q.bunching_alerts):
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert "collect_list" not in p and "collect_set" not in p


def test_cooldown_makes_no_call_per_group(spark):
    """Array code gets many (key, chunk) groups at once: a call for each cost milliseconds a group."""
    p = plan(Q.aqi_alerts(spark, SF))
    assert "MapInArrow" in p and "FlatMapGroupsInArrow" not in p and "FlatMapCoGroupsInArrow" not in p


def test_jsonl_ingest_makes_no_call_per_group(spark):
    p = plan(streams.jsonl_ingest(spark, "/root/testdata/sf0.001"))
    assert "MapInArrow" in p and "FlatMapGroupsInArrow" not in p and "FlatMapCoGroupsInArrow" not in p


def test_latest_per_topic_limits_before_shuffle(spark):
    p = Q.latest_per_topic(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p
