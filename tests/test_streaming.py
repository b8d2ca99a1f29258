"""File streams of raw flows."""

import pytest

from netvigil.operators import clean
from netvigil.session import fresh_path
from netvigil.sources.flows import read_raw_flows
from netvigil.streaming import flows as streams


def land(raw, folder):
    """One more CSV file set in the landing folder."""
    raw.coalesce(1).write.mode("append").option("header", True).csv(folder)


@pytest.fixture
def blacklist(spark):
    path = fresh_path(spark, "blacklist")
    spark.createDataFrame([("10.6.6.6",)], "source_ip string").write.parquet(path)
    return path


def test_two_arrivals(spark, make_raw, blacklist, rows_of):
    folder, out, state = (fresh_path(spark, n) for n in ("landing", "allowed", "state"))
    run = lambda: streams.run_allowed(
        streams.clean_stream(streams.stream_raw_flows(spark, folder)), blacklist, out, state)
    land(make_raw({}, dict(source_ip="10.6.6.6"), dict(flow_duration="-4")), folder)
    run()
    assert spark.read.parquet(out).count() == 1
    land(make_raw(dict(source_ip="10.0.0.8"), dict(source_ip="10.6.6.6")), folder)
    run()
    run()  # nothing new arrived
    batch = clean.with_time_parts(clean.valid_flows(clean.typed_flows(read_raw_flows(spark, folder))))
    expected = batch.where("source_ip <> '10.6.6.6'")
    columns = sorted(expected.columns)
    assert rows_of(spark.read.parquet(out), *columns) == rows_of(expected, *columns)


def test_incident_audit_survives_a_lost_state(spark, make_raw, blacklist):
    folder, out = fresh_path(spark, "landing"), fresh_path(spark, "incidents")
    land(make_raw({}, dict(source_ip="10.6.6.6", attack_type="Botnet"), dict(source_ip="10.6.6.6", attack_type="odd")), folder)
    flows = streams.clean_stream(streams.stream_raw_flows(spark, folder))
    for _ in range(2):  # the second run repeats batch 0 from a new checkpoint
        streams.run_incident_audit(flows, blacklist, out, fresh_path(spark, "state"), policy="drop")
    rows = spark.read.parquet(out).select("source_ip", "technique_id", "action_taken", "status").collect()
    assert sorted(tuple(r) for r in rows) == [
        ("10.6.6.6", "T1498", "drop", "ENFORCED"), ("10.6.6.6", "T1584", "drop", "ENFORCED")]


def test_list_that_changes_within_a_run(spark, make_raw, blacklist, monkeypatch):
    """Three batches in one run; after the first the list gets an address that the others then miss."""
    folder, out = fresh_path(spark, "landing"), fresh_path(spark, "allowed")
    for _ in range(3):
        land(make_raw({}, dict(source_ip="10.7.7.7")), folder)
    plain = streams.exclude_listed

    def then_listed(batch, listed):
        result = plain(batch, listed)
        spark.createDataFrame([("10.7.7.7",)], "source_ip string").write.mode("append").parquet(blacklist)
        return result

    monkeypatch.setattr(streams, "exclude_listed", then_listed)
    stream = streams.clean_stream(streams.stream_raw_flows(spark, folder, files_per_batch=1))
    streams.run_allowed(stream, blacklist, out, fresh_path(spark, "state"))
    assert spark.read.parquet(out).where("source_ip = '10.7.7.7'").count() == 1
    assert spark.read.parquet(out).where("source_ip <> '10.7.7.7'").count() == 3


def test_entropy_counts_late_rows(spark, make_raw):
    folder, out, state = (fresh_path(spark, n) for n in ("landing", "entropy", "state"))
    at = lambda time, length: dict(timestamp=f"2024-01-01 {time}", packet_length=str(length))
    run = lambda: streams.run_entropy_counts(
        streams.clean_stream(streams.stream_raw_flows(spark, folder)), out, state)
    found = lambda: {str(r["window_start"])[11:16]: (r["flows"], r["entropy"])
                     for r in streams.read_entropy(spark, out).collect()}
    land(make_raw(at("10:05:00", 1), at("11:00:00", 5), at("20:30:00", 9)), folder)
    run()
    assert found() == {"10:00": (1, 0.0), "11:00": (1, 0.0), "20:00": (1, 0.0)}
    land(make_raw(at("10:10:00", 2), at("11:59:00", 5)), folder)  # far behind what was seen
    run()
    assert found() == {"10:00": (2, 1.0), "11:00": (2, 0.0), "20:00": (1, 0.0)}


def test_backlog_is_worked_off_in_batches(spark, make_raw):
    folder, seen = fresh_path(spark, "landing"), []
    for i in range(3):
        land(make_raw(dict(source_ip=f"10.0.0.{i}")), folder)
    stream = streams.stream_raw_flows(spark, folder, files_per_batch=1)
    streams.run_batches(stream, lambda batch, _: seen.append(batch.count()), fresh_path(spark, "state"))
    assert [n for n in seen if n] == [1, 1, 1]
