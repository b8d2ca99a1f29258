"""Cleaning: typing, validity, duplicates."""

import random

from pyspark.sql import functions as F

from netvigil.operators import clean
from netvigil.schema import FLOW_KEY, FLOW_SCHEMA, TIMESTAMP_FORMAT
from netvigil.sources.documents import load_documents, read_documents
from netvigil.sinks import tables
from netvigil.sources.flows import read_raw_flows, read_raw_records, rejected_rows, write_raw_flows
from netvigil.session import fresh_path


def dirty(make_raw):
    return make_raw(
        dict(),
        dict(source_ip=None), dict(source_ip="  "), dict(destination_ip=""), dict(attack_type=" "),
        dict(flow_duration="-1"), dict(packet_length="n/a"), dict(total_bytes=None), dict(packet_count=""),
        dict(source_ip="10.0.0.2", timestamp="yesterday"),
        dict(source_ip=" 10.0.0.3 ", protocol=" udp ", severity=" Low"),
        dict(source_ip="10.0.0.4", packet_length="12.9"),
        dict(attack_type="Botnet"),
    )


def test_dirty_rows(spark, make_raw):
    flows = clean.clean_flows(dirty(make_raw))
    assert flows.schema.names == FLOW_SCHEMA.names
    rows = {r["source_ip"]: r for r in flows.collect()}
    assert set(rows) == {"10.0.0.1", "10.0.0.2", "10.0.0.3", "10.0.0.4"}
    assert rows["10.0.0.1"]["attack_type"] == "Botnet"  # the smaller of two duplicates
    assert rows["10.0.0.1"]["hour"] == 10 and rows["10.0.0.1"]["day_of_week"] == 1
    assert rows["10.0.0.2"]["timestamp"] is None and rows["10.0.0.2"]["hour"] is None
    assert rows["10.0.0.3"]["protocol"] == "UDP" and rows["10.0.0.3"]["severity"] == "Low"
    assert rows["10.0.0.4"]["packet_length"] == 12


def test_both_funnels_agree(make_raw):
    raw = dirty(make_raw)
    funnel = clean.clean_funnel(raw).first()
    assert tuple(funnel) == (13, 5, 4, 8, 1, 9)
    assert clean.written_funnel(raw, clean.clean_flows(raw)).first() == funnel


def test_funnel_of_nothing(make_raw):
    assert tuple(clean.clean_funnel(make_raw({}).limit(0)).first()) == (0, 0, 0, 0, 0, 0)


def test_time_parsing_equals_parsing_by_pattern(spark):
    texts = ["2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-13-01 00:00:00", "2024-01-01 24:00:00",
             "2024-01-01", "2024-01-01T00:00:00", " 2024-01-01 00:00:00", "2024-1-01 00:00:00", "", None,
             "2024-01-01 00:00:5Z", "2024-01-01 10:61:00", "1969-12-31 23:59:59", "2024-01-01 00:00:00.5"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = F.try_to_timestamp("t", F.lit(TIMESTAMP_FORMAT))
    for row in frame.select("t", clean.parse_time(F.col("t")).alias("a"), pattern.alias("b")).collect():
        assert row["a"] == row["b"], row


def test_duplicates_against_brute_force(spark, make_raw):
    rng = random.Random(5)
    rows = [dict(source_ip=f"10.0.0.{rng.randrange(3)}", flow_duration=str(rng.randrange(2)),
                 timestamp=rng.choice(["2024-01-01 00:00:00", "bad"]), attack_type=rng.choice(["DDoS", "Botnet"]),
                 severity=rng.choice(["Low", None]), packet_count=str(rng.randrange(3))) for _ in range(200)]
    # one record makes up a third of the logs
    rows += [dict(source_ip="10.9.9.9")] * 100
    valid = clean.valid_flows(clean.typed_flows(make_raw(*rows)))
    best = {}
    for r in valid.collect():
        key = tuple(r[k] for k in FLOW_KEY)
        rank = (r["attack_type"], r["severity"] or "", r["packet_length"], r["packet_count"])
        best[key] = min(best.get(key, rank), rank)
    got = {tuple(r[k] for k in FLOW_KEY): (r["attack_type"], r["severity"] or "", r["packet_length"], r["packet_count"])
           for r in clean.deduplicate(valid).collect()}
    assert got == best


def test_duplicates_are_dropped_before_the_shuffle(make_raw):
    plan = clean.deduplicate(clean.valid_flows(clean.typed_flows(make_raw({}))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") >= 1 and plan.count("Exchange") == 1


def test_csv_keeps_blanks(spark, make_raw):
    path = fresh_path(spark, "csv")
    write_raw_flows(make_raw(dict(protocol=" tcp", source_ip=" a ")), path)
    row = read_raw_flows(spark, path).first()
    assert row["protocol"] == " tcp" and row["source_ip"] == " a "


def test_documents_append_and_keep_nulls(spark, make_raw):
    path = fresh_path(spark, "docs")
    raw = make_raw(dict(flow_duration="n/a", source_ip="", severity="NULL"), dict(protocol=" tcp"))
    load_documents(raw, path)
    load_documents(raw, path)
    documents = read_documents(spark, path)
    assert documents.count() == 4
    broken = documents.where("flow_duration IS NULL").first()
    assert broken["source_ip"] is None and broken["severity"] is None and broken["total_bytes"] == 500
    assert spark.read.text(path).where("value LIKE '%\"source_ip\":null%'").count() == 2


def test_csv_columns_are_found_by_name(spark):
    folder = fresh_path(spark, "csv")
    header = "severity,source_ip,extra,timestamp,destination_ip,protocol,flow_duration,packet_length,total_bytes,packet_count,attack_type"
    row = "High,10.0.0.1,x,2024-01-07 10:30:00,172.16.1.1,TCP,1,2,3,4,DDoS"
    spark.createDataFrame([(header,), (row,)], "line string").coalesce(1).write.text(folder)
    raw = read_raw_flows(spark, folder)
    assert raw.first().asDict()["severity"] == "High" and raw.first()["total_bytes"] == "3"
    assert clean.clean_flows(raw).first()["day_of_week"] == 1


def test_csv_files_with_another_header_are_refused(spark):
    import pytest

    folder = fresh_path(spark, "csv")
    names = "timestamp,source_ip,destination_ip,protocol,flow_duration,packet_length,total_bytes,packet_count,attack_type,severity"
    for header in (names, names.replace("source_ip,destination_ip", "destination_ip,source_ip")):
        lines = [(header,), ("2024-01-07 10:30:00,a,b,TCP,1,2,3,4,DDoS,High",)]
        spark.createDataFrame(lines, "line string").coalesce(1).write.mode("append").text(folder)
    with pytest.raises(Exception, match="(?i)header"):
        clean.clean_flows(read_raw_flows(spark, folder)).collect()


def test_lines_that_are_no_records(spark):
    folder = fresh_path(spark, "csv")
    header = "timestamp,source_ip,destination_ip,protocol,flow_duration,packet_length,total_bytes,packet_count,attack_type,severity"
    good = "2024-01-07 10:30:00,a,b,TCP,1,2,3,4,DDoS,High"
    short, long = "2024-01-07 10:30:00,a,b,TCP,1,2,3", good + ",x,y"
    invalid = good.replace(",1,2,3,4", ",-1,2,3,4")
    for lines in ([good, short, good, long], [short, invalid], []):
        spark.createDataFrame([(line,) for line in [header, *lines]], "line string").coalesce(1).write.mode("append").text(folder)
    records = read_raw_records(spark, folder)
    assert sorted(map(tuple, rejected_rows(records).collect())) == sorted(
        [("too few fields", short), ("too few fields", short), ("too many fields", long)])
    assert rejected_rows(records).count() == 3
    flows, counts = clean.observed_clean(records)
    assert tables.write_table(flows, fresh_path(spark, "clean")).count() == 1
    assert clean.observed_funnel(spark, counts).first().asDict() == dict(
        raw_records=6, valid_records=2, clean_records=1, rejected_records=3, invalid_dropped=4, duplicates_dropped=1, total_dropped=5)


def test_the_observed_funnel_equals_the_plain_one_with_one_scan(spark, make_raw):
    raw = make_raw({}, {}, dict(source_ip=""), dict(flow_duration="-1"), dict(attack_type="Botnet"), dict(total_bytes="7"))
    path = fresh_path(spark, "csv")
    write_raw_flows(raw, path)
    flows, counts = clean.observed_clean(read_raw_records(spark, path))
    assert flows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    stored = tables.write_table(flows, fresh_path(spark, "clean"))
    assert sorted(stored.collect()) == sorted(clean.clean_flows(raw).collect())
    observed = clean.observed_funnel(spark, counts).drop("rejected_records").first()
    assert observed == clean.clean_funnel(raw).first()


def test_an_empty_log_has_a_funnel(spark, make_raw):
    path = fresh_path(spark, "csv")
    write_raw_flows(make_raw({}).limit(0).coalesce(1), path)
    flows, counts = clean.observed_clean(read_raw_records(spark, path))
    tables.write_table(flows, fresh_path(spark, "clean"))
    assert set(clean.observed_funnel(spark, counts).first()) == {0}
