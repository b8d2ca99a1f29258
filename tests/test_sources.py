"""Synthetic generator, serving readers, sinks."""

from datetime import datetime

from pyspark.sql import functions as F

from netvigil.operators import clean
from netvigil.session import fresh_path
from netvigil.sinks import tables
from netvigil.sources import documents, synthetic, versions
from netvigil.sources.documents import read_serving
from netvigil.sources.flows import inline_rows, sum_probe, table_counts


def test_generated_rows_follow_their_class(spark):
    raw = synthetic.generate_range(spark, 4000, seed=7)
    flows = clean.typed_flows(raw)
    assert clean.valid_flows(flows).count() == 4000
    mix = {r["attack_type"]: r["n"] / 40 for r in flows.groupBy("attack_type").agg(F.count("*").alias("n")).collect()}
    for name, weight in synthetic.CLASS_MIX:
        assert abs(mix[name] - weight) < 4
        mine = flows.where(F.col("attack_type") == name)
        for column, ranges in (("flow_duration", synthetic.DURATION), ("packet_count", synthetic.PACKETS),
                               ("packet_length", synthetic.LENGTH)):
            low, high = mine.agg(F.min(column), F.max(column)).first()
            assert ranges[name][0] <= low <= high <= ranges[name][1]
        assert {r[0] for r in mine.select("protocol").distinct().collect()} == set(synthetic.PROTOCOL_CHOICES[name])
        assert {r[0] for r in mine.select("severity").distinct().collect()} == set(synthetic.SEVERITY_CHOICES[name])
    assert flows.where("total_bytes <> packet_count * packet_length").count() == 0
    assert flows.select("destination_ip").distinct().count() == synthetic.SERVERS


def test_generated_clock_moves_forward(spark):
    rows = synthetic.generate_flows(spark.range(1000)).collect()
    stamps = sorted(datetime.fromisoformat(r["timestamp"]) for r in rows)
    assert stamps[0] >= datetime(2026, 8, 26, 10) and 100 <= (stamps[-1] - stamps[0]).total_seconds() <= 110


def test_generation_does_not_depend_on_partitions(spark, rows_of):
    one, many = (synthetic.generate_range(spark, 300, partitions=p) for p in (1, 7))
    assert rows_of(one) == rows_of(many)
    assert rows_of(one) != rows_of(synthetic.generate_range(spark, 300, seed=43))


def test_probes(spark):
    assert tuple(sum_probe(spark.range(1, 100_001, 1, 4), "id").first()) == (100_000, 5_000_050_000)
    listed = inline_rows(spark, [(1, "TCP")], "id long, protocol string")
    counted = table_counts({"listed": listed, "empty": listed.limit(0)})
    assert {tuple(r) for r in counted.collect()} == {("listed", 1, 2), ("empty", 0, 2)}


def test_serving_falls_back_to_the_mirror(spark):
    root = fresh_path(spark, "serving")
    table = spark.createDataFrame([(1, None, datetime(2024, 1, 2, 3, 4, 5))], "a int, b string, t timestamp")
    assert read_serving(spark, f"{root}/t", f"{root}/t.json") is None
    tables.json_mirror(table, f"{root}/t.json")
    assert spark.read.text(f"{root}/t.json").first()[0] == '{"a":1,"b":null,"t":"2024-01-02 03:04:05"}'
    assert read_serving(spark, f"{root}/t", f"{root}/t.json").first()["t"] == "2024-01-02 03:04:05"
    tables.write_table(table.limit(0), f"{root}/t")  # present but empty
    assert read_serving(spark, f"{root}/t", f"{root}/t.json").first()["a"] == 1
    tables.write_table(table, f"{root}/t")
    assert read_serving(spark, f"{root}/t", f"{root}/t.json").schema["t"].dataType.typeName() == "timestamp"


def test_empty_refresh_changes_nothing(spark):
    path = fresh_path(spark, "refresh")
    assert tables.refresh_serving(spark.range(3), path)
    assert not tables.refresh_serving(spark.range(0), path)
    assert versions.read_published(spark, path).count() == 3


def test_lookup_copy_is_sorted(spark):
    path = fresh_path(spark, "lookup")
    tables.write_lookup(spark.range(100).selectExpr("concat('10.0.0.', id) AS source_ip"), path)
    for part in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.collect_list("source_ip").alias("ips")).collect():
        assert part["ips"] == sorted(part["ips"])


def test_documents_keep_numbers_with_a_fraction(spark, make_raw):
    raw = make_raw(dict(packet_length="12.0", total_bytes="7.9", packet_count="1e3", flow_duration="x"))
    row = documents.to_documents(raw).first()
    assert (row["packet_length"], row["total_bytes"], row["packet_count"], row["flow_duration"]) == (12, 7, 1000, None)
