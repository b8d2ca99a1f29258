"""Refreshes that fail midway, repeated loads, and lookups that read nothing."""

import pytest
from pyspark.sql import functions as F

from netvigil.session import fresh_path
from netvigil.sinks import tables, versions
from netvigil.sources import documents
from netvigil.sources.versions import current, read_current, read_published


def failing(spark, rows=1000):
    """A table whose writing fails after some of its tasks are done."""
    broken = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("disk lost"))).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 8).select(broken.cast("long").alias("id"))


def test_a_failed_refresh_leaves_the_old_version(spark):
    root = fresh_path(spark, "serving")
    versions.publish({"a": spark.range(3), "b": spark.range(4)}, root)
    for broken in ({"a": spark.range(9), "b": failing(spark)}, {"a": failing(spark)}):
        with pytest.raises(Exception, match="disk lost"):
            versions.publish(broken, root)
        assert [read_current(spark, root, name).count() for name in "ab"] == [3, 4]  # neither, not one of two
    versions.publish({"a": spark.range(9)}, root)
    assert [read_current(spark, root, name).count() for name in "ab"] == [9, 4] and current(spark, root)[0] == 2


def test_a_reader_keeps_its_version_until_old_ones_are_removed(spark):
    path = f"{fresh_path(spark, 'serving')}/t"
    assert read_published(spark, path) is None
    tables.refresh_serving(spark.range(3), path)
    reader = read_published(spark, path)
    tables.refresh_serving(spark.range(5), path)
    assert reader.count() == 3 and read_published(spark, path).count() == 5
    assert not tables.refresh_serving(spark.range(0), path)
    assert read_published(spark, path).count() == 5
    root = path.rpartition("/")[0]
    assert versions.remove_old(spark, root, keep=2) == []
    assert len(versions.remove_old(spark, root, keep=1)) == 1
    assert read_published(spark, path).count() == 5


def test_a_manifest_becomes_current_with_its_tables(spark):
    root = fresh_path(spark, "serving")
    manifest = ("log", lambda found: tables.rows_per_output(found))
    versions.publish({"a": spark.range(3), "b": spark.range(0)}, root, manifest)
    assert [tuple(r) for r in read_current(spark, root, "log").collect()] == [("a", 3)]
    with pytest.raises(Exception, match="disk lost"):
        versions.publish({"a": failing(spark)}, root, manifest)
    assert read_current(spark, root, "log").count() == 1


def test_a_repeated_run_leaves_one_copy(spark):
    path = fresh_path(spark, "log")
    rows = lambda n: spark.range(n).withColumn("source_ip", F.lit("10.0.0.1"))
    tables.append_predictions(rows(5), path, "monday")
    tables.append_predictions(rows(3), path, "tuesday")
    with pytest.raises(Exception, match="disk lost"):
        tables.append_predictions(failing(spark), path, "monday")
    tables.append_predictions(rows(4), path, "monday")
    found = spark.read.parquet(path).groupBy("run").count().collect()
    assert {r.run: r["count"] for r in found} == {"monday": 4, "tuesday": 3}


def test_a_repeated_load_leaves_one_copy(spark, make_raw):
    path = fresh_path(spark, "documents")
    for load in ("a", "b", "a"):
        documents.load_documents(make_raw(dict(source_ip="10.0.0.9"), {}), path, load)
    found = documents.read_documents(spark, path)
    assert found.count() == 4 and found.columns == documents.DOCUMENT_SCHEMA.names


def scanned_rows(df) -> int:
    """Rows that the file scan of a plan gave, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_an_absent_address_reads_no_row(spark):
    path = fresh_path(spark, "lookup")
    tables.write_lookup(spark.range(20_000).selectExpr("concat('10.', id % 100 * 2, '.', id DIV 100, '.1') AS source_ip", "id AS score"), path)
    # Without the index of pages only ranges and bloom filters of row groups can tell.
    stored = spark.read.option("parquet.filter.columnindex.enabled", "false").parquet(path)
    assert scanned_rows(stored.where("source_ip = '10.4.7.1'")) > 0
    assert scanned_rows(stored.where("source_ip = '10.5.7.1'")) == 0  # within the ranges, never seen
