"""The command line over a small generated log."""

from netvigil.__main__ import parser, run
from netvigil.session import fresh_path


def test_jobs_in_order(spark):
    raw, out = fresh_path(spark, "cli-raw"), fresh_path(spark, "cli-out")
    call = lambda *words: run(spark, parser().parse_args(words))
    assert call("generate", "--out", raw, "--rows", "1500") is None
    assert call("etl", "--raw", raw, "--out", out).first()["raw_records"] == 1500
    assert call("analytics", "--out", out, "--serving").where("records = 0").count() == 0
    assert call("train", "--out", out).count() == 2
    assert call("evaluate", "--out", out).count() == 5
    assert call("predict", "--out", out, "--limit", "3", "--store").count() == 3
    assert call("publish", "--out", out, "--force").where("collection = 'TOTAL'").count() == 1
    ip = spark.read.parquet(f"{out}/ip_risk_scores.parquet").first()["source_ip"]
    assert call("lookup", "--out", out, "--ip", ip).count() == 1
    assert call("lookup", "--out", out, "--ip", "0.0.0.0").isEmpty()
