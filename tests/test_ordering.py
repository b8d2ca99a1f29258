"""Row numbers and moving averages in blocks, against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from netvigil.operators import entropy
from netvigil.operators.ordering import moving, numbered


def test_rows_are_numbered_in_order(spark):
    values = random.Random(2).sample(range(10**6), 3000)
    table = spark.createDataFrame([(v, str(v)) for v in values], "v long, s string").repartition(7)
    got = numbered(table, "v").collect()
    assert {r.v: r.row_no for r in got} == {v: i for i, v in enumerate(sorted(values))} and all(r.s == str(r.v) for r in got)
    assert numbered(table.limit(0), "v").count() == 0


@pytest.mark.parametrize("rows, block", [(1, 5), (20, 20), (20, 33), (7, 10_000)])
def test_moving_average_in_blocks(spark, rows, block):
    values = [random.Random(3).random() for _ in range(500)]
    table = spark.createDataFrame(list(enumerate(values)), "t int, h double").repartition(9)
    got = {r.t: (r.mean, r.n) for r in moving(table, "t", rows, block, mean=F.avg("h"), n=F.count("h")).collect()}
    for t in range(len(values)):
        frame = values[max(0, t + 1 - rows):t + 1]
        assert got[t][1] == len(frame) and abs(got[t][0] - sum(frame) / len(frame)) < 1e-12
    assert len(got) == 500


def test_drift_has_no_window_over_everything(make_flows):
    from datetime import datetime, timedelta

    at = lambda i: dict(timestamp=datetime(2024, 1, 1) + timedelta(seconds=i), packet_length=i % 3)
    flows = make_flows(*[at(i // 2) for i in range(300)])
    drift = entropy.entropy_drift(flows, "1 second")
    plan = drift._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(block" in plan and "SinglePartition" not in plan
    assert drift.count() == 150
