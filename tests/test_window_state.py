"""Windows that close once, late rows and restarts, against counts of all rows."""

import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

from netvigil.operators.entropy import packet_entropy
from netvigil.session import fresh_path
from netvigil.sources.flows import write_raw_flows
from netvigil.streaming import flows as streams
from netvigil.streaming import windows

REPO = Path(__file__).parents[1]


def land(raw, folder):
    write_raw_flows(raw.coalesce(1), f"{folder}/{random.random()}")


def test_late_rows_and_a_restart(spark, make_raw):
    landing, beats, out, state = (fresh_path(spark, n) for n in ("landing", "beats", "windows", "state"))
    at = lambda time, length: dict(timestamp=f"2024-01-01 {time}", packet_length=str(length))
    spark.createDataFrame([], windows.HEARTBEAT_SCHEMA).write.parquet(beats)

    def run():
        stream = streams.clean_stream(streams.stream_raw_flows(spark, f"{landing}/*", files_per_batch=1))
        windows.run_window_counts(stream, out, state, delay="30 minutes", heartbeats=windows.heartbeat_stream(spark, beats))

    def found():
        rows = spark.read.parquet(out).collect()
        return Counter({(r.kind, str(r.window_start)[11:13], r.packet_length): r.n for r in rows})

    land(make_raw(at("10:05:00", 1), at("10:06:00", 1), at("11:10:00", 5), at("12:40:00", 7)), landing)
    run()
    assert found() == {("final", "10", 1): 2, ("final", "11", 5): 1}  # the watermark stands at 12:10: 12 is open
    land(make_raw(at("10:10:00", 2), at("12:20:00", 7), at("11:59:00", 5)), landing)  # two come late, in a new run
    run()
    assert found() == {("final", "10", 1): 2, ("final", "11", 5): 1, ("late", "10", 2): 1, ("late", "11", 5): 1}
    windows.send_heartbeat(spark, beats, "2024-01-02 00:00:00")
    run()
    assert found()[("final", "12", 7)] == 2
    run()  # nothing new
    amended = {str(r.window_start)[11:13]: tuple(r[1:]) for r in windows.read_window_entropy(spark, out).collect()}
    assert amended == {"10": (3, 2, 0.9183, 2, 0.0), "11": (2, 1, 0.0, 1, 0.0), "12": (2, 1, 0.0, 2, 0.0)}


def test_shuffled_arrivals_add_up_to_all_rows(spark, make_raw):
    rng = random.Random(6)
    landing, beats, out, state = (fresh_path(spark, n) for n in ("landing", "beats", "windows", "state"))
    rows = [dict(timestamp=f"2024-01-0{1 + i % 2} {rng.randrange(24):02}:{i % 60:02}:00", packet_length=str(rng.randrange(4)),
                 flow_duration=str(i)) for i in range(200)]
    spark.createDataFrame([], windows.HEARTBEAT_SCHEMA).write.parquet(beats)
    for part in range(4):
        land(make_raw(*rows[part::4]), landing)
    windows.send_heartbeat(spark, beats, "2025-01-01 00:00:00")
    stream = streams.clean_stream(streams.stream_raw_flows(spark, f"{landing}/*", files_per_batch=1))
    windows.run_window_counts(stream, out, state, heartbeats=windows.heartbeat_stream(spark, beats))
    want = packet_entropy(streams.clean_stream(make_raw(*rows)))
    columns = ["window_start", "flows", "distinct_lengths", "entropy"]
    got = windows.read_window_entropy(spark, out).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*columns).collect()))


PLAIN = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver alone finds the package
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2])
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
rows = contract.queries()["stream_windows"](spark, contract.SMOKE_DIR).collect()
print(sum(r.flows for r in rows), spark.conf.get("spark.sql.streaming.stateStore.providerClass").rsplit(".", 1)[1])
"""


def test_windows_in_a_session_without_settings_and_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PLAIN, str(REPO), str(tmp_path / "work")], cwd=tmp_path, env=env,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    flows, store = done.stdout.split()[-2:]
    assert int(flows) > 900 and store == "HDFSBackedStateStoreProvider"
