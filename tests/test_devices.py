"""Scoring tasks with a device each, on a cluster of two executors whose devices a script makes up."""

import json
import os
import stat
import subprocess
import sys

import pytest

PROGRAM = """
import json, sys, time
from pyspark.sql import SparkSession, functions as F
from corpusflow.operators.scorers import FunctionScorer, device, one_device, scored

script = sys.argv[1]
conf = {
    "spark.master": "local-cluster[2,2,900]", "spark.executor.memory": "700m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "4", "spark.sql.adaptive.enabled": "false",
    "spark.worker.resource.gpu.amount": "1", "spark.worker.resource.gpu.discoveryScript": script, "spark.executor.resource.gpu.amount": "1",
}
spark = SparkSession.builder.config(map=conf).getOrCreate()

def make():
    return device()

def call(model, items):
    began = time.time()
    time.sleep(0.3)
    ended = time.time()
    return [(str(model), began, ended) for _ in items]

df = spark.range(8).select(F.col("id"), F.col("id").alias("item")).repartition(8, "id")
rows = scored(df, FunctionScorer("device string, began double, ended double", make, call), "id", "item", profile=one_device()).collect()
print("ROWS", json.dumps([[r.id, r.error, r.device, r.began, r.ended] for r in rows]))
spark.stop()
"""


@pytest.mark.skipif(os.name != "posix", reason="the discovery script is a shell script")
def test_a_device_a_task(tmp_path):
    script = tmp_path / "devices.sh"
    script.write_text('#!/bin/sh\necho \'{"name": "gpu", "addresses": ["7"]}\'\n')
    script.chmod(script.stat().st_mode | stat.S_IXUSR)
    program = tmp_path / "program.py"
    program.write_text(PROGRAM)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"PYTHONPATH": repo}
    done = subprocess.run([sys.executable, str(program), str(script)], capture_output=True, text=True, timeout=150, env=env, cwd=tmp_path)
    line = next((x for x in done.stdout.splitlines() if x.startswith("ROWS ")), None)
    assert line, done.stderr[-3000:]
    rows = json.loads(line[5:])
    assert sorted(r[0] for r in rows) == list(range(8))
    assert all(r[1] is None and r[2] == "7" for r in rows)
    # two devices: never more than two tasks at a time, though there are four cores
    calls = {(a, b) for *_, a, b in rows}  # a task's rows are scored in one call
    assert len(calls) > 2 and max(sum(a <= t < b for a, b in calls) for t, _ in calls) <= 2


def test_no_device_outside_a_task():
    from corpusflow.operators.scorers import device

    assert device() is None
