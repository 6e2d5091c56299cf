"""Executors that cannot import the package still run its functions."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa

from courtside.llm.sending import BATCH, gathered, small_batches

CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from courtside.session import build
spark = build("elsewhere", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false", spark__checkpoint__dir={shared!r})
names = ["op2_hidden_markov", "op3_quality", "op4_languages"]
print("ROWS", [entry.queries()[n](spark, "/root/testdata/sf0.001").count() for n in names])
"""


def test_queries_run_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(root=root, shared=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS [200, 200, 200]" in done.stdout, done.stderr[-2000:]


def test_batches_are_bounded_and_never_widened(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        small_batches(spark)
        assert spark.conf.get(name) == str(BATCH)
        spark.conf.set(name, "1m")
        small_batches(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)


def test_small_batches_are_gathered_up_to_a_size():
    def batch(*texts):
        return pa.record_batch([pa.array(texts, pa.string())], ["text"])

    one = batch("x" * 100)
    found = list(gathered([batch("a" * 30), batch(None, ""), batch("b" * 30), one, batch("c")], one.nbytes))
    assert [x for b in found for x in b.column(0).to_pylist()] == ["a" * 30, None, "", "b" * 30, "x" * 100, "c"]
    assert len(found) == 3 and max(b.nbytes for b in found) <= one.nbytes + 64
    assert list(gathered([], 10)) == []
    assert next(gathered([one], 10)).equals(one)
