"""The spark-submit job module end to end (in-process, shared session)."""

from __future__ import annotations

import os

import pytest

from surfrank import job


def test_job_writes_ranks(spark, tmp_dir, monkeypatch):
    src = os.path.join(tmp_dir, "g.tsv")
    with open(src, "w") as f:
        f.write("# graph\na\tb\na\tc\nb\tc\n")
    out = os.path.join(tmp_dir, "out")
    # keep the shared test session alive: the job stops "its" session at the end
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert job.main(["--input", src, "--output", out, "--ordered"]) == 0
    lines = []
    for name in sorted(os.listdir(out)):
        if name.startswith("part-"):
            lines += open(os.path.join(out, name)).read().splitlines()
    got = {k: float(v) for k, v in (ln.split("\t") for ln in lines)}
    assert got == pytest.approx({"a": 0.20324996, "b": 0.284548695, "c": 0.512201345}, abs=2e-9)


def test_job_missing_input_fails(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    assert job.main(["--input", os.path.join(tmp_dir, "nope"), "--output", os.path.join(tmp_dir, "o")]) == 1


def test_job_parquet_and_history(spark, tmp_dir, monkeypatch):
    src = os.path.join(tmp_dir, "g.tsv")
    with open(src, "w") as f:
        f.write("1\t2\n1\t3\n2\t3\n")
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    out, hist = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "hist")
    args = ["--input", src, "--output", out, "--format", "parquet", "--id-type", "long", "--history", hist]
    assert job.main(args) == 0
    ranks = {r["id"]: r["rank"] for r in spark.read.parquet(out).collect()}
    assert ranks[1] == pytest.approx(0.20324996, abs=2e-9)
    assert spark.read.parquet(hist).count() == 9


def test_submitted_job_exit_codes(spark, tmp_dir):
    """The start script under ``spark-submit``: converged, missing input, cap reached."""
    import subprocess
    import sys

    import pyspark

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    edges = os.path.join(tmp_dir, "edges")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("concat(l_partkey, '\t', l_suppkey) as value")
    lines.write.text(edges)
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")

    def run(*args):
        command = [submit, "--master", "local[2]", "--conf", "spark.ui.enabled=false", os.path.join(root, "rank_job.py"), "--checkpoint-dir", f"file://{tmp_dir}/ckpt", *args]
        return subprocess.run(command, env={**os.environ, "PYSPARK_PYTHON": sys.executable}, capture_output=True, timeout=240).returncode

    out = os.path.join(tmp_dir, "ranks")
    assert run("--input", edges, "--output", out, "--max-iter", "none", "--format", "parquet") == 0
    assert sum(r["rank"] for r in spark.read.parquet(out).collect()) == pytest.approx(1.0)
    assert run("--input", os.path.join(tmp_dir, "nope"), "--output", out) == 1
    assert run("--input", edges, "--output", os.path.join(tmp_dir, "more"), "--max-iter", "2", "--initial", out, "-e", "0") == 3
