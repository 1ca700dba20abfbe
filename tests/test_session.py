"""The checkpoint folder of sessions whose executors are other processes."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

import surfrank as sr
from surfrank import session


def test_shared_file_folder_is_used_on_a_cluster(spark, edges_of, monkeypatch):
    monkeypatch.setattr(session, "is_local", lambda _: False)
    folder = session.checkpoint_dir(spark)
    assert folder.startswith("file:")
    rows = sr.vertex_index(edges_of("b>a c>a")).orderBy("idx").collect()
    assert [(r.id, r.idx) for r in rows] == [("a", 0), ("b", 1), ("c", 2)]


def test_folder_that_loses_files_is_refused_on_a_cluster(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(session, "is_local", lambda _: False)
    with pytest.raises(RuntimeError, match="on one machine"):
        session._shared(spark, "file:/proc/surfrank-none")
    assert session._shared(spark, f"file:{tmp_dir}") == f"file:{tmp_dir}"


@pytest.mark.parametrize("configured", [None, "file:/mnt/shared"])
def test_cluster_session_without_a_folder_takes_one_in_the_warehouse(monkeypatch, configured):
    monkeypatch.setattr(session, "_seen_by_all", lambda *_: True)
    taken: list[str] = []
    context = SimpleNamespace(
        master="spark://host:7077", applicationId="app", getConf=lambda: {"spark.checkpoint.dir": configured},
        getCheckpointDir=lambda: taken[-1] if taken else None, setCheckpointDir=taken.append,
    )
    conf = {"spark.sql.warehouse.dir": "file:/mnt/warehouse"}
    fake = SimpleNamespace(sparkContext=context, conf=conf)
    expected = configured or "file:/mnt/warehouse/_surfrank_checkpoints"
    assert session.checkpoint_dir(fake) == expected


def test_only_tasks_inside_the_driver_are_local():
    masters = {"local": True, "local[4]": True, "local[*,2]": True, "local-cluster[3,4,1024]": False, "spark://h:1": False, "yarn": False}
    for master, told in masters.items():
        assert session.is_local(SimpleNamespace(sparkContext=SimpleNamespace(master=master))) is told
