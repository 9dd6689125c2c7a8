"""Where scratch data goes."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from limelight.session import scratch_dir


def session(master: str, setting: str | None = None):
    state = {"dir": None}
    context = SimpleNamespace(
        master=master, applicationId="app-1",
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda d: state.update(dir=f"file:{d}/app"),
    )
    conf = SimpleNamespace(get=lambda key, default: setting or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_cluster_setting_wins():
    spark = session("spark://host:7077", "hdfs://shared/checkpoints/")
    assert scratch_dir(spark, "x").startswith("hdfs://shared/checkpoints/limelight/app-1/x-")


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "x")


def test_a_local_session_gets_one_temporary_base():
    spark = session("local[2]")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
