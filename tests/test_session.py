"""Session settings and the scratch folder rule."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from tallyloom.session import shuffle_partitions, sized_for
from tallyloom.sources import scratch


def pretend(master: str, checkpoint_conf: str | None = None, checkpoint_dir: str | None = None):
    conf = {"spark.master": master, "spark.checkpoint.dir": checkpoint_conf}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key) or default),
        sparkContext=SimpleNamespace(
            getCheckpointDir=lambda: checkpoint_dir, applicationId="app-1"
        ),
    )


def test_local_settings_are_left_alone(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shuffle_partitions():
    assert shuffle_partitions(8) == 2_000
    assert shuffle_partitions(8_000) == 32_000
    assert shuffle_partitions(8_000, 100 << 40) == 3 * (100 << 40) >> 27


def test_larger_inputs_get_more_partitions(monkeypatch):
    def partitions(size, now="200"):
        conf = {"spark.sql.shuffle.partitions": now}
        path = SimpleNamespace(
            getFileSystem=lambda _: SimpleNamespace(
                getContentSummary=lambda _: SimpleNamespace(getLength=lambda: size)
            )
        )
        hadoop = SimpleNamespace(apache=SimpleNamespace(hadoop=SimpleNamespace(fs=SimpleNamespace(Path=lambda _: path))))
        context = SimpleNamespace(
            master="yarn", defaultParallelism=100, _jvm=SimpleNamespace(org=hadoop),
            _jsc=SimpleNamespace(hadoopConfiguration=lambda: None),
        )
        sized_for(SimpleNamespace(
            conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__),
            sparkContext=context,
        ), "hdfs:///in")
        return int(conf["spark.sql.shuffle.partitions"])

    assert partitions(1 << 30) == 2_000 < partitions(1 << 40) < partitions(100 << 40)
    assert partitions(100 << 40, now="77") == 77


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(pretend("spark://somewhere:7077"))


def test_the_configured_folder_is_used():
    for session in (
        pretend("yarn", checkpoint_conf="hdfs:///shared"),
        pretend("yarn", checkpoint_dir="hdfs:///shared"),
    ):
        assert scratch.scratch_root(session) == "hdfs:///shared"
        path = scratch.scratch_path(session, "x")
        assert path.startswith("hdfs:///shared/tallyloom/app-1/x-")
        assert path != scratch.scratch_path(session, "x")


def test_local_mode_falls_back_to_the_warehouse():
    first = scratch.scratch_root(pretend("local[2]"))
    assert first.endswith("/_scratch") and first == scratch.scratch_root(pretend("local[2]"))


def test_scratch_is_dropped(spark):
    path = scratch.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    other = scratch.scratch_path(spark, "y")
    spark.range(2).write.parquet(other)
    scratch.drop_path(spark, path)
    assert not os.path.exists(path) and spark.read.parquet(other).count() == 2
