import os

import pytest

from conftest import SF_SMALL
from lodestar.operators import graph as G
from lodestar.session import _configured_checkpoint_dir, freed_shuffles, persisted, scratch, shared_dir
from lodestar.sources.tables import part_graph


def test_shared_dir_is_under_the_checkpoint_dir(spark):
    d = shared_dir(spark, "x")
    base = _configured_checkpoint_dir(spark)
    assert base and d.removeprefix("file://").startswith(base.removeprefix("file:")) and os.path.basename(d).startswith("x-")
    assert shared_dir(spark, "x") != d  # a fresh folder every time


def test_shared_dir_needs_the_setting_off_this_machine(spark, monkeypatch):
    from lodestar import session
    monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda s: None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(spark, "x")


def test_shared_dir_keeps_the_scheme(spark, monkeypatch):
    from lodestar import session
    for base, expect in (("file:/a/b", "file:///a/b/x-"), ("hdfs://n/a", "hdfs://n/a/x-"), ("/a", "/a/x-")):
        monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda s, base=base: base)
        assert shared_dir(spark, "x").startswith(expect)


def test_scratch_deletes_what_it_is_not_told_to_keep(spark):
    with scratch(spark) as keep:
        a, b = shared_dir(spark, "a"), shared_dir(spark, "b")
        keep.append(b)
        for p in (a, b):
            spark.range(3).write.parquet(p)
    assert not os.path.exists(a.removeprefix("file://")) and spark.read.parquet(b).count() == 3


def test_a_stored_input_is_used_as_it_is(spark):
    scan = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_partkey")
    assert G._stored(scan, "t", store=False) is scan
    assert G._stored(part_graph(spark, SF_SMALL), "t").count() == 8899


def test_persisted_releases(spark):
    df = spark.range(100)
    with persisted(df) as p:
        assert p.count() == 100 and p.storageLevel.useMemory
    assert not df.storageLevel.useMemory and not df.storageLevel.useDisk


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    seen = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            seen.add(name)
    return seen


def test_shuffles_of_stored_tables_leave_the_disks(spark):
    before, key = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    e = part_graph(spark, SF_SMALL)
    stored = G._stored(e, "t")
    counts = G.triangle_counts(stored, "a", "b", canonical=True, store_input=False)
    assert not shuffle_files(spark) - before and spark.conf.get(key, None) is None
    assert counts.count() == 200 and e.count() == stored.count() == 8899  # what is lazy makes its shuffles as ever
    spark.conf.set(key, "false")
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)
