"""Atomic publication: a failed write leaves the old table, readers keep one version, old versions go."""

import pytest
from pyspark.sql import functions as F

from trendspark import publish


def table(spark, n, mark):
    return spark.range(n).select("id", F.lit(mark).alias("mark"), (F.col("id") % 3).alias("day"))


def rows(df):
    return sorted((r.id, r.mark) for r in df.collect())


def test_a_job_that_fails_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "gold")
    publish.publish(table(spark, 50, "old"), root, ("day",))
    before = publish.current_version(spark, root)
    # some partitions are written before the last task fails
    broken = table(spark, 5000, "new").repartitionByRange(8, "id").withColumn("mark", F.expr("IF(id = 4999, raise_error('lost'), mark)"))
    with pytest.raises(Exception, match="lost"):
        publish.publish(broken, root, ("day",))
    assert publish.current_version(spark, root) == before
    assert rows(publish.read_table(spark, root)) == [(i, "old") for i in range(50)]
    publish.publish(table(spark, 7, "new"), root, ("day",))
    assert rows(publish.read_table(spark, root)) == [(i, "new") for i in range(7)]
    # the unfinished folder of the failed run is gone; the version before is kept
    assert len(publish.Store(spark, root).folders(publish.VERSIONS)) == 2


def test_a_reader_sees_one_version(spark, tmp_path):
    root = str(tmp_path / "gold")
    publish.publish(table(spark, 20, "one"), root)
    reader = publish.read_table(spark, root)
    publish.publish(table(spark, 30, "two"), root)
    assert rows(reader) == [(i, "one") for i in range(20)]
    assert rows(publish.read_table(spark, root)) == [(i, "two") for i in range(30)]


def test_a_killed_job_is_not_seen(spark, tmp_path):
    """Killed after the files were written, before the pointer was swapped."""
    root = str(tmp_path / "gold")
    publish.publish(table(spark, 5, "one"), root)
    publish.write_table(table(spark, 9, "lost"), f"{root}/{publish.VERSIONS}/99990101T000000-lost", ("day",), whole=True)
    assert rows(publish.read_table(spark, root)) == [(i, "one") for i in range(5)]
    publish.publish(table(spark, 6, "two"), root)
    assert rows(publish.read_table(spark, root)) == [(i, "two") for i in range(6)]
    assert "99990101T000000-lost" not in publish.Store(spark, root).folders(publish.VERSIONS)


def test_partitions_prune_and_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "gold")
    versions = [publish.publish(table(spark, 9, str(i)), root, ("day",), kept=2) for i in range(5)]
    assert publish.Store(spark, root).folders(publish.VERSIONS) == versions[-3:]
    assert rows(publish.read_table(spark, root, versions[-2])) == [(i, "3") for i in range(9)]
    plan = publish.read_table(spark, root).where("day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    root = str(tmp_path / "plain")
    table(spark, 4, "x").write.parquet(root)
    assert publish.current_version(spark, root) is None and publish.read_table(spark, root).count() == 4
