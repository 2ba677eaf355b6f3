"""Folders of parts: few tasks list them, settings are as before."""

from pyspark.sql import functions as F

import docketflow as d
from docketflow.sources import tables


def test_folders_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "LISTING_TASKS", 1)
    path, n = str(tmp_path / "parts"), 50 + spark.sparkContext.defaultParallelism
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"]
    before = [spark.conf.get(name) for name in names]
    d.write_parts(spark.range(2 * n).withColumn("part", F.expr("id div 2")), path, folders=True)
    spark.sparkContext.setJobGroup("listing", "listing")
    parts = d.scan_parts(spark, path, "id long")
    spark.sparkContext.setJobGroup("reading", "reading")
    status = spark.sparkContext.statusTracker()
    stages = [s for job in status.getJobIdsForGroup("listing") for s in status.getJobInfo(job).stageIds]
    tasks = [status.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= spark.sparkContext.defaultParallelism
    assert sorted((r.id, r.part) for r in parts.collect()) == [(i, f"{i // 2:06d}") for i in range(2 * n)]
    assert [spark.conf.get(name) for name in names] == before
