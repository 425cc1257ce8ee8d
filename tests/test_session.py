"""The shared folder comes from the session; a private one only without it."""

import os
from types import SimpleNamespace

from pyspark.sql import functions as F

from bazaarlake.plans.queries import Sample
from bazaarlake.session import SKEW_CONF, scratch_path, shared_dir, tune


def test_tune_sets_run_time_settings(spark):
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in SKEW_CONF.items())


def test_tasks_of_relational_queries_stay_small(spark, settings):
    settings(
        adaptive__advisoryPartitionSizeInBytes="64m",
        adaptive__coalescePartitions__parallelismFirst="false",
        shuffle__partitions="40",
    )
    Sample(spark, "unread")
    # About 80 MB that do not compress.
    rows = spark.range(2_000_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("h"))
    tasks = rows.repartition("h").select(F.spark_partition_id()).distinct().count()
    assert tasks >= 5


def test_named_folder_is_used():
    named = SimpleNamespace(conf={"spark.checkpoint.dir": "s3a://shared/"})
    assert shared_dir(named) == "s3a://shared"
    assert scratch_path(named, "x").startswith("s3a://shared/x-")


def test_session_without_folder_gets_one_private_folder():
    class Context:
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    bare = SimpleNamespace(conf={}, sparkContext=Context())
    assert os.path.isdir(shared_dir(bare)) and shared_dir(bare) == shared_dir(bare)
