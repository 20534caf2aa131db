import time

import pytest
from pyspark.sql import functions as F

from kerbside.sources import workspace


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(workspace.NoSharedFolder):
            workspace.shared_folder(_Session(spark_master=master))


def test_the_named_folder_is_used_and_a_local_session_gets_its_own():
    named = _Session(spark_master="yarn")
    named.conf.set("spark.checkpoint.dir", "hdfs://x/y/")
    assert workspace.shared_folder(named) == "hdfs://x/y"
    alone = _Session(spark_master="local[4]")
    assert workspace.shared_folder(alone) == workspace.shared_folder(alone) == alone.conf["spark.checkpoint.dir"]


def _exchanged(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_a_stored_table_leaves_no_exchanged_files(spark):
    before, setting = _exchanged(spark), spark.conf.get(workspace._DROP_SHUFFLES, None)
    df = spark.range(1000).repartition(5, "id").groupBy(F.expr("id % 7").alias("k")).count()
    table = workspace.stored(df, "counted")
    end = time.monotonic() + 20
    while (left := _exchanged(spark) - before) and time.monotonic() < end:
        time.sleep(0.1)
    assert not left and spark.conf.get(workspace._DROP_SHUFFLES, None) == setting
    assert table.count() == 7 == df.count()
