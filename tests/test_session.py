import time

from pyspark.sql import functions as F

from terrane.session import FREED, freed_shuffles


def _files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(found.apply(i).getName()) for i in range(found.size()) if str(found.apply(i).getName()).endswith(".data")}


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    own, before = spark.conf.get(FREED, None), _files(spark)
    rows = spark.range(10_000).repartition(3, F.col("id") % 7)
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            rows.write.parquet(str(tmp_path / "a"))
        assert spark.conf.get(FREED) == "true"
    for _ in range(50):
        if not _files(spark) - before:
            break
        time.sleep(0.2)
    assert not _files(spark) - before
    assert spark.conf.get(FREED, None) == own
    assert spark.read.parquet(str(tmp_path / "a")).count() == 10_000
