"""A written slice leaves no shuffle files."""

import glob

from pyspark.sql import functions as F

from chargewise.operators.working_set import SHUFFLE_CLEANUP, materialize


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*")}


def test_a_written_slice_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert materialize(df).count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    numbers = {f.rsplit("shuffle_")[-1].split("_")[0] for f in shuffle_files(spark) - before}
    assert len(numbers) <= 1            # the count's own shuffle
