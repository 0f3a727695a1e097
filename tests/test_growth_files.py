"""What must not grow faster than the input: part files of a table."""

from datetime import datetime

from pyspark.sql import functions as F

from workload import sources


def test_part_files_grow_with_the_table(spark, tmp_path):
    items = spark.range(60).select(F.col("id").alias("l_orderkey"), F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz").alias("l_shipdate"))
    items.repartition(6).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        found = sources.s2(spark, str(tmp_path))
        assert (len(found.inputFiles()) >= 6, found.count()) == (True, 60)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
