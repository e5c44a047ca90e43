from pyspark.sql import functions as F

from leadpanel.catalog.registry import Tables
from leadpanel.session import spread_rows


def one_row_group(spark, folder, n):
    orders = spark.range(0, n, 1, 1).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 500).alias("o_custkey"), F.lit("P").alias("o_orderstatus"),
        (F.col("id") * 7.5).alias("o_totalprice"), F.lit("1997-03-01").cast("date").alias("o_orderdate"), F.md5(F.col("id").cast("string")).alias("o_orderpriority"))
    orders.write.parquet(f"{folder}/orders.parquet")


def test_rows_of_one_row_group_reach_all_tasks(spark, tmp_path):
    """The file has more splits than there are cores, but all of its rows lie in one."""
    one_row_group(spark, str(tmp_path), 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        permits = Tables(spark, str(tmp_path)).permits
        sizes = [r["count"] for r in permits.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(sizes) == 20_000 and permits.select("permit_key").distinct().count() == 20_000
    assert max(sizes) <= 1.1 * 20_000 / spark.sparkContext.defaultParallelism


def test_tasks_grow_with_the_rows(spark, tmp_path):
    one_row_group(spark, str(tmp_path), 3_000)
    table = spark.read.parquet(f"{tmp_path}/orders.parquet")
    assert spread_rows(table, rows=100).rdd.getNumPartitions() == 30
    assert spread_rows(table.limit(0)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
