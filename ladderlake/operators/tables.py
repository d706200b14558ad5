"""Tables in the shared folder that cut lineage: they survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, *key: str) -> DataFrame:
    """df dealt over tasks by key. A small file of short rows is read by few tasks; where a row becomes much work or many lines, that would stay with them."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *key)


def stored(df: DataFrame, path: str) -> DataFrame:
    """df, written as Parquet and reread."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
