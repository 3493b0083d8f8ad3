"""Scratch tables in the cluster's shared folder, and table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import scratch, shared_dir

__all__ = ["Staged", "delete", "filesystem", "read", "scratch", "shared_dir"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Staged:
    """Tables written to the shared folder to cut lineage; `drop` removes those that no later plan reads."""

    def __init__(self, spark: SparkSession, owner: str):
        self.spark, self.owner, self.paths = spark, owner, {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch(self.spark, f"{self.owner}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, []):
                delete(self.spark, path)


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path as its object."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)
