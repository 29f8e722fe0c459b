"""Tables in the shared folder and sizes for shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewell.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that is no column of ``df`` (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


class Scratch:
    """Stored tables of one operator that go as soon as nothing later reads them.

    A table may only be dropped when all that was made from it is written itself, so that no lost executor asks for it again.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths[purpose] = scratch_dir(self.spark, purpose)
        df.write.parquet(self.paths[purpose])
        return self.spark.read.schema(df.schema).parquet(self.paths[purpose])

    def drop(self, *purposes: str) -> None:
        """Delete tables, if any; a collection on the driver lets Spark's cleaner delete the shuffle files of finished jobs too."""
        for purpose in purposes:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(purpose))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.spark._jvm.System.gc()
