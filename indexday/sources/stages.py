"""Persisted stages between the steps of a study."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def save_stage(
    df: DataFrame, target: str, mode: str = "errorifexists", bucket: tuple[int, str] | None = None
) -> DataFrame:
    """Write a stage and return it read back.

    ``target`` is a path if it holds a slash, else a catalog table name. An existing stage is
    an error unless ``mode`` says otherwise. A table may be bucketed as (number, column): event
    tables bucketed by person spare every later step its exchange by person.
    """
    if bucket is not None:
        df = df.repartition(*bucket)  # else every task writes a file for every bucket
    writer = df.write.mode(mode).format("parquet")
    if bucket is not None:
        writer = writer.bucketBy(*bucket).sortBy(bucket[1])
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)
    return read_stage(df.sparkSession, target)


def read_stage(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session on one machine that names none gets a new temporary folder; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    named = tempfile.mkdtemp(prefix="indexday-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


class StageStore:
    """Stages of one run, below the shared folder or as tables of a schema.

    A written stage ends the lineage, so a lost executor costs at most the stage at work, and
    its size is known to the planner, which then decides on broadcasts from facts. ``names``
    gives stages other names than the study's. ``counts`` holds the rows of stages put as counted.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        schema: str | None = None,
        names: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.schema = schema
        self.names = dict(names or {})
        self.counts: dict[str, int] = {}
        self.root = root
        if root is None and schema is None:
            self.root = os.path.join(shared_folder(spark), f"stages-{uuid.uuid4().hex}")

    def target(self, name: str) -> str:
        name = self.names.get(name, name)
        return f"{self.schema}.{name}" if self.schema else os.path.join(self.root, name)

    def put(self, name: str, df: DataFrame, counted: bool = False) -> DataFrame:
        """Write a stage; ``counted`` takes its number of rows from the write itself, without a further job."""
        if not counted:
            return save_stage(df, self.target(name))
        seen = Observation()
        out = save_stage(df.observe(seen, F.count(F.lit(1)).alias("n")), self.target(name))
        self.counts[name] = seen.get["n"]
        return out

    def get(self, name: str) -> DataFrame:
        return read_stage(self.spark, self.target(name))

    def drop(self, *names: str) -> None:
        """Delete stages that no plan reads any more."""
        for name in names:
            target = self.target(name)
            if "/" in target:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(target)
                files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
                files.delete(path, True)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {target}")
