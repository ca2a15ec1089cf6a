"""Tables kept between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is named, a plain local session gets a temporary one
    and a cluster an error: its machines would not see each other's folders."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            named = tempfile.mkdtemp(prefix="ledgerspan-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here are deleted when it is written, not whenever the driver next collects
    garbage, so the disk holds those of one step at a time. Only for frames that nobody runs again."""
    before = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: it is computed once, survives lost executors, is
    read by columns, and has a size that the planner knows."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def forget(*tables: DataFrame) -> None:
    """Delete tables that `keep` returned. Only for steps whose readers have all been stored themselves."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.kept_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
