"""Tables derived from the test tables, written once per session and read by the queries.

They go to the shared checkpoint folder of the cluster as Parquet, so they outlive executors and are
read with column pruning and in parallel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspan.operators.storage import shared_folder, shuffles_freed

_WRITTEN: set[str] = set()


def state_of(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of what lies in a folder, so that changed data isn't taken for the old."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return folder + "".join(sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in files))


def base_path(spark: SparkSession, sf_dir: str) -> str:
    folder = hashlib.md5(state_of(spark, sf_dir).encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/batch-{folder}"


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of what `write` puts there the first time that it is asked for."""
    path = f"{base_path(spark, sf_dir)}/{name}"
    if path not in _WRITTEN:
        with shuffles_freed(spark):
            write(path)
        _WRITTEN.add(path)
    return path


def is_stored(spark: SparkSession, sf_dir: str, name: str) -> bool:
    return f"{base_path(spark, sf_dir)}/{name}" in _WRITTEN


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    # File sizes are the writer's affair; bench.py sets this option of Spark for its small tables.
    return spark.read.parquet(once(spark, sf_dir, name, lambda path: build().write.mode("overwrite").parquet(path)))
