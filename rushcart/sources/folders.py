"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

#: Rows of a join that one task builds and adds up, about; its hash table takes some 100 bytes for each.
TASK_ROWS = 2_000_000

#: Paths given out, until they are removed.
_given: list[str] = []


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a session in one process without that setting gets a temporary folder of the machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="rushcart-")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the intermediate tables that were written inside it.

    Write results before that: frames read these tables until they have been computed.
    """
    before = len(_given)
    try:
        yield
    finally:
        for path in _given[before:]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _given[before:]


def tasks_for(rows: int | None) -> int:
    """Tasks for a join that gives so many rows."""
    return -(-int(rows or 0) // TASK_ROWS)


@contextmanager
def _shuffled_into(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Shuffles that run inside get so many partitions, and small ones are not put together."""
    tasks = max(tasks, spark.sparkContext.defaultParallelism)
    own = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stored(df: DataFrame, name: str, *, tasks: int = 1) -> DataFrame:
    """Write ``df`` once and go on from the files.

    For results that are read several times: they are not computed again, a lost
    executor costs nothing, and Spark plans later joins by the size of the files,
    so it broadcasts what turned out small and shuffles what did not.

    Spark sizes tasks by the bytes they read. Where a join gives many more rows than it reads,
    ``tasks`` (from :func:`tasks_for`) says into how many its shuffles deal them.
    """
    path = work_folder(df.sparkSession, name)
    with _shuffled_into(df.sparkSession, tasks) if tasks > 1 else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
