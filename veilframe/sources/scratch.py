"""The folder that driver and executors share, and tables that cut lineage there."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on one machine, as in tests, a local folder is made where none is named.

    A cluster without one is an error: each executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="veilframe-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_OWNER: ContextVar[list | None] = ContextVar("owner", default=None)


@contextlib.contextmanager
def scope() -> Iterator[None]:
    """Drops, at its end, all scratch tables made inside: for a result that is written down before."""
    mine: list[Scratch] = []
    before = _OWNER.set(mine)
    try:
        yield
    finally:
        _OWNER.reset(before)
        for scratch in mine:
            scratch.drop()


class Scratch:
    """Tables written to the shared folder to cut lineage.

    A written table survives the loss of any executor, unlike cached blocks. What a lazy
    result still reads belongs to the enclosing `scope`, which drops it at its end;
    without one it stays until the driver's session ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/veilframe-{uuid.uuid4().hex}"
        owner = _OWNER.get()
        if owner is not None:
            owner.append(self)
        else:
            atexit.register(self._end)

    def _end(self) -> None:
        if self.spark.sparkContext._jsc is not None:  # a stopped session cannot reach the folder any more
            self.drop()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_mapped(self, df: DataFrame, kernel: Callable[[Iterator], Iterator], schema: str, name: str) -> DataFrame:
        """The table of df.mapInArrow(kernel, schema)."""
        return self.write(df.mapInArrow(kernel, schema), name)

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where its input is one or a few files: one round-robin shuffle of little data.

    An input of many splits, as any large one is, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
