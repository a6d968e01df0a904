"""Reading, scratch tables and small column helpers shared by the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import Scratch, scope, shared_dir, spread

__all__ = ["LOWER", "Scratch", "WORD_SEPARATORS", "WorkerScratch", "copies", "fold", "free_name", "lower_words_of", "scope", "shared_dir", "slices", "spread", "table", "words_of"]

#: Separators of words in every contract: space and the ASCII controls 9 to 13.
WORD_SEPARATORS = b" \t\n\x0b\x0c\r"

#: A-Z to a-z, and nothing else.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in parts of few rows, so that a kernel turns no more than these into Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _stored(folder: str, batches: Iterator[pa.RecordBatch], group_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Writes the rows of one task to a hidden file of its own; yields its name, or nothing without rows."""
    name, writer, held, size = f"_{uuid.uuid4().hex}.parquet", None, [], 0

    def flush() -> None:
        nonlocal writer, held, size
        if held:
            writer = writer or pq.ParquetWriter(f"{folder}/{name}", held[0].schema)
            writer.write_table(pa.Table.from_batches(held))
            held, size = [], 0

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
            if size >= group_bytes:
                flush()
    flush()
    if writer is not None:
        writer.close()
        pa.default_memory_pool().release_unused()  # the worker waits for its next task without it
        yield pa.RecordBatch.from_pydict({"name": [name]})


class WorkerScratch(Scratch):
    """Scratch whose tables in a folder of the local file system are written by the tasks' Python workers, elsewhere by Spark.

    For each file that it creates, and again for its checksums, Hadoop's local file system
    starts a process (`chmod`) from the executor's JVM, some hundreds for many small tables.
    Until such a child is replaced it shows the whole memory of the JVM as its own, so that an
    executor that is measured at that moment seems to hold twice what it holds. Workers create
    files without a process. Only the files of tasks that succeeded get their visible names.
    For operators that run Python anyway; `op1` keeps to DataFrame operations.

    A Python step whose rows are written at once goes by `write_mapped`: its kernel and the
    writing share one worker, where a step before `write` holds two for each task, and all
    workers of an executor keep their memory.
    """

    def write(self, df: DataFrame, name: str) -> DataFrame:
        folder = self._folder(name)
        if folder is None:
            return super().write(df, name)
        return self._saved(df, lambda batches: _stored(folder, batches), df.schema, name, folder)

    def write_mapped(self, df: DataFrame, kernel: Callable[[Iterator], Iterator], schema: str, name: str) -> DataFrame:
        folder = self._folder(name)
        if folder is None:
            return super().write_mapped(df, kernel, schema, name)
        return self._saved(df, lambda batches: _stored(folder, kernel(batches)), StructType.fromDDL(schema), name, folder)

    def _folder(self, name: str) -> str | None:
        """The path of a table in the local file system, else None."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        uri = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toUri()
        return uri.getPath() if uri.getScheme() == "file" else None

    def _saved(self, df: DataFrame, store: Callable[[Iterator], Iterator], schema: StructType, name: str, folder: str) -> DataFrame:
        os.makedirs(folder)
        for row in df.mapInArrow(store, "name string").collect():
            os.rename(f"{folder}/{row['name']}", f"{folder}/{row['name'][1:]}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, over all cores."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def copies(rows: DataFrame, most: int, into: str = "copies", part: str = "copy_part") -> DataFrame:
    """Equal rows as one row with their number, in parts of at most `most`, so that no task meets all of them."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias(into))
    starts = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col(into) - 1, F.lit(most).cast("long"))).alias(part, "__from")
    return counted.select("*", starts).withColumn(into, F.least(F.col(into) - F.col("__from"), F.lit(most).cast("long"))).drop("__from")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have yet (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def fold(column: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; null ids count as the empty text."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % F.lit(modulus)


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8; bytes.split() separates at exactly these six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The words with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
