"""File sources and sinks: discovery, manifests, archives, reports."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def discover(spark: SparkSession, root: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """All files below a folder. The listing is sorted by path; contents, read only when asked for, stay where they are, unsorted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    listed = files.select("path", "modificationTime", "length", *(["content"] if content else []))
    return listed if content else listed.orderBy("path")


def sample_files(files: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n files at random, sorted; n of 0 or less means all."""
    return files if n <= 0 else files.orderBy(F.rand(seed)).limit(n).orderBy("path")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_manifest(files: DataFrame, path: str, root: str, subsample: int = 0) -> None:
    """The list of files with what it was made from; the description is written last, so a torn write is no manifest."""
    files.select("path").write.mode("overwrite").option("sep", "\t").csv(f"{path}/files")
    spark = files.sparkSession
    meta = {"root": root, "subsample": max(0, subsample), "count": spark.read.schema("path string").option("sep", "\t").csv(f"{path}/files").count()}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_manifest(spark: SparkSession, path: str, root: str, subsample: int = 0) -> DataFrame | None:
    """The saved list, if it is whole and was made from the same root and subsample."""
    p, fs = _file_system(spark, f"{path}/meta/_SUCCESS")
    if not fs.exists(p):
        return None
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    files = spark.read.schema("path string").option("sep", "\t").csv(f"{path}/files")
    same = meta["root"] == root and meta["subsample"] == max(0, subsample) and meta["count"] == files.count()
    return files if same else None


def done_paths(spark: SparkSession, log_glob: str) -> DataFrame:
    """Distinct logged paths; rows that cannot be read are left out."""
    return spark.read.option("header", True).option("mode", "DROPMALFORMED").csv(log_glob).select("src_path").where("src_path is not null").distinct()


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def flagged_report(found: DataFrame, path: str) -> None:
    """One line for each file and finding: file, CLEAN or FLAGGED, group, reason."""
    lines = found.select("src_path", F.explode_outer("findings").alias("f"))
    verdict = F.when(F.col("f").isNull(), "CLEAN").otherwise("FLAGGED")
    lines.select("src_path", verdict.alias("verdict"), F.col("f.grp").alias("grp"), F.col("f.reason").alias("reason")).write.mode("overwrite").option("sep", "\t").csv(path)


class ZipPart(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]

    def partitions(self) -> list[InputPartition]:
        return [ZipPart(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with zipfile.ZipFile(partition.value) as z:
            for name in z.namelist():
                if not name.endswith("/"):
                    yield partition.value, name, z.read(name)
                    return  # only the first regular file of an archive is used


class ZipSource(DataSource):
    """spark.read.format("zip_first"): the first regular file of each archive; empty archives give nothing."""

    @classmethod
    def name(cls) -> str:
        return "zip_first"

    def schema(self) -> str:
        return "path string, member string, content binary"

    def reader(self, schema) -> DataSourceReader:
        return ZipReader(dict(self.options))
