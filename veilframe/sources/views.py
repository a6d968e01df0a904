"""Derived record views: one imaging-instance-like record for each lineitem, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, spread

#: Fields of a record in wide form, in tag order: keyword, tag, VR, human name.
FIELDS = (
    ("SOPClassUID", "00080016", "UI", "SOP Class UID"),
    ("SOPInstanceUID", "00080018", "UI", "SOP Instance UID"),
    ("StudyDate", "00080020", "DA", "Study Date"),
    ("Modality", "00080060", "CS", "Modality"),
    ("Manufacturer", "00080070", "LO", "Manufacturer"),
    ("StudyDescription", "00081030", "LO", "Study Description"),
    ("SeriesDescription", "0008103E", "LO", "Series Description"),
    ("OperatorsName", "00081070", "PN", "Operators' Name"),
    ("ManufacturerModelName", "00081090", "LO", "Manufacturer's Model Name"),
    ("PatientName", "00100010", "PN", "Patient's Name"),
    ("PatientID", "00100020", "LO", "Patient ID"),
    ("PatientBirthDate", "00100030", "DA", "Patient's Birth Date"),
    ("StudyInstanceUID", "0020000D", "UI", "Study Instance UID"),
    ("SeriesInstanceUID", "0020000E", "UI", "Series Instance UID"),
    ("SeriesNumber", "00200011", "IS", "Series Number"),
    ("InstanceNumber", "00200013", "IS", "Instance Number"),
)
NAMES = tuple(f[0] for f in FIELDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_INST_COLUMNS = """
  concat('/in/', o_custkey, '/', l_orderkey, '/', l_linenumber, '-', l_partkey, '-', l_suppkey, '.dcm') AS src_path,
  l_orderkey AS k1, l_linenumber AS k2,
  CAST(o_custkey AS {string}) AS PatientID, c_name AS PatientName,
  {birth} AS PatientBirthDate,
  {study} AS StudyDate,
  concat('1.2.840.', l_orderkey) AS StudyInstanceUID,
  concat('1.2.840.', l_orderkey, '.', l_suppkey) AS SeriesInstanceUID,
  concat('1.2.840.', l_orderkey, '.', l_suppkey, '.', l_linenumber) AS SOPInstanceUID,
  CASE l_partkey % 5 WHEN 0 THEN '1.2.840.10008.5.1.4.1.1.2' WHEN 1 THEN '1.2.840.10008.5.1.4.1.1.6.1' ELSE '1.2.840.10008.5.1.4.1.1.3.1' END AS SOPClassUID,
  CASE WHEN l_partkey % 5 = 0 THEN 'CT' ELSE 'US' END AS Modality,
  CASE l_suppkey % 4 WHEN 0 THEN 'GE Vingmed Ultrasound' WHEN 1 THEN 'ACUSON' WHEN 2 THEN 'Philips' END AS Manufacturer,
  CASE l_suppkey % 4 WHEN 0 THEN 'Vivid E9' WHEN 1 THEN 'Sequoia' WHEN 2 THEN 'iE33' ELSE '' END AS ManufacturerModelName,
  CAST(CASE l_partkey % 3 WHEN 0 THEN 480 WHEN 1 THEN 600 ELSE 768 END AS INT) AS n_rows,
  CAST(CASE l_partkey % 3 WHEN 0 THEN 640 WHEN 1 THEN 800 ELSE 1024 END AS INT) AS n_cols,
  CAST(l_suppkey % 7 AS {string}) AS SeriesNumber, CAST(l_linenumber AS {string}) AS InstanceNumber,
  s_name AS OperatorsName, o_orderpriority AS SeriesDescription, p_type AS StudyDescription,
  CAST(l_partkey % 6 AS INT) AS rsf, CAST(l_suppkey % 50 - 5 AS INT) AS y0,
  l_partkey % 7 = 0 AS no_regions
"""
_FROM = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"
_DAYS = "(20 + o_custkey % 90) * 365 + o_custkey % 365"

#: DuckDB: WITH {INST_SQL} SELECT ... FROM inst
INST_SQL = (
    "base AS (SELECT "
    + _INST_COLUMNS.format(string="VARCHAR", birth=f"strftime(DATE '1998-12-31' - CAST({_DAYS} AS INTEGER), '%Y%m%d')", study="strftime(o_orderdate, '%Y%m%d')")
    + _FROM
    + """),
inst AS (SELECT *, CASE WHEN no_regions THEN [] ELSE [
  {'rsf': rsf, 'rdt': 1, 'x0': 10, 'y0': y0, 'x1': n_cols - 20, 'y1': n_rows - 30},
  {'rsf': NULL, 'rdt': 1, 'x0': 0, 'y0': 0, 'x1': 100, 'y1': 100},
  {'rsf': 1, 'rdt': 1, 'x0': 5, 'y0': 5, 'x1': 12, 'y1': 12},
  {'rsf': 2, 'rdt': 2, 'x0': n_cols - 200, 'y0': 20, 'x1': n_cols + 50, 'y1': n_rows + 40}] END AS regions FROM base)"""
)


def inst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record view; Catalyst prunes the joins that a query does not need columns of."""
    lineitem, orders, customer, supplier, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "part"))
    joined = (
        spread(lineitem).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    text = _INST_COLUMNS.format(string="STRING", birth=f"date_format(date_sub(DATE '1998-12-31', CAST({_DAYS} AS INT)), 'yyyyMMdd')", study="date_format(o_orderdate, 'yyyyMMdd')")
    rows = joined.selectExpr(*_split(text))
    region = lambda rsf, rdt, x0, y0, x1, y1: F.struct(
        *[x.cast("int").alias(n) for n, x in zip(("rsf", "rdt", "x0", "y0", "x1", "y1"), (rsf, F.lit(rdt), x0, y0, x1, y1), strict=True)]
    )
    lit, col = F.lit, F.col
    boxes = F.array(
        region(col("rsf"), 1, lit(10), col("y0"), col("n_cols") - 20, col("n_rows") - 30),
        region(lit(None), 1, lit(0), lit(0), lit(100), lit(100)),
        region(lit(1), 1, lit(5), lit(5), lit(12), lit(12)),
        region(lit(2), 2, col("n_cols") - 200, lit(20), col("n_cols") + 50, col("n_rows") + 40),
    )
    return rows.withColumn("regions", F.when(col("no_regions"), F.array_remove(F.slice(boxes, 1, 0), boxes[0])).otherwise(boxes))


def _split(text: str) -> list[str]:
    """Select expressions of a comma-separated text, by depth of brackets."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[last:i].strip())
            last = i + 1
    return [*out, text[last:].strip()]


def elements(wide: DataFrame, keys: tuple[str, ...] = ("src_path",)) -> DataFrame:
    """Tall form: one row for each record with an array of its present fields."""
    structs = [
        F.struct(
            F.lit(f"({tag[:4]},{tag[4:]})").alias("uid"),
            F.lit(name).alias("name"),
            F.lit(name).alias("keyword"),
            F.lit(human).alias("human"),
            F.lit(int(tag[:4], 16)).alias("grp"),
            F.lit(int(tag[4:], 16)).alias("elem"),
            F.lit(f"({tag[:4]},{tag[4:]})").alias("tag"),
            F.lit(tag).alias("stripped"),
            F.lit(vr).alias("vr"),
            F.lit(0).alias("depth"),
            F.lit(False).alias("is_filemeta"),
            F.lit(int(tag[:4], 16) % 2 == 1).alias("is_private"),
            F.lit(None).cast("string").alias("private_creator"),
            F.col(name).cast("string").alias("value"),
        )
        for name, tag, vr, human in FIELDS
    ]
    return wide.select(*keys, F.filter(F.array(*structs), lambda e: e["value"].isNotNull()).alias("elements"))


def unpivoted(wide: DataFrame) -> DataFrame:
    """One row for each present field of each record, for reports only."""
    return elements(wide).select("src_path", F.explode("elements").alias("e")).select("src_path", "e.*")


#: DuckDB: the unpivoted fields of inst.
FIELDS_SQL = "flat AS (SELECT src_path, unnest([" + ", ".join(f"{{'keyword': '{n}', 'stripped': '{t}', 'vr': '{v}', 'grp': {int(t[:4], 16)}, 'value': {n}}}" for n, t, v, _ in FIELDS) + "], recursive := true) FROM inst), fields AS (SELECT * FROM flat WHERE value IS NOT NULL)"


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacement ids of every other patient, so that look-ups have misses."""
    return table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("PatientID"), F.concat(F.lit("anon-"), F.col("c_custkey")).alias("new_id"))


def ranked(df: DataFrame, by: str, name: str) -> DataFrame:
    """df with a global 1-based rank by a column, without a window over more than the partitions' counts.

    Rows are sorted by ranges sampled from the data, so that a common prefix crowds no task, and written with
    their number inside their partition; a partition's first rank is the sum of the counts before it.
    """
    at = F.monotonically_increasing_id()
    rows = df.orderBy(by).select("*", F.shiftright(at, 33).alias("__part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("__nth"))
    rows = Scratch(df.sparkSession).write(rows, "ranked")
    counts = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    # One row for each range partition: their number is a setting, not a share of the data.
    before = F.transform(F.col("all"), lambda x: F.struct(x["__part"].alias("__part"), F.aggregate(F.filter("all", lambda y: y["__part"] < x["__part"]), F.lit(0).cast("long"), lambda s, y: s + y["__n"]).alias("__first")))
    first = counts.agg(F.collect_list(F.struct("__part", "__n")).alias("all")).select(F.inline(before))
    return rows.join(F.broadcast(first), "__part").withColumn(name, F.col("__first") + F.col("__nth") + 1).drop("__part", "__nth", "__first")
