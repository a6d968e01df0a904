"""Sharding by proportional stratified interleaving.

Rows are ranked in a seeded shuffled order within each source; (rank + 1/2) / rows
of the source is a row's fractional rank; all rows are sorted by it and the order is
cut into shards whose row counts differ by one at most. Every shard then holds each
source in the proportion of the whole, to within a row or two.

No source is ever gathered in one task: the shuffled order is cut into buckets of
about `rows_per_bucket` rows by the leading bits of the seeded hash, the (small)
table of bucket counts gives each bucket's first rank, and rows are numbered inside
their bucket only. The same is done for the global order. Equal rows are counted and
dealt in parts of bounded size, each with a hash of its own, so that neither a repeated
nor a null id crowds a bucket. Only ids, sizes and hashes are shuffled, never texts.

Defined results: a null source is a source of its own; a null text has no bytes and
crc32 0; null ids and repeated rows are ordinary rows (equal rows are interchangeable);
an empty table gives an empty table; the result has only the columns named here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, copies

LAW = "rows"
SEED = "veilframe-1"
#: The seeded order is that of the leading 52 bits of a digest, exact in a double.
BITS = 52


def _first_ranks(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """counts with `first`: the rows in all buckets before."""
    before = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = before.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))


def interleave(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
    rows_per_bucket: int = 8192,
) -> DataFrame:
    """id, size, text_crc32, position (0-based global), law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.concat(F.when(F.col(source_col).isNull(), "0").otherwise("1"), F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("src"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = copies(rows, rows_per_bucket)
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("id", "text_crc32", "size", "copy_part")]).cast("binary"))
    rows = rows.withColumn("h", F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long"))
    scratch = Scratch(spark)
    rows = scratch.write(rows, "rows")
    per_source = scratch.write(rows.groupBy("src").agg(F.sum("copies").alias("n_src")), "sources")
    total = per_source.agg(F.coalesce(F.sum("n_src"), F.lit(0))).first()[0]

    buckets = F.ceil(F.col("n_src") / rows_per_bucket)
    placed = rows.join(per_source, "src").withColumn("b", F.floor(F.col("h") * F.lit(2.0**-BITS) * buckets).cast("long"))
    firsts = _first_ranks(placed.groupBy("src", "b").agg(F.sum("copies").alias("n")), ["src"], "b").drop("n")
    inside = W.partitionBy("src", "b").orderBy("h", "id", "text_crc32", "size", "copy_part").rowsBetween(W.unboundedPreceding, 0)
    before = F.col("first") + F.sum("copies").over(inside) - F.col("copies")
    ranked = placed.join(firsts, ["src", "b"]).withColumn("before", before)
    ranked = ranked.select("id", "size", "text_crc32", "src", "n_src", F.explode(F.sequence("before", F.col("before") + F.col("copies") - 1)).alias("rank"))
    # Half ranks as whole numbers: bucket = floor((2 rank + 1) / (2 n) * buckets).
    slices = max(1, -(-total // rows_per_bucket))
    ranked = ranked.withColumn("part", F.expr(f"((2 * rank + 1) * {slices}L) div (2 * n_src)"))
    ranked = scratch.write(ranked, "ranked")
    parts = _first_ranks(ranked.groupBy("part").agg(F.count("*").alias("n")), [], "part").drop("n")
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("n_src"))
    across = W.partitionBy("part").orderBy(fraction, "src", "rank")
    position = (F.col("first") + F.row_number().over(across) - 1).cast("long")
    size = max(total, 1)
    return (
        ranked.join(parts, "part")
        .withColumn("position", position)
        .withColumn("shard", F.expr(f"cast(position * {shards}L div {size}L as int)"))
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit(LAW).alias("law"),
            "shard",
            F.expr(f"position - (shard * {size}L + {shards - 1}L) div {shards}L").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "position",
        )
    )
