"""The registered queries of the training-corpus operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .bpe import BytePairs
from .common import table
from .langid import identify
from .line_dedup import SQL as LINE_DEDUP_SQL
from .line_dedup import drop_recurring_lines
from .minhash import Sketch, near_duplicates
from .packing import best_fit
from .pitman_yor import language_model_scores
from .quality_gam import classify
from .quality_rules import quality_measures
from .sharding import interleave


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, counts=("n_lines", "n_dropped"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), sketch=Sketch(width=4, percent=80))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of the same mixture of sources."""
    return interleave(table(spark, sf_dir, "documents"), shards=16)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    pairs = BytePairs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = pairs.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="raw", drop_text=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every row whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of five permitted lengths."""
    return best_fit(table(spark, sf_dir, "documents"))


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchical Pitman-Yor scores of all documents."""
    return language_model_scores(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression bands over every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", quality_measures("text").alias("q")).select("doc_id", "q.*")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of corpus_pipeline.py, beside the package."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_minhash": op2_minhash,
        "op3_sharding": op3_sharding,
        "op4_bpe": op4_bpe,
        "op5_ann": op5_ann,
        "op6_langid": op6_langid,
        "op7_quality": op7_quality,
        "op8_packing": op8_packing,
        "op9_pitman_yor": op9_pitman_yor,
        "op10_quality_rules": op10_quality_rules,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": LINE_DEDUP_SQL}
