"""The corpus pipeline, stage by stage, against brute force."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from veilframe.llm import langid, line_dedup, minhash
from veilframe.llm.quality_rules import Bands, measure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The tables between the stages, written and read as the driver does."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_order_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "lines", "near_duplicates", "packing"]
    for table in stages[1:-1]:
        assert table.columns == stages[0].columns


def test_quality_keeps_what_the_rules_keep(stages):
    import zstandard

    compressor = zstandard.ZstdCompressor(level=3)
    want = {r["doc_id"] for r in stages[0].collect() if measure(r["text"], Bands(), compressor)[-1]}
    assert {r["doc_id"] for r in stages[1].collect()} == want


def test_language_rejects_only_unknown(stages):
    kept = {r["doc_id"] for r in stages[2].collect()}
    for r in stages[1].collect():
        assert r["doc_id"] in kept or not langid.LETTER.search(r["text"]) or len(r["text"]) < 400


def test_lines_by_sql(spark, stages):
    import duckdb

    con = duckdb.connect()
    con.register("documents", stages[2].toPandas())
    want = {d: t for d, t, *_ in con.sql(line_dedup.SQL).fetchall() if t.strip()}
    assert {r["doc_id"]: r["text"] for r in stages[3].collect()} == want


def test_one_of_each_group_stays(stages):
    sets = {r["doc_id"]: frozenset(minhash.shingle_set(r["text"], 5, minhash.WordHashes()).tolist()) for r in stages[3].collect()}
    kept = {r["doc_id"] for r in stages[4].collect()}
    close = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(close(a, b) for a in kept for b in kept if a < b)
    for gone in set(sets) - kept:
        assert any(close(gone, other) for other in sets if other != gone)


def test_packing_holds_every_document_once(stages):
    sizes = {r["doc_id"]: len(r["text"].encode().split()) + 1 for r in stages[4].collect()}
    got = dict.fromkeys(sizes, 0)
    for b in stages[5].collect():
        for d, s, e in zip(b["doc_ids"], b["starts"], b["ends"]):
            got[d] += e - s
    assert got == sizes


def test_run_and_registration(spark, stages):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"](spark, SF).agg(F.sum("used")).first()[0] == stages[5].agg(F.sum("used")).first()[0]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "the cat sat on the mat and looked at the dog for a while today", None, None, None), (2, "the cat sat on the mat and looked at the dog for a while today", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        stage(spark, docs.where("false"), SF).collect()
