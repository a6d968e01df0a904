"""Every registered query of the library against its SQL, and the plans and sinks around them."""

import os

import duckdb
import pandas as pd
import pytest

from veilframe.plans import batch, catalogue
from veilframe.sources import files, views
from veilframe.streaming import stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"create view {t.removesuffix('.parquet')} as select * from '{SF}/{t}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    clean = lambda v: None if pd.isna(v) else v.item() if hasattr(v, "item") else v
    return sorted(repr(tuple(clean(v) for v in r)) for r in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_interval_rate_of_halves_nulls_and_zones(spark, tmp_path, zone):
    """Halves of a second on both sides of an even number, times across a change of the clock, nulls, and a gap of millennia."""
    times = [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:00.5", "2024-01-01 00:00:02", "2024-01-01 00:00:04.5", "2024-01-01 00:00:08", "2024-01-01 00:00:08.499999", "2024-01-01 00:00:09"),
        ("2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 03:30:00.5", "2024-11-03 00:30:00", "2024-11-03 01:30:00", "2024-11-03 02:30:02.5"),
        (None, "2024-01-01 00:00:00", "2024-01-01 00:00:00", None),
        ("0001-01-01 00:00:00", "9999-01-01 00:00:00.499999", "9999-01-01 00:00:00.499999"),
    ]
    ids = iter(range(100))
    events = [(next(ids), t, user) for user, of in enumerate(times) for t in of] + [(None, "2024-01-01 00:00:00", 2), (None, None, None)]
    con = duckdb.connect()
    con.execute("create table events (event_id bigint, ts timestamp, user_id bigint)")
    con.executemany("insert into events values (?, ?::timestamp, ?)", events)
    con.execute(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [tuple(r) for r in catalogue.queries()["log_interval_rate"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = con.sql(catalogue.oracle_sql()["log_interval_rate"]).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_statuses(spark):
    t, f = "true", "false"
    from pyspark.sql import functions as F

    us, boxes = "'1.2.840.10008.5.1.4.1.1.3.1'", "array(named_struct('rsf', 1))"
    cases = [(f, us, boxes, t, t, t), (t, "'x'", boxes, t, t, t), (t, us, "cast(array() as array<struct<rsf:int>>)", t, t, t), (t, us, "array(named_struct('rsf', 9))", t, t, t),
             (t, us, boxes, f, t, t), (t, us, boxes, t, f, t), (t, us, boxes, t, t, f), (t, us, boxes, t, t, t)]
    got = [spark.range(1).select(batch.status(*[F.expr(c) for c in case])).first()[0] for case in cases]
    assert tuple(got) == batch.STATUSES


def test_resume_and_first(spark):
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "src_path string")
    log = spark.createDataFrame([("a", "success", 1), ("a", "pixel_fail", 2), ("b", "pixel_fail", 3)], "src_path string, status string, seq int")
    assert [r[0] for r in batch.plan_work(todo, log).collect()] == ["c"]
    assert sorted(r[0] for r in batch.plan_work(todo, log, retry_failed=True).collect()) == ["b", "c"]
    assert sorted(r["seq"] for r in batch.first_rows(log, "seq").collect()) == [1, 3]


def test_manifest_and_archives(spark, tmp_path):
    import zipfile

    root = tmp_path / "in"
    root.mkdir()
    for n in "ab":
        (root / f"{n}.dcm").write_bytes(b"x")
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("first", "1")
        z.writestr("second", "2")
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    found = files.discover(spark, str(root), "*.dcm")
    assert found.count() == 2 and "content" not in found.columns
    files.write_manifest(found, str(tmp_path / "m"), str(root))
    assert files.load_manifest(spark, str(tmp_path / "m"), str(root)).count() == 2
    assert files.load_manifest(spark, str(tmp_path / "m"), "elsewhere") is None
    assert files.load_manifest(spark, str(tmp_path / "missing"), str(root)) is None
    spark.dataSource.register(files.ZipSource)
    got = spark.read.format("zip_first").load(f"{tmp_path}/one.zip,{tmp_path}/none.zip").collect()
    assert [(r["member"], bytes(r["content"])) for r in got] == [("first", b"1")]


def test_output_is_never_overwritten(spark, tmp_path):
    out = batch.layout(views.inst(spark, SF).limit(5)).select("src_path", "patient_dir", "study_dir", "series_dir")
    batch.write_records(out, str(tmp_path / "o"))
    with pytest.raises(Exception, match="already exists"):
        batch.write_records(out, str(tmp_path / "o"))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    sink = stream.append_first(str(tmp_path / "log"))
    batch_rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "src_path string, n int")
    sink(batch_rows, 0)
    sink(batch_rows, 0)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_cli(spark, tmp_path):
    from veilframe import cli

    recipe = tmp_path / "r"
    recipe.write_text("FORMAT dicom\n%filter f\nLABEL x\nequals Modality US\ncoordinates all\n%header\nBLANK PatientName\n")
    views.inst(spark, SF).select("src_path", "Modality", "PatientName").limit(20).write.parquet(str(tmp_path / "in"))
    args = ["--recipe", str(recipe), "--input", str(tmp_path / "in")]
    assert cli.main(["inspect", *args, "--output", str(tmp_path / "report")]) == 0
    assert cli.main(["identifiers", *args, "--output", str(tmp_path / "out")]) == 0
    assert {r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("PatientName").collect()} == {""}


def test_no_precedence_matters(duck):
    """The fold's query would give other rows if `and` bound tighter."""
    from veilframe.sources.views import INST_SQL

    tests = ("coalesce(regexp_matches(Manufacturer, '(?i)vingmed'), false)", "lower(Modality) = 'us'", "regexp_matches(StudyDescription, '(?i)PROMO')")
    n = duck.sql("WITH {} SELECT count(*) FROM inst WHERE (({} OR {}) AND {}) <> ({} OR ({} AND {}))".format(INST_SQL, *tests, *tests)).fetchall()[0][0]
    assert n > 100
