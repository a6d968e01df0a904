"""Header actions in wide and tall form."""

import hashlib

import pytest
from pyspark.sql import functions as F

from veilframe.functions import values as V
from veilframe.operators.actions import Engine, as_wide
from veilframe.operators.recipe import Recipe
from veilframe.operators.selectors import Field
from veilframe.plans.catalogue import _KINDS, MATRIX, SALT, matrix_recipe
from veilframe.sources.views import FIELDS, NAMES, elements

META = [Field(n, t, v, h) for n, t, v, h in FIELDS]
ELEMENT = "struct<uid:string,name:string,keyword:string,human:string,grp:int,elem:int,tag:string,stripped:string,vr:string,depth:int,is_filemeta:boolean,is_private:boolean,private_creator:string,value:string>"


@pytest.fixture(scope="module")
def record(spark):
    row = {n: None for n in NAMES} | {"PatientID": "42", "PatientName": "A^B", "StudyDate": "20230101", "PatientBirthDate": "19300101", "Manufacturer": "foo", "OperatorsName": "A^B"}
    return spark.createDataFrame([("p", *[row[n] for n in NAMES])], "src_path string, " + ", ".join(f"{n} string" for n in NAMES)).cache()


def both(record, header, names, groups=""):
    engine = Engine(Recipe.parse(f"FORMAT dicom\n{groups}%header\n{header}"), salt=SALT)
    wide = engine.wide(record, META).select(*names).first()
    tall = as_wide(engine.tall(elements(record)), list(names)).select(*names).first()
    return tuple(wide), tuple(tall)


def test_matrix_wide_and_tall(spark, record):
    """All 36 pairs, as the SQL of the catalogue has them."""
    import duckdb

    for a in _KINDS:
        for j, b in enumerate(_KINDS):
            want = duckdb.sql(f"SELECT ({MATRIX[a][j]})::VARCHAR FROM (SELECT '20230101' AS StudyDate)").fetchall()[0][0]
            wide, tall = both(record, matrix_recipe(a, b), ["StudyDate"])
            assert wide == tall == (want,), (a, b)


def test_order_of_surrogates(record):
    header = "REPLACE PatientID deid_func:id_hash\nREPLACE StudyDate deid_func:jitter\nREPLACE PatientBirthDate deid_func:jitter_birthdate_cap_89\n"
    pid = hashlib.sha256((SALT + "42").encode()).hexdigest()[:16]
    wide, tall = both(record, header, ["PatientID", "StudyDate", "PatientBirthDate"])
    assert wide == tall and wide[0] == pid and wide[2][:4] == str(int(wide[1][:4]) - 89)


def test_groups(record):
    groups = "%values names\nFIELD PatientName\n%values none\nFIELD SeriesNumber\n%fields dates\nFIELD endswith:Date\n"
    wide, tall = both(record, "BLANK values:names\nBLANK values:none\nREPLACE fields:dates X\n", ["PatientName", "OperatorsName", "StudyDate", "Manufacturer"], groups)
    assert wide == tall == ("", "", "X", "foo")  # an empty group selects nothing


def test_missing_salt_fails(record):
    with pytest.raises(ValueError):
        Engine(Recipe.parse("FORMAT dicom\n%header\nREPLACE PatientID deid_func:id_hash\n")).wide(record, META)


def element(uid, keyword, vr="LO", depth=0, value="v", private=None, grp=8, elem=1):
    stripped = f"{grp:04X}{elem:04X}"
    return (uid, uid, keyword, keyword, grp, elem, f"({stripped[:4]},{stripped[4:]})", stripped, vr, depth, False, grp % 2 == 1, private, value)


def test_nested_and_private(spark):
    rows = [element("(0008,1115)", "Seq", "SQ"), element("(0008,1115)__0__(0020,000E)", "SeriesInstanceUID", "UI", 1, "inner"), element("(0020,000E)", "SeriesInstanceUID", "UI", 0, "outer"), element("(0033,101E)", "", "LO", 0, "secret", "MITRA", 0x33, 0x101E)]
    df = spark.createDataFrame([(rows,)], f"elements array<{ELEMENT}>")

    def left(header, **options):
        engine = Engine(Recipe.parse(f"FORMAT dicom\n%header\n{header}"), salt=SALT, **options)
        return [(e["uid"], e["value"]) for e in engine.tall(df).first()["elements"]]

    assert [u for u, _ in left("REMOVE Seq\n")] == ["(0020,000E)", "(0033,101E)"]  # what lies below goes too
    assert [v for _, v in left("BLANK SeriesInstanceUID\n")] == ["v", "", "", "secret"]
    assert [u for u, _ in left('REMOVE (0033,"MITRA",1E)\n')] == [r[0] for r in rows[:3]]
    assert [u for u, _ in left("KEEP PatientID\n", remove_private=True, strip_sequences=True)] == ["(0020,000E)"]
    # Hashes of nested and top-level values of one keyword stay apart.
    hashed = dict(left("REPLACE SeriesInstanceUID deid_func:pydicom_uuid_salt\n"))
    assert hashed["(0020,000E)"] != hashed["(0008,1115)__0__(0020,000E)"]


@pytest.mark.parametrize("patient", ["1", "42", "abc", ""])
def test_day_offset(spark, patient):
    h = int(hashlib.sha256(f"{SALT}|{patient}".encode()).hexdigest(), 16)
    want = (h % 365 + 1) * (-1 if h % 2 else 1)
    assert spark.range(1).select(V.day_offset(F.lit(patient), SALT)).first()[0] == want


@pytest.mark.parametrize(
    "column,want",
    [
        (lambda: V.shift_datetime(F.lit("20230101011721.621"), F.lit(1)), "20230102011721.621000"),
        (lambda: V.shift_datetime(F.lit("20230101011721-0500"), F.lit(1)), "20230102011721.000000-0500"),
        (lambda: V.shift_date(F.lit("NOTADATE"), F.lit(1)), None),
        (lambda: V.birth_date_cap(F.lit("19000101"), F.lit(0), F.lit("20240229")), "19350228"),
        (lambda: V.birth_date_cap(F.lit("19300101"), F.lit(1), F.lit("NOTADATE")), "19300102"),
        (lambda: V.zero_pad(F.lit(1234), 3), "1234"),
        (lambda: V.as_int(F.lit(" 7.9 ")).cast("string"), "7"),
        (lambda: V.sanitize(F.lit("  ")), "UNKNOWN"),
        (lambda: V.sanitize(F.lit("a/b\\c")), "a_b_c"),
        (lambda: V.convert(F.lit("x"), "FL"), ""),
        (lambda: V.convert(F.lit("7"), "US"), "7"),
        (lambda: V.distinct_sorted(F.array(F.lit(3), F.lit(1), F.lit(3))), "1,3"),
    ],
)
def test_functions(spark, column, want):
    assert spark.range(1).select(column()).first()[0] == want


def test_functions_get_the_element(record):
    """Predicates, functions and literals see the field's own metadata in both forms."""
    functions = {"is_name": lambda v, f, get, x: F.lit(f.vr == "PN") & v.isNotNull(), "shout": lambda v, f, get, x: F.concat(F.upper(v), F.lit("/"), get("PatientID"))}

    def run(header):
        engine = Engine(Recipe.parse(f"FORMAT dicom\n%header\n{header}"), salt=SALT, functions=functions)
        names = ["PatientName", "OperatorsName", "Manufacturer", "PatientID"]
        return tuple(engine.wide(record, META).select(*names).first()), tuple(as_wide(engine.tall(elements(record)), names).select(*names).first())

    wide, tall = run("REMOVE all func:is_name\n")
    assert wide == tall == (None, None, "foo", "42")
    wide, tall = run("REPLACE PatientID 43\nREPLACE Manufacturer func:shout\n")
    assert wide == tall == ("A^B", "A^B", "FOO/43", "43")
    wide, tall = run("REPLACE endswith:Name deid_func:suffix_uuid\n")
    assert all(v[:-36] == f"{n}-" for row in (wide, tall) for v, n in zip(row, ("patientname", "operatorsname"), strict=False))
    wide, tall = run("REPLACE PatientName deid_func:pydicom_uuid stable_remapping=false\n")
    assert wide[0] != tall[0] and wide[0].startswith("2.25.") and tall[0].startswith("2.25.")


def test_wide_private_and_sequences(spark):
    df = spark.createDataFrame([("p", "secret", "s")], "src_path string, Own string, Seq string")
    engine = Engine(Recipe.parse("FORMAT dicom\n%header\nKEEP Own\n"), remove_private=True, strip_sequences=True)
    got = engine.wide(df, [Field("Own", "00331010", "LO"), Field("Seq", "00081115", "SQ")]).first()
    assert got["Own"] is None and got["Seq"] is None


def test_tags():
    from veilframe.functions import tags

    assert tags.by_keyword("PatientIdentityRemoved").tag == "00120062" and tags.by_any("(0010,0020)").keyword == "PatientID"
    assert [t.keyword for t in tags.find("Patient", vr="DA")] == ["PatientBirthDate"] and tags.find("nothing like it") == []
    assert tags.define("00331010", "LO").is_private and tags.by_any("Patient's Name").keyword == "PatientName"
    with pytest.raises(ValueError):
        tags.define("x")


def test_update_and_private(spark):
    from veilframe.operators.actions import has_private, private_elements, update_field

    rows = [element("(0010,0010)", "PatientName", "PN", value="A", grp=0x10, elem=0x10), element("(0033,1010)", "", value="p", private="X", grp=0x33, elem=0x1010)]
    df = spark.createDataFrame([(rows,), (rows[:1],)], f"elements array<{ELEMENT}>")
    e = F.col("elements")
    got = df.select(has_private(e), F.size(private_elements(e)), update_field(e, "PatientName", F.lit("B"))[0]["value"], F.size(update_field(e, "PatientID", F.lit("B")))).collect()
    assert [tuple(r) for r in got] == [(True, 1, "B", 2), (False, 0, "B", 1)]
