"""Binary records: round trips, nested and private elements, bad files, recipes on files."""

import struct

import pytest

from veilframe.operators.actions import Engine
from veilframe.operators.recipe import Recipe
from veilframe.sources import records as R


def element(group, elem, vr, value, uid=None, depth=0):
    shown = f"({group:04X},{elem:04X})"
    keyword, _, human = R.DICTIONARY.get((group, elem), ("", "", ""))
    return R.Element(uid or shown, keyword or shown, keyword, human, group, elem, shown, shown[1:5] + shown[6:10], vr, depth, group == 2, group % 2 == 1, None, value)


def sample():
    return [
        element(0x0008, 0x0020, "DA", "20230101"),
        element(0x0008, 0x1115, "SQ", None),
        element(0x0020, 0x000E, "UI", "1.2.3", "(0008,1115)__0__(0020,000E)", 1),
        element(0x0020, 0x000E, "UI", "1.2.4", "(0008,1115)__1__(0020,000E)", 1),
        element(0x0010, 0x0010, "PN", "Doe^Jane"),
        element(0x0028, 0x0010, "US", "64"),
        element(0x0033, 0x0010, "LO", "MITRA"),
        element(0x0033, 0x101E, "LO", "secret"),
    ]


def test_round_trip():
    found, frame = R.parse(R.serialise(sample(), b"abc"), pixels=True)
    assert frame == b"abc\0"
    got = {e.uid: e.value for e in found if not e.is_filemeta}
    assert got == {e.uid: e.value for e in sample()} | {"(7FE0,0010)": None}
    private = next(e for e in found if e.elem == 0x101E)
    assert private.is_private and private.private_creator == "MITRA"
    assert next(e for e in found if e.uid.endswith("__1__(0020,000E)")).name == "ReferencedSeriesSequence__SeriesInstanceUID"


def test_implicit_and_undefined_lengths():
    meta = R._one((2, 0x10), "UI", R._value("UI", R.IMPLICIT))
    item = struct.pack("<HHI", 0x0020, 0x000E, 6) + b"1.2.3\0"
    sequence = struct.pack("<HHI", 0x0008, 0x1115, R.UNKNOWN_LENGTH) + struct.pack("<HHI", *R.ITEM, R.UNKNOWN_LENGTH) + item + struct.pack("<HHI", *R.ITEM_END, 0) + struct.pack("<HHI", *R.SEQUENCE_END, 0)
    data = b"\0" * 128 + b"DICM" + meta + sequence + struct.pack("<HHI", 0x0010, 0x0010, 4) + b"A^B "
    found, _ = R.parse(data)
    assert {e.uid: e.value for e in found if e.grp != 2} == {"(0008,1115)": None, "(0008,1115)__0__(0020,000E)": "1.2.3", "(0010,0010)": "A^B"}


@pytest.mark.parametrize("data", [b"", b"x" * 200, R.serialise(sample())[:-3], b"\0" * 128 + b"DICM" + b"\x08\x00"])
def test_bad_files(data):
    with pytest.raises(R.RecordError):
        R.parse(data)


def test_recipe_on_files(spark, tmp_path):
    (tmp_path / "a.dcm").write_bytes(R.serialise(sample()))
    (tmp_path / "b.dcm").write_bytes(b"not a record")
    read = R.read_records(spark, str(tmp_path))
    assert {r["src_path"].rsplit("/", 1)[1]: r["error"] is None for r in read.collect()} == {"a.dcm": True, "b.dcm": False}
    engine = Engine(Recipe.parse("FORMAT dicom\n%header\nBLANK PatientName\nJITTER StudyDate 5\nREMOVE ReferencedSeriesSequence\n"), remove_private=True)
    row = engine.tall(R.valid(read)).first()
    kept = [R.Element(**e.asDict()) for e in row["elements"]]
    again, _ = R.parse(R.serialise(kept))
    assert {e.keyword: e.value for e in again if not e.is_filemeta} == {"StudyDate": "20230106", "PatientName": "", "Rows": "64"}
