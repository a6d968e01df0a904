"""Binary records (tag, VR, length, value; little endian): bytes to elements and back.

Only what the format itself needs is built in; names come from a dictionary that the
caller may extend. A file that cannot be parsed gives a null array and the reason, so
one bad file never fails a job.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StringType, StructField, StructType

from .files import discover
from .views import FIELDS

#: VRs with a 32-bit length field, and those with numbers inside.
LONG_VRS = (b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV")
NUMBERS = {"US": "H", "SS": "h", "UL": "I", "SL": "i", "FL": "f", "FD": "d", "UV": "Q", "SV": "q"}
BINARY = ("OB", "OD", "OF", "OL", "OV", "OW", "UN")
IMPLICIT, EXPLICIT = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1"
ITEM, ITEM_END, SEQUENCE_END = (0xFFFE, 0xE000), (0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)
UNKNOWN_LENGTH = 0xFFFFFFFF
#: Names of the fields used here: (group, element) -> keyword, VR, human name.
DICTIONARY = {(int(t[:4], 16), int(t[4:], 16)): (n, v, h) for n, t, v, h in FIELDS} | {
    (0x0002, 0x0010): ("TransferSyntaxUID", "UI", "Transfer Syntax UID"),
    (0x0008, 0x0030): ("StudyTime", "TM", "Study Time"),
    (0x0008, 0x0050): ("AccessionNumber", "SH", "Accession Number"),
    (0x0008, 0x1115): ("ReferencedSeriesSequence", "SQ", "Referenced Series Sequence"),
    (0x0018, 0x6011): ("SequenceOfUltrasoundRegions", "SQ", "Sequence of Ultrasound Regions"),
    (0x0028, 0x0010): ("Rows", "US", "Rows"),
    (0x0028, 0x0011): ("Columns", "US", "Columns"),
    (0x7FE0, 0x0010): ("PixelData", "OW", "Pixel Data"),
}


class RecordError(ValueError):
    """Bytes that are no record."""


@dataclass
class Element:
    uid: str
    name: str
    keyword: str
    human: str
    grp: int
    elem: int
    tag: str
    stripped: str
    vr: str
    depth: int
    is_filemeta: bool
    is_private: bool
    private_creator: str | None
    value: str | None


_KINDS = {"grp": IntegerType(), "elem": IntegerType(), "depth": IntegerType(), "is_filemeta": BooleanType(), "is_private": BooleanType()}
ELEMENT = StructType([StructField(f, _KINDS.get(f, StringType())) for f in Element.__dataclass_fields__])
RECORDS = StructType([StructField("src_path", StringType()), StructField("elements", ArrayType(ELEMENT)), StructField("pixels", BinaryType()), StructField("error", StringType())])


class _Parser:
    def __init__(self, data: bytes, dictionary: dict, pixels: bool):
        self.data, self.names, self.pixels = data, dictionary, pixels
        self.found: list[Element] = []
        self.frame: bytes | None = None

    def run(self) -> None:
        if self.data[128:132] != b"DICM":
            raise RecordError("no preamble")
        at, syntax = self.level(132, len(self.data), True, "", "", 0, meta=True)
        if syntax not in (IMPLICIT, EXPLICIT) and syntax.startswith("1.2.840.10008.1.2.2"):
            raise RecordError("big endian")
        self.level(at, len(self.data), syntax != IMPLICIT, "", "", 0, meta=False)

    def head(self, at: int, explicit: bool) -> tuple[tuple[int, int], str, int, int]:
        """Tag, VR, length, and where the value starts."""
        if at + 8 > len(self.data):
            raise RecordError("ends early")
        tag = struct.unpack_from("<HH", self.data, at)
        if tag[0] == 0xFFFE or not explicit:
            return tag, self.names.get(tag, ("", "UN", ""))[1], struct.unpack_from("<I", self.data, at + 4)[0], at + 8
        vr = self.data[at + 4 : at + 6]
        if not vr.isalpha():
            raise RecordError(f"no VR at {at}")
        if vr in LONG_VRS:
            if at + 12 > len(self.data):
                raise RecordError("ends early")
            return tag, vr.decode(), struct.unpack_from("<I", self.data, at + 8)[0], at + 12
        return tag, vr.decode(), struct.unpack_from("<H", self.data, at + 6)[0], at + 8

    def level(self, at: int, end: int, explicit: bool, path: str, names: str, depth: int, meta: bool) -> tuple[int, str]:
        """The elements of one data set; file-meta elements end where their group does."""
        creators: dict[tuple[int, int], str] = {}
        syntax = EXPLICIT
        while at < end:
            if meta and self.data[at : at + 2] != b"\x02\x00":
                break  # only the file-meta group is always explicit
            tag, vr, size, start = self.head(at, explicit)
            if tag in (ITEM_END, SEQUENCE_END):
                return start, syntax
            keyword, _, human = self.names.get(tag, ("", "", ""))
            shown = f"({tag[0]:04X},{tag[1]:04X})"
            private = tag[0] % 2 == 1
            creator = creators.get((tag[0], tag[1] >> 8)) if private else None
            uid, name = path + shown, names + (keyword or shown)
            new = Element(uid, name, keyword, human, *tag, shown, f"{tag[0]:04X}{tag[1]:04X}", vr, depth, tag[0] == 2, private, creator, None)
            self.found.append(new)
            if vr == "SQ" or (size == UNKNOWN_LENGTH and tag != (0x7FE0, 0x0010)):
                at = self.items(start, start + size if size != UNKNOWN_LENGTH else end, size == UNKNOWN_LENGTH, explicit, uid, name, depth)
                new.vr = "SQ"
                continue
            if size == UNKNOWN_LENGTH:  # encapsulated frames: fragments until the end mark
                parts = []
                while True:
                    tag2, _, n, s = self.head(start, True)
                    start = s + n
                    if tag2 == SEQUENCE_END:
                        break
                    parts.append(self.data[s:start])
                self.frame, at = b"".join(parts[1:]) if self.pixels else None, start
                continue
            if start + size > len(self.data):
                raise RecordError("ends early")
            raw, at = self.data[start : start + size], start + size
            if tag == (0x7FE0, 0x0010):
                self.frame = raw if self.pixels else None
                continue
            new.value = self.text(raw, vr)
            if private and 0x10 <= tag[1] <= 0xFF:
                creators[tag[0], tag[1]] = new.value or ""
            if tag == (2, 0x10):
                syntax = new.value or EXPLICIT
        return at, syntax

    def items(self, at: int, end: int, open_ended: bool, explicit: bool, uid: str, name: str, depth: int) -> int:
        k = 0
        while at < end:
            tag, _, size, start = self.head(at, explicit)
            if tag == SEQUENCE_END:
                return start
            if tag != ITEM:
                raise RecordError("no item in a sequence")
            stop = end if size == UNKNOWN_LENGTH else start + size
            at, _ = self.level(start, stop, explicit, f"{uid}__{k}__", f"{name}__", depth + 1, meta=False)
            k += 1
        if open_ended:
            raise RecordError("ends early")
        return at

    def text(self, raw: bytes, vr: str) -> str:
        if vr in NUMBERS:
            n = len(raw) // struct.calcsize(NUMBERS[vr])
            return "\\".join(str(x) for x in struct.unpack(f"<{n}{NUMBERS[vr]}", raw[: n * struct.calcsize(NUMBERS[vr])]))
        if vr in BINARY:
            return raw.hex()
        return raw.decode("utf-8", "replace").rstrip("\0 ")


def parse(data: bytes, dictionary: dict | None = None, pixels: bool = False) -> tuple[list[Element], bytes | None]:
    """Flattened elements, depth first, and the pixel bytes if asked for."""
    parser = _Parser(data, DICTIONARY if dictionary is None else dictionary, pixels)
    try:
        parser.run()
    except (struct.error, IndexError) as e:
        raise RecordError(str(e)) from e
    return parser.found, parser.frame


def _value(vr: str, value: str | None) -> bytes:
    if not value:
        return b""
    if vr in NUMBERS:
        kind = float if NUMBERS[vr] in "fd" else int
        raw = b"".join(struct.pack("<" + NUMBERS[vr], kind(v)) for v in value.split("\\"))
    else:
        raw = bytes.fromhex(value) if vr in BINARY else value.encode()
    return raw + (b"\0" if vr in ("UI", *BINARY) else b" ") * (len(raw) % 2)


def _one(tag: tuple[int, int], vr: str, body: bytes) -> bytes:
    code = vr.encode()
    head = struct.pack("<HH", *tag) + code
    return head + (b"\0\0" + struct.pack("<I", len(body)) if code in LONG_VRS else struct.pack("<H", len(body))) + body


def serialise(elements: list[Element], pixels: bytes | None = None) -> bytes:
    """A file in explicit VR with a zero preamble; nested elements are put below their parents by their paths."""
    below: dict[str, list[Element]] = {}
    for e in elements:
        below.setdefault(e.uid.rpartition("__")[0], []).append(e)

    def level(path: str) -> bytes:
        out = b""
        for e in sorted(below.get(path, []), key=lambda e: (e.grp, e.elem)):
            if e.vr == "SQ":
                body, k = b"", 0
                while f"{e.uid}__{k}" in below:
                    inner = level(f"{e.uid}__{k}")
                    body += struct.pack("<HHI", *ITEM, len(inner)) + inner
                    k += 1
                out += _one((e.grp, e.elem), "SQ", body)
            elif (e.grp, e.elem) != (0x7FE0, 0x0010):
                out += _one((e.grp, e.elem), e.vr, _value(e.vr, e.value))
        return out

    meta = _one((2, 0x10), "UI", _value("UI", EXPLICIT))
    below[""] = [e for e in below.get("", []) if e.grp != 2]
    body = level("") + (_one((0x7FE0, 0x0010), "OW", pixels + b"\0" * (len(pixels) % 2)) if pixels is not None else b"")
    return b"\0" * 128 + b"DICM" + _one((2, 0), "UL", struct.pack("<I", len(meta))) + meta + body


def read_records(spark: SparkSession, root: str, pattern: str = "*", pixels: bool = False) -> DataFrame:
    """Tall records of all files below a folder: src_path, elements, pixels, error. Pixel bytes cross only when asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(RECORDS)
        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    found, frame = parse(content, pixels=pixels)
                    rows.append({"src_path": path, "elements": [asdict(e) for e in found], "pixels": frame, "error": None})
                except RecordError as e:
                    rows.append({"src_path": path, "elements": None, "pixels": None, "error": str(e)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return discover(spark, root, pattern, content=True).select("path", "content").mapInArrow(run, RECORDS)


def valid(records: DataFrame) -> DataFrame:
    """The records that could be parsed."""
    return records.where("error is null")
