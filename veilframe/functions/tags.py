"""The dictionary of field names: tag, VR, multiplicity, human name and keyword, with look-up and search.

Only the fields that headers commonly carry are built in; a dictionary is a plain mapping,
and `define` gives a larger one, so that a caller may load the whole standard.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Tag:
    """tag: eight hexadecimal digits; vm: how many values a field may hold."""

    tag: str
    vr: str
    vm: str
    name: str
    keyword: str

    @property
    def pair(self) -> tuple[int, int]:
        return int(self.tag[:4], 16), int(self.tag[4:], 16)

    @property
    def is_private(self) -> bool:
        return self.pair[0] % 2 == 1


#: Fields of the standard in tag order: tag, VR, multiplicity, human name.
_STANDARD = """
00020010 UI 1 Transfer Syntax UID
00080005 CS 1-n Specific Character Set
00080008 CS 2-n Image Type
00080012 DA 1 Instance Creation Date
00080013 TM 1 Instance Creation Time
00080016 UI 1 SOP Class UID
00080018 UI 1 SOP Instance UID
00080020 DA 1 Study Date
00080021 DA 1 Series Date
00080022 DA 1 Acquisition Date
00080023 DA 1 Content Date
0008002A DT 1 Acquisition DateTime
00080030 TM 1 Study Time
00080031 TM 1 Series Time
00080032 TM 1 Acquisition Time
00080033 TM 1 Content Time
00080050 SH 1 Accession Number
00080060 CS 1 Modality
00080064 CS 1 Conversion Type
00080070 LO 1 Manufacturer
00080080 LO 1 Institution Name
00080081 ST 1 Institution Address
00080090 PN 1 Referring Physician's Name
00081010 SH 1 Station Name
00081030 LO 1 Study Description
0008103E LO 1 Series Description
00081040 LO 1 Institutional Department Name
00081048 PN 1-n Physician(s) of Record
00081050 PN 1-n Performing Physician's Name
00081060 PN 1-n Name of Physician(s) Reading Study
00081070 PN 1-n Operators' Name
00081090 LO 1 Manufacturer's Model Name
00081110 SQ 1 Referenced Study Sequence
00081115 SQ 1 Referenced Series Sequence
00081140 SQ 1 Referenced Image Sequence
00081150 UI 1 Referenced SOP Class UID
00081155 UI 1 Referenced SOP Instance UID
00082111 ST 1 Derivation Description
00082112 SQ 1 Source Image Sequence
00082120 SH 1 Stage Name
00082122 IS 1 Stage Number
00082128 IS 1 View Number
0008212A IS 1 Number of Views in Stage
00082142 IS 1 Start Trim
00082143 IS 1 Stop Trim
00082144 IS 1 Recommended Display Frame Rate
00100010 PN 1 Patient's Name
00100020 LO 1 Patient ID
00100021 LO 1 Issuer of Patient ID
00100030 DA 1 Patient's Birth Date
00100032 TM 1 Patient's Birth Time
00100040 CS 1 Patient's Sex
00101000 LO 1-n Other Patient IDs
00101001 PN 1-n Other Patient Names
00101010 AS 1 Patient's Age
00101020 DS 1 Patient's Size
00101030 DS 1 Patient's Weight
00101040 LO 1 Patient's Address
00102154 SH 1-n Patient's Telephone Numbers
00102160 SH 1 Ethnic Group
00102180 SH 1 Occupation
001021B0 LT 1 Additional Patient History
00104000 LT 1 Patient Comments
00120062 CS 1 Patient Identity Removed
00120063 LO 1-n De-identification Method
00180015 CS 1 Body Part Examined
00181000 LO 1 Device Serial Number
00181020 LO 1-n Software Versions
00181030 LO 1 Protocol Name
00181063 DS 1 Frame Time
00181065 DS 2-n Frame Time Vector
00185010 LO 1-n Transducer Data
00186011 SQ 1 Sequence of Ultrasound Regions
00186012 US 1 Region Spatial Format
00186014 US 1 Region Data Type
00186016 UL 1 Region Flags
00186018 UL 1 Region Location Min X0
0018601A UL 1 Region Location Min Y0
0018601C UL 1 Region Location Max X1
0018601E UL 1 Region Location Max Y1
00186024 US 1 Physical Units X Direction
00186026 US 1 Physical Units Y Direction
0018602C FD 1 Physical Delta X
0018602E FD 1 Physical Delta Y
0020000D UI 1 Study Instance UID
0020000E UI 1 Series Instance UID
00200010 SH 1 Study ID
00200011 IS 1 Series Number
00200012 IS 1 Acquisition Number
00200013 IS 1 Instance Number
00200020 CS 2 Patient Orientation
00200052 UI 1 Frame of Reference UID
00204000 LT 1 Image Comments
00280002 US 1 Samples per Pixel
00280004 CS 1 Photometric Interpretation
00280006 US 1 Planar Configuration
00280008 IS 1 Number of Frames
00280009 AT 1-n Frame Increment Pointer
00280010 US 1 Rows
00280011 US 1 Columns
00280100 US 1 Bits Allocated
00280101 US 1 Bits Stored
00280102 US 1 High Bit
00280103 US 1 Pixel Representation
00280301 CS 1 Burned In Annotation
00281101 US 3 Red Palette Color Lookup Table Descriptor
00281102 US 3 Green Palette Color Lookup Table Descriptor
00281103 US 3 Blue Palette Color Lookup Table Descriptor
00281201 OW 1 Red Palette Color Lookup Table Data
00281202 OW 1 Green Palette Color Lookup Table Data
00281203 OW 1 Blue Palette Color Lookup Table Data
00283010 SQ 1 VOI LUT Sequence
00321032 PN 1 Requesting Physician
00321060 LO 1 Requested Procedure Description
00400244 DA 1 Performed Procedure Step Start Date
00400245 TM 1 Performed Procedure Step Start Time
00400253 SH 1 Performed Procedure Step ID
00400254 LO 1 Performed Procedure Step Description
0040A124 UI 1 UID
7FE00010 OW 1 Pixel Data
"""


def keyword_of(name: str) -> str:
    """The keyword of a human name: its words joined with capitals, without possessives, brackets and hyphens."""
    return "".join(w[0].upper() + w[1:] for w in re.sub(r"['’]s\b|['’()-]", "", name).split())


def _parse(text: str) -> dict[str, Tag]:
    rows = (line.split(None, 3) for line in text.strip().splitlines())
    return {t.keyword: t for t in (Tag(tag, vr, vm, name, keyword_of(name)) for tag, vr, vm, name in rows)}


STANDARD: Mapping[str, Tag] = _parse(_STANDARD)


def define(identifier: str, vr: str = "ST", vm: str = "", name: str = "", keyword: str = "") -> Tag:
    """A new tag, by its eight digits; short text unless told otherwise."""
    digits = re.sub(r"[(),\s]|^0x", "", identifier)
    if not re.fullmatch(r"[0-9A-Fa-f]{8}", digits):
        raise ValueError(f"{identifier!r} is no tag")
    return Tag(digits.upper(), vr, vm, name, keyword)


def by_keyword(keyword: str, tags: Mapping[str, Tag] = STANDARD) -> Tag | None:
    """The tag of a keyword."""
    return tags.get(keyword)


_RENDERED = {x.lower(): t for t in STANDARD.values() for x in (t.tag, t.name, t.keyword)}


def by_any(text: str) -> Tag | None:
    """The standard's tag of a keyword, of eight digits with or without brackets, or of a human name, whatever the case."""
    want = text.strip().lower()
    return _RENDERED.get(want) or _RENDERED.get(re.sub(r"[(),\s]", "", want))


def find(term: str, vr: str | Iterable[str] | None = None, vm: str | Iterable[str] | None = None, tags: Mapping[str, Tag] = STANDARD) -> list[Tag]:
    """Tags whose keyword or name the pattern is found in, with these VRs and multiplicities only; in tag order."""
    among = lambda x, allowed: allowed is None or x in ([allowed] if isinstance(allowed, str) else list(allowed))
    found = [t for t in tags.values() if (re.search(term, t.keyword) or re.search(term, t.name)) and among(t.vr, vr) and among(t.vm, vm)]
    return sorted(found, key=lambda t: t.tag)
