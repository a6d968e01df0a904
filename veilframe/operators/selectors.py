"""Field selectors: an expression names fields by keyword, tag, human name, pattern, VR or group.

One parsed selector works in both forms. In wide form fields are columns and are chosen
on the driver by their metadata; in tall form the selector is a predicate over an
element struct, evaluated inside a higher-order function.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import tags

#: Keywords that no selector reaches.
PROTECTED = (
    "PixelData",
    "RedPaletteColorLookupTableData",
    "GreenPaletteColorLookupTableData",
    "BluePaletteColorLookupTableData",
    "VOILUTSequence",
    "FileMetaInformationGroupLength",
    "FileMetaInformationVersion",
    "TransferSyntaxUID",
    "ImplementationClassUID",
)
EXPANDERS = ("contains", "startswith", "endswith", "except", "select")


@dataclass(frozen=True)
class Field:
    """Metadata of a field: texts for a wide column, columns for an element of the tall form."""

    keyword: str | Column
    tag: str | Column = ""
    vr: str | Column = "LO"
    human: str | Column = ""

    @staticmethod
    def of(e: Column) -> Field:
        """The metadata of an element."""
        return Field(e["keyword"], e["stripped"], e["vr"], e["human"])

    @property
    def is_private(self) -> bool:
        """Whether a wide column is a private field: its group is odd."""
        return bool(self.tag) and int(self.tag[:4], 16) % 2 == 1

    @property
    def renderings(self) -> tuple[str, ...]:
        return tuple(x for x in (self.keyword, f"({self.tag[:4]},{self.tag[4:]})" if self.tag else "", self.tag, self.human) if x)


@dataclass(frozen=True)
class Selector:
    """kind: all, exact, contains, startswith, endswith, except, select, or none (unknown expander)."""

    kind: str
    text: str = ""

    @staticmethod
    def parse(expression: str) -> Selector:
        if expression.lower() == "all":
            return Selector("all")
        head, sep, rest = expression.partition(":")
        if not sep or "(" in head or '"' in head:
            return Selector("exact", expression)
        kind = head.lower()
        return Selector(kind if kind in EXPANDERS else "none", rest)

    @property
    def pattern(self) -> str:
        """The regular expression of the pattern kinds."""
        return {"startswith": f"^({self.text})", "endswith": f"({self.text})$"}.get(self.kind, self.text)

    @property
    def pair(self) -> tuple[int, int] | None:
        """Group and element of an exact selector that names a known field, by whichever rendering."""
        tag = tags.by_any(self.text) if self.kind == "exact" else None
        return tag.pair if tag else None

    def picks(self, field: Field) -> bool:
        """Whether a wide column is selected."""
        if self.kind == "all":
            return True
        if self.kind == "exact":
            return self.text.lower() in {r.lower() for r in field.renderings}
        if self.kind == "select":
            what, _, value = self.text.partition(":")
            if what.upper() == "VR":
                return field.vr == value[:2].upper()
            return what.upper() == "GROUP" and bool(field.tag) and int(field.tag[:4], 16) == int(value, 16)
        if self.kind in ("contains", "startswith", "endswith", "except"):
            found = any(re.search(self.pattern, r, re.IGNORECASE) for r in field.renderings)
            return found != (self.kind == "except")
        return False

    def column(self, e: Column | Keyed) -> Column:
        """Whether an element with its key is selected."""
        if self.kind == "all":
            return F.lit(True)
        if self.kind == "exact":
            # A known field is told by two numbers, at any depth; other texts are looked for among the renderings.
            if self.pair:
                return ((e["grp"] == self.pair[0]) & (e["elem"] == self.pair[1])) | (e["keyword"] == tags.by_any(self.text).keyword)
            return F.contains(e[KEY], F.lit(f"\n{self.text.lower()}\n"))
        if self.kind == "select":
            what, _, value = self.text.partition(":")
            if what.upper() == "VR":
                return e["vr"] == value[:2].upper()
            return e["grp"] == int(value, 16) if what.upper() == "GROUP" else F.lit(False)
        if self.kind in ("contains", "startswith", "endswith", "except"):
            found = e[KEY].rlike("(?im)" + self.pattern)
            found = ~found if self.kind == "except" else found
            # What the pattern says of the standard's fields is known before the run; only nested and other fields are searched.
            known = [t.pair[0] << 16 | t.pair[1] for t in tags.STANDARD.values()]
            hits = [t.pair[0] << 16 | t.pair[1] for t in tags.STANDARD.values() if self.picks(Field(t.keyword, t.tag, t.vr, t.name))]
            code = F.shiftleft(e["grp"].cast("long"), 16).bitwiseOR(e["elem"].cast("long"))
            return F.when((e["depth"] == 0) & code.isin(known), code.isin(hits) if hits else F.lit(False)).otherwise(found)
        return F.lit(False)


#: Element field with all renderings of its identity, one a line; selectors are one test of it.
KEY = "__key"


class Keyed:
    """An element that also has its key, made only where a selector gets to read it."""

    def __init__(self, element: Column):
        self.element = element

    def __getitem__(self, name: str) -> Column:
        return element_key(self.element) if name == KEY else self.element[name]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value found once: expressions inside lambdas are interpreted and share nothing."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def element_key(e: Column) -> Column:
    """All renderings of an element's identity in lower case, so that one test of a text does for all of them."""
    private = F.concat(F.lpad(F.hex(e["grp"]), 4, "0"), F.lit(',"'), e["private_creator"], F.lit('",'), F.lpad(F.hex(e["elem"].bitwiseAND(0xFF)), 2, "0"))
    private = F.when(e["is_private"] & e["private_creator"].isNotNull(), F.concat(private, F.lit("\n("), private, F.lit(")")))
    return F.concat(F.lit("\n"), F.lower(F.concat_ws("\n", e["keyword"], e["name"], e["tag"], e["stripped"], e["human"], private)), F.lit("\n"))


def selected(elements: Column, *selectors: Selector) -> Column:
    """The elements that one of the selectors picks."""
    return F.filter(elements, lambda e: any_of(selectors, Keyed(e)))


def any_of(selectors: Iterable[Selector], e: Column | Keyed) -> Column:
    """Whether one of them selects an element; known fields are one test of membership."""
    selectors = list(selectors)
    known = [s.pair for s in selectors if s.kind == "exact" and s.pair]
    out = F.lit(False)
    if len(known) > 2:
        out = F.shiftleft(e["grp"].cast("long"), 16).bitwiseOR(e["elem"].cast("long")).isin([g << 16 | n for g, n in known])
        out = out | F.coalesce(e["keyword"].isin([tags.by_any(s.text).keyword for s in selectors if s.kind == "exact" and s.pair]), F.lit(False))
    for s in selectors:
        if not (len(known) > 2 and s.kind == "exact" and s.pair):
            out = out | s.column(e)
    return out


def value_matches(value: Column, wanted: Column, literal: bool = True) -> Column:
    """Whether a value holds one of an array of texts, without case; no texts match nothing.

    literal: take the texts as they are; otherwise as regular expressions.
    """
    if literal:
        return F.exists(wanted, lambda w: (w != "") & F.contains(F.lower(value), F.lower(w)))
    return F.exists(wanted, lambda w: (w != "") & value.rlike(F.concat(F.lit("(?i)"), w)))
