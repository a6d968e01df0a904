"""The recipe language: text to an immutable tree.

A recipe has sections (`%header`, `%filter name`, `%values name`, `%fields name`,
`%labels`). Header lines are ordered actions; filter sections hold labels, each a
conjunction of criteria lines with boxes to mask or keep. Keywords are read without
case. Lines that fit nowhere are kept as warnings.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

#: The words of the language.
SECTIONS = ("header", "labels", "filter", "values", "fields")
NAMED = ("filter", "values", "fields")
ACTIONS = ("ADD", "BLANK", "JITTER", "KEEP", "REPLACE", "REMOVE", "LABEL")
WITH_VALUE = ("ADD", "REPLACE", "JITTER")
TESTS_WITH_VALUE = ("contains", "notcontains", "equals", "notequals")
TESTS = ("contains", "notcontains", "equals", "notequals", "missing", "present", "empty")
BOX_WORDS = ("ctpcoordinates", "ctpkeepcoordinates", "coordinates", "keepcoordinates")


class RecipeError(ValueError):
    """A recipe that cannot be read."""


@dataclass(frozen=True)
class Action:
    kind: str
    field: str
    value: str | None = None


@dataclass(frozen=True)
class Test:
    name: str
    field: str
    value: str | None = None

    def __str__(self) -> str:
        return f"{self.field} {self.name} {self.value or ''}"


@dataclass(frozen=True)
class Line:
    """Tests joined left to right by `and` / `or`; prefix: the operator written before the line."""

    tests: tuple[Test, ...]
    joins: tuple[str, ...] = ()
    prefix: str | None = None


@dataclass(frozen=True)
class Box:
    """keep: 1 to keep, 0 to mask. where: `x0,y0,x1,y1`, `all`, or `from:Field`."""

    keep: int
    where: str


@dataclass(frozen=True)
class Label:
    name: str
    lines: tuple[Line, ...] = ()
    boxes: tuple[Box, ...] = ()

    def reason(self) -> str:
        """What a match is reported with: its tests, after the last line's operator."""
        if not self.lines:
            return self.name if self.boxes else ""
        words = []
        for line in self.lines:
            for i, test in enumerate(line.tests):
                words.append(str(test) + (f" {line.joins[i]}" if i < len(line.joins) else ""))
        text = " ".join(words)
        return f"{self.lines[-1].prefix} {text}" if self.lines[-1].prefix else text


@dataclass(frozen=True)
class Rule:
    """A line of a values or fields group."""

    kind: str
    field: str
    by: str | None = None
    min_length: int = 1


@dataclass(frozen=True)
class Recipe:
    format: str | None = None
    header: tuple[Action, ...] = ()
    labels: tuple[Action, ...] = ()
    filters: dict[str, tuple[Label, ...]] = field(default_factory=dict)
    values: dict[str, tuple[Rule, ...]] = field(default_factory=dict)
    fields: dict[str, tuple[Rule, ...]] = field(default_factory=dict)
    warnings: tuple[str, ...] = ()

    @staticmethod
    def parse(text: str) -> Recipe:
        return _Reader().read(text)

    @staticmethod
    def load(path: str) -> Recipe:
        with open(path, encoding="utf-8") as f:
            return Recipe.parse(f.read())

    @staticmethod
    def from_actions(actions: Iterable[dict | Action]) -> Recipe:
        made = [a if isinstance(a, Action) else Action(a["action"].upper(), a["field"], a.get("value")) for a in actions]
        return Recipe(format="dicom", header=tuple(made))

    def merge(self, other: Recipe) -> Recipe:
        """This recipe followed by another: same-named groups are appended to."""
        if self.format and other.format and self.format != other.format:
            raise RecipeError(f"formats differ: {self.format} and {other.format}")
        both = lambda a, b: {k: (*a.get(k, ()), *b.get(k, ())) for k in (*a, *b)}
        return Recipe(
            self.format or other.format,
            self.header + other.header,
            self.labels + other.labels,
            both(self.filters, other.filters),
            both(self.values, other.values),
            both(self.fields, other.fields),
            self.warnings + other.warnings,
        )

    def actions(self, kind: str | None = None, name: str | None = None) -> tuple[Action, ...]:
        """Header actions of a kind, of a field; neither minds case."""
        fits = lambda a: (kind is None or a.kind == kind.upper()) and (name is None or a.field.lower() == name.lower())
        return tuple(a for a in self.header if fits(a))

    def names(self, section: str) -> tuple[str, ...]:
        return tuple(getattr(self, {"filter": "filters"}.get(section, section)))

    def with_actions(self, *actions: Action) -> Recipe:
        return replace(self, header=self.header + actions)


def words(line: str) -> list[str]:
    """Parts between white space outside double quotes."""
    return re.findall(r'(?:[^\s"]|"[^"]*")+', line)


class _Reader:
    """One pass over the lines, with the open section and label."""

    def __init__(self):
        self.format: str | None = None
        self.section: str | None = None
        self.name: str | None = None
        self.header: list[Action] = []
        self.labels: list[Action] = []
        self.groups: dict[str, dict[str, list]] = {s: {} for s in NAMED}
        self.label: tuple[str, list[Line], list[Box]] | None = None
        self.warnings: list[str] = []

    def read(self, text: str) -> Recipe:
        for raw in text.splitlines():
            line = raw.strip()
            if line and not line.startswith("#"):
                self.line(line)
        self.close()
        done = {s: {k: tuple(v) for k, v in g.items()} for s, g in self.groups.items()}
        return Recipe(self.format, tuple(self.header), tuple(self.labels), done["filter"], done["values"], done["fields"], tuple(self.warnings))

    def close(self) -> None:
        if self.label:
            name, lines, boxes = self.label
            self.groups["filter"][self.name].append(Label(name, tuple(lines), tuple(boxes)))
            self.label = None

    def line(self, line: str) -> None:
        first = line.split(None, 1)[0]
        if line.startswith("%"):
            self.close()
            self.open(line)
        elif first.lower() == "format":
            self.format = line.split(None, 1)[1].strip().lower() if " " in line else ""
            if self.format != "dicom":
                raise RecipeError(f"format {self.format!r} is not known")
        elif self.section == "filter" and first.upper() == "LABEL":
            self.close()
            self.label = (line[5:].split("#")[0].strip(), [], [])
        elif self.label:
            self.criterion(line)
        elif self.section in ("values", "fields"):
            self.rule(line)
        elif first.upper() in ACTIONS and self.section in ("header", "labels"):
            self.action(line, first.upper())
        else:
            self.warnings.append(f"not understood: {line}")

    def open(self, line: str) -> None:
        parts = line.split("#")[0].strip()[1:].split(None, 1)
        section = parts[0].lower() if parts else ""
        if section not in SECTIONS:
            raise RecipeError(f"%{section} is not a section")
        name = parts[1].strip() if len(parts) > 1 else None
        if section in NAMED:
            if not name:
                raise RecipeError(f"%{section} needs a name")
            self.groups[section].setdefault(name, [])
        self.section, self.name = section, name

    def action(self, line: str, kind: str) -> None:
        parts = words(line)
        if len(parts) < 2:
            raise RecipeError(f"{kind} needs a field: {line}")
        rest = []
        for p in parts[2:]:
            if p.startswith("#"):
                break
            rest.append(p)
        if kind in WITH_VALUE and not rest:
            raise RecipeError(f"{kind} needs a value: {line}")
        value = " ".join(rest) or None
        if kind in ("BLANK", "KEEP", "LABEL"):
            value = None
        (self.header if self.section == "header" else self.labels).append(Action(kind, parts[1], value))

    def rule(self, line: str) -> None:
        parts = words(re.sub(r"""\s#[^'"]*$""", "", line))
        kind = parts[0].upper()
        if kind not in (("FIELD", "SPLIT") if self.section == "values" else ("FIELD",)) or len(parts) < 2:
            self.warnings.append(f"not understood: {line}")
            return
        options = dict(p.split("=", 1) for p in " ".join(parts[2:]).strip('"').split(";") if "=" in p)
        by = options.get("by", " ").strip("\"'") or " "
        self.groups[self.section][self.name].append(Rule(kind, parts[1], by if kind == "SPLIT" else None, int(options.get("minlength", 1))))

    def criterion(self, line: str) -> None:
        _, lines, boxes = self.label
        word = next((w for w in BOX_WORDS if line.lower().startswith(w)), None)
        if word:
            where = line[len(word) :].split("#")[0].strip()
            if word.startswith("ctp"):
                x, y, w, h = (int(v) for v in where.split(","))
                where = f"{x},{y},{x + w},{y + h}"
            boxes.append(Box(int("keep" in word), where))
            return
        prefix = None
        for mark, name in (("+", "and"), ("||", "or")):
            if line.startswith(mark):
                prefix, line = name, line[len(mark) :].strip()
        if line.startswith("#"):
            return
        if not line.lower().startswith(TESTS):
            self.warnings.append(f"not understood: {line}")
            return
        # An operator parts two tests only where a test follows it.
        tests, joins = [], []
        parts = re.split(r"(\|\||\+)", line)
        text = parts[0]
        for mark, rest in zip(parts[1::2], parts[2::2], strict=True):
            if rest.strip().lower().startswith(TESTS):
                tests.append(self.test(text))
                joins.append("or" if mark == "||" else "and")
                text = rest
            else:
                text += mark + rest
        tests.append(self.test(text))
        lines.append(Line(tuple(tests), tuple(joins), prefix))

    def test(self, text: str) -> Test:
        parts = text.strip().split(None, 2)
        name = parts[0].lower()
        if name not in TESTS:
            raise RecipeError(f"{name} is not a test")
        if len(parts) < (3 if name in TESTS_WITH_VALUE else 2):
            raise RecipeError(f"{name} needs {'a field and a value' if name in TESTS_WITH_VALUE else 'a field'}: {text}")
        if name in TESTS_WITH_VALUE:
            return Test(name, parts[1], parts[2].strip())
        return Test(name, parts[1])
