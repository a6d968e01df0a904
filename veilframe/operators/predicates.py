"""Record predicates, labels and verdicts as boolean columns.

Three states are told apart: missing (NULL), empty ('' or 0) and present. A predicate
never gives NULL, so that its negation is right for missing fields. Booleans are
folded strictly from left to right, without precedence.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .recipe import Label, Line, Recipe, Test

Resolve = Callable[[str], Column | None]


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def contains(value: Column, pattern: str) -> Column:
    """Regex search without case in the trimmed value."""
    return _sure(F.trim(value).rlike("(?i)" + pattern.strip()))


def equals(value: Column, text: str) -> Column:
    return _sure(F.lower(F.trim(value)) == text.strip().lower())


def matches(value: Column, pattern: str) -> Column:
    """Anchored at the start."""
    return _sure(F.trim(value).rlike("(?i)^(?:" + pattern.strip() + ")"))


def starts_with(value: Column, text: str) -> Column:
    return _sure(F.lower(F.trim(value)).startswith(text.strip().lower()))


def ends_with(value: Column, text: str) -> Column:
    return _sure(F.lower(F.trim(value)).endswith(text.strip().lower()))


def empty(value: Column) -> Column:
    """'' in a text; 0 in a number; no entries in an array."""
    text = value.cast("string")
    return _sure(F.when(F.typeof(value) == "string", text == "").otherwise(text.isin("", "0", "0.0", "[]")))


def test_column(test: Test, resolve: Resolve) -> Column:
    """A test as a column; a field that the record type lacks is missing."""
    value = resolve(test.field)
    value = F.lit(None).cast("string") if value is None else value
    kinds: dict[str, Callable[[], Column]] = {
        "contains": lambda: contains(value, test.value),
        "notcontains": lambda: ~contains(value, test.value),
        "equals": lambda: equals(value, test.value),
        "notequals": lambda: ~equals(value, test.value),
        "missing": lambda: value.isNull(),
        "present": lambda: value.isNotNull(),
        "empty": lambda: empty(value),
        "matches": lambda: matches(value, test.value),
        "startswith": lambda: starts_with(value, test.value),
        "endswith": lambda: ends_with(value, test.value),
    }
    return kinds[test.name]() if test.name in kinds else F.lit(False)


def fold(first: Column, rest: list[tuple[str, Column]]) -> Column:
    """Left to right, no precedence."""
    return reduce(lambda acc, t: (acc | t[1]) if t[0] == "or" else (acc & t[1]), rest, first)


def line_column(line: Line, resolve: Resolve) -> Column:
    tests = [test_column(t, resolve) for t in line.tests]
    return fold(tests[0], list(zip(line.joins, tests[1:], strict=True)))


def label_column(label: Label, resolve: Resolve, line_or: bool = False) -> Column:
    """All lines hold; boxes alone always match, nothing at all never does.

    line_or: let a line with the prefix `||` widen the verdict instead of narrowing it.
    """
    if not label.lines:
        return F.lit(bool(label.boxes))
    lines = [(line.prefix if line_or and line.prefix else "and", line_column(line, resolve)) for line in label.lines]
    return fold(lines[0][1], lines[1:])


def findings(recipe: Recipe, resolve: Resolve, boxes: Callable[[Label], Column] | None = None, line_or: bool = False) -> Column:
    """array<struct(grp, label, reason[, boxes])> of the labels that match, in recipe order."""
    each = []
    for group, labels in recipe.filters.items():
        for label in labels:
            parts = [label_column(label, resolve, line_or).alias("hit"), F.lit(group).alias("grp"), F.lit(label.name).alias("label"), F.lit(label.reason()).alias("reason")]
            each.append(F.struct(*parts, *([boxes(label).alias("boxes")] if boxes else [])))
    if not each:
        return F.array().cast("array<struct<grp:string,label:string,reason:string>>")
    names = ["grp", "label", "reason", *(["boxes"] if boxes else [])]
    return F.transform(F.filter(F.array(*each), lambda x: x["hit"]), lambda x: F.struct(*[x[n].alias(n) for n in names]))
