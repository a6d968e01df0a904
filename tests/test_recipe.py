"""The recipe language."""

import pytest

from veilframe.operators.recipe import Action, Recipe, RecipeError
from veilframe.operators.selectors import Field, Selector

TEXT = """
# a comment
FORMAT dicom
%filter graylist
LABEL First # with a comment
contains Manufacturer foo
+ contains Model bar || contains Series flag me
coordinates 1,2,3,4
LABEL Second
  ctpkeepcoordinates 10,20,30,40
%values people
SPLIT OperatorsName by='#';minlength=4
FIELD PatientName
%fields dates
FIELD endswith:Date
%header
add A one two # said why
REMOVE B func:test
BLANK C
nonsense here
"""


def test_tree():
    r = Recipe.parse(TEXT)
    first, second = r.filters["graylist"]
    assert first.reason() == "and Manufacturer contains foo Model contains bar or Series contains flag me"
    assert (second.boxes[0].keep, second.boxes[0].where) == (1, "10,20,40,60")
    assert r.values["people"][0].by == "#" and r.values["people"][0].min_length == 4
    assert r.header == (Action("ADD", "A", "one two"), Action("REMOVE", "B", "func:test"), Action("BLANK", "C"))
    assert r.warnings == ("not understood: nonsense here",)
    assert r.actions("blank", "c") and r.names("filter") == ("graylist",)


def test_operator_splits_only_before_a_test():
    line = Recipe.parse("FORMAT dicom\n%filter f\nLABEL x\ncontains A b+c||d\n").filters["f"][0].lines[0]
    assert len(line.tests) == 1 and line.tests[0].value == "b+c||d"


def test_merge_appends_groups():
    merged = Recipe.parse(TEXT).merge(Recipe.parse(TEXT))
    assert len(merged.filters["graylist"]) == 4 and len(merged.header) == 6 and len(merged.values["people"]) == 4


@pytest.mark.parametrize("text", ["FORMAT nifti", "%filter\n", "%unknown x\n", "FORMAT dicom\n%header\nADD A\n", "%filter f\nLABEL x\ncontains A\n"])
def test_errors(text):
    with pytest.raises(RecipeError):
        Recipe.parse(text)


@pytest.mark.parametrize(
    "expression,hit",
    [("ALL", True), ("patientname", True), ("(0010,0010)", True), ("00100010", True), ("Patient's Name", True), ("contains:tientN", True), ("startswith:Name", False),
     ("endswith:Name", True), ("except:Patient", False), ("select:VR:PN", True), ("select:GROUP:0010", True), ("odd:thing", False)],
)
def test_selectors(expression, hit):
    assert Selector.parse(expression).picks(Field("PatientName", "00100010", "PN", "Patient's Name")) is hit
