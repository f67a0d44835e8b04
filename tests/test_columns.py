import pytest
from pyspark.sql import types as T

from ordermill.sinks.columns import TypeClash, common, match_columns, widens

pytestmark = pytest.mark.usefixtures("spark")  # types are read by the session


def kind(text):
    return T.NullType() if text == "void" else T.DataType.fromDDL(text)


WIDER = [
    ("tinyint", "bigint"), ("int", "bigint"), ("int", "double"), ("smallint", "float"), ("float", "double"),
    ("int", "decimal(10,0)"), ("bigint", "decimal(21,2)"), ("decimal(5,2)", "decimal(7,3)"), ("date", "timestamp_ntz"),
    ("void", "string"), ("array<int>", "array<bigint>"), ("map<string,int>", "map<string,double>"),
    ("struct<a:int,b:date>", "struct<a:bigint,b:date>"), ("string", "string"),
]
CLASHES = [
    ("bigint", "double"), ("string", "int"), ("date", "timestamp"), ("decimal(38,0)", "decimal(38,10)"), ("double", "decimal(18,2)"),
    ("struct<a:int>", "struct<b:int>"), ("array<string>", "array<int>"), ("int", "array<int>"), ("boolean", "int"),
]


@pytest.mark.parametrize("narrow,wide", WIDER)
def test_widening(narrow, wide):
    assert widens(kind(narrow), kind(wide)) and common(kind(narrow), kind(wide)) == kind(wide)
    assert narrow == wide or not widens(kind(wide), kind(narrow))
    assert common(kind(wide), kind(narrow)) == kind(wide)


@pytest.mark.parametrize("left,right", CLASHES)
def test_clashes(left, right):
    for a, b in ((left, right), (right, left)):
        assert not widens(kind(a), kind(b)) and common(kind(a), kind(b)) is None


@pytest.mark.parametrize(
    "left,right,least",
    [
        ("int", "float", "double"),
        ("bigint", "decimal(5,2)", "decimal(21,2)"),
        ("decimal(10,4)", "decimal(12,1)", "decimal(15,4)"),
        ("array<int>", "array<float>", "array<double>"),
        ("struct<a:int,b:tinyint>", "struct<a:float,b:int>", "struct<a:double,b:int>"),
    ],
)
def test_least_common_type(left, right, least):
    assert common(kind(left), kind(right)) == common(kind(right), kind(left)) == kind(least)


def schema(text):
    return T.StructType.fromDDL(text)


def test_all_problems_are_named_at_once():
    with pytest.raises(TypeClash) as raised:
        match_columns(schema("a string, b double, d int"), schema("a int, b int, c date"), "db.t", widen=False)
    for part in ("db.t", "a is int and would get string", "b is int and would get double; widen=True makes it double", "c (date) is absent", "d (int) is new"):
        assert part in str(raised.value)


def test_match_says_what_the_table_needs():
    match = match_columns(schema("a int, b double, d int"), schema("a bigint, b int"), "t", add_columns=True, widen=True)
    assert [f.name for f in match.new] == ["d"] and match.wider == {"b": T.DoubleType()}
