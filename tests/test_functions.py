import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimflow.functions import convert, intents, protect, text
from dimflow.operators import shape
from dimflow.operators.messages import outgoing


def column(spark, values, build, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, c {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("c"))).collect()]


def test_names(spark):
    found = column(spark, ["  o'neil mary-jane ", "JOHN  doe", None, "  ", "\tx y"], text.trim_initcap)
    assert found == ["O'neil Mary-jane", "John  Doe", None, "", "\tx Y"]


def test_lenient_integers(spark):
    values = ["7", " 42 ", "60000.7", "-3.99", "+5", "99999999999", "abc", "", "  ", "1e3", "1 2", ".5", "-.5", "5.", "+", "-",
              "2147483647", "2147483648", "-2147483648", "0.99999999999", "\t8\n", "1.2.3", "0x1", None, "--1", "٣"]
    expected = [7, 42, 60000, -3, 5, None, None, None, None, None, None, 0, 0, 5, None, None,
                2147483647, None, -2147483648, 0, 8, None, None, None, None, None]
    assert column(spark, values, convert.cast_int_lenient) == expected
    # only NULL takes the default
    assert column(spark, values, lambda c: convert.fill_null(c, 9)) == [9 if v is None else e
                                                                        for v, e in zip(values, expected)]


def test_booleans_dates_zones(spark):
    assert column(spark, ["YES", " y", "True", "t", "1", "No", "n ", "FALSE", "f", "0", "on", "", None],
                  convert.normalize_bool) == [True] * 5 + [False] * 5 + [None] * 3
    assert column(spark, ["2024-02-29", "2023-02-29", "x", None],
                  lambda c: convert.convert_date(c, "yyyy-MM-dd", "dd.MM.yyyy")) == ["29.02.2024", None, None, None]
    zoned = column(spark, ["2024-07-01 12:00:00", "2024-01-01 12:00:00"], lambda c: convert.convert_zone(
        c.cast("timestamp_ntz"), "Europe/Berlin", "America/New_York").cast("string"))
    assert zoned == ["2024-07-01 06:00:00", "2024-01-01 06:00:00"]


def test_padding_and_codes(spark):
    assert column(spark, ["12345", "1", None], lambda c: text.pad(c, 3, "0")) == ["123", "001", None]
    codes = {"NY": "New York"}
    assert column(spark, [" ny ", "la  x", None], lambda c: text.standardize(c, "upper", True, codes)) == [
        "New York", "LA X", None]
    assert column(spark, ["ny", "b", None], lambda c: text.standardize(c, "upper", True, codes, "?")) == ["New York", "?", None]


def test_hashes(spark):
    assert column(spark, ["0", None], lambda c: protect.hash_column(c.cast("int"))) == [
        "5feceb66ffc86f38d952786c6d696c79c2dbc239dd4e91b46729d73a27fb57e9", None]
    df = spark.createDataFrame([(None, "A"), ("A", None)], "a STRING, b STRING")
    assert df.select(protect.row_hash(["a", "b"])).distinct().count() == 1
    opened = column(spark, ["secret", None, ""], lambda c: protect.decrypt(protect.encrypt(c, F.lit("k" * 16)), F.lit("k" * 16)))
    assert opened == ["secret", None, ""]


def test_addresses(spark):
    values = ["+1", "whatsapp:+1", "whatsapp:whatsapp:+1", None]
    assert column(spark, values, text.normalize_address) == ["whatsapp:+1", "whatsapp:+1", "whatsapp:whatsapp:+1", None]
    assert column(spark, values, text.strip_address) == ["+1", "+1", "+1", None]
    assert column(spark, ["  Hi  \n", "\x0bA\x0c", None], text.normalize_text) == ["hi", "a", None]


REPLIES = {
    '{"intent":"grades"}': "grades", '{ "intent": "fee" }': "fee", '{"intent":"zzz"}': "unknown", '{"x":1}': "unknown",
    "nope": "unknown", '{"intent":5}': "unknown", "[1]": "unknown", '{"intent":"grades"} extra': "unknown",
    "{'intent':'grades'}": "unknown", '{"intent":"fee","intent":"grades"}': "grades", "": "unknown", None: "unknown",
    '{"intent":"grades","intent":"zzz"}': "unknown", '[{"intent":"grades"}]': "unknown", '"grades"': "unknown",
    '{"intent":"grades"}{"intent":"fee"}': "unknown", '{"intent":"grades"},{"intent":"fee"}': "unknown",
    '{"intent":"grades"}] x': "unknown", '{"intent":"grades"}} x': "unknown", '\n{"intent":\t"summary"}\n': "summary",
    '{"intent":null}': "unknown", '{"intent":["grades"]}': "unknown", '{"intent":{"intent":"grades"}}': "unknown",
    '{"more":{"a":[1,{"b":"}"}]},"intent":"greeting"}': "greeting", '{"Intent":"grades"}': "unknown",
    '{"intent":"Grades"}': "unknown", '{"intent":" grades"}': "unknown", "null": "unknown", '{"intent":"grades"': "unknown",
    '{"intent":"grades"},"r":{"intent":"fee"}': "unknown", '{"intent":"grades"},': "unknown", '1': "unknown",
    '{"intent":"attendance"}]': "unknown", '{"intent":"grades",}': "unknown", 'x{"intent":"grades"}': "unknown",
}


def test_replies(spark):
    assert dict(zip(REPLIES, column(spark, list(REPLIES), intents.parse_intent))) == REPLIES


def test_prompts(spark):
    template = 'A {x} and {y}: {{"k": "{x}"}}'
    df = spark.createDataFrame([(1, "b"), (None, "c{x}")], "x INT, y STRING")
    found = [r[0] for r in df.select(text.render_prompt(template, x=F.col("x"), y=F.col("y"))).collect()]
    assert found == [template.format(x=1, y="b"), template.format(x=None, y="c{x}")]
    with pytest.raises(KeyError):
        text.render_prompt("{z}", x=F.col("x"))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0")), min_size=1, max_size=8), st.integers(1, 7))
def test_split_text(spark, values, limit):
    pieces = column(spark, values, lambda c: text.split_text(c, limit))
    for value, found in zip(values, pieces):
        assert (found or []) == [value[i:i + limit] for i in range(0, len(value), limit)]


def test_outgoing(spark):
    df = spark.createDataFrame([("+1", "abcde"), ("whatsapp:+2", ""), ("+3", None)], "to STRING, body STRING")
    found = sorted(map(tuple, outgoing(df, "to", "body", 2).collect()))
    assert found == [("whatsapp:+1", 1, "ab"), ("whatsapp:+1", 2, "cd"), ("whatsapp:+1", 3, "e")]


def test_defaults(spark):
    assert column(spark, ["", None, "x"], lambda c: text.with_default(c, "d")) == ["d", "d", "x"]


def test_shape(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    assert shape.rename(df, {"a": "x"}).columns == ["x", "b", "c"]
    assert shape.reorder(df, ["c"]).columns == ["c", "a", "b"]
    assert shape.drop_columns(shape.add_columns(df, {"d": F.lit(1)}), ["a"]).columns == ["b", "c", "d"]
    for call in (lambda: shape.rename(df, {"z": "x"}), lambda: shape.reorder(df, ["z"]), lambda: shape.drop_columns(df, ["z"])):
        with pytest.raises(ValueError):
            call()
