import random

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.functions import text


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("  hola  ", "hola"),
        ("  John   Smith  ", "John Smith"),
        ("john   smith", "john smith"),
        ("John Smith", "John Smith"),
        ("   ", ""),
        ("", ""),
        ("\tJohn  S\n", "John S"),
        (None, None),
    ],
)
def test_collapse_spaces(evaluate, raw, expected):
    assert evaluate([raw], text.strip_and_normalize_spaces) == [expected]


@pytest.mark.parametrize(
    ("raw", "mode", "expected"),
    [
        ("john smith", "title", "John Smith"),
        ("JOHN SMITH", "title", "John Smith"),
        ("joHN sMITH", "title", "John Smith"),
        ("men's wear", "title", "Men's Wear"),
        ("john", "upper", "JOHN"),
        ("JOHN", "lower", "john"),
        ("o'brian", "person", "O'Brian"),
        ("JEAN-CLAUDE", "person", "Jean-Claude"),
        ("mary-ann o'neill", "person", "Mary-Ann O'Neill"),
        ("As Is", "none", "As Is"),
    ],
)
def test_case(evaluate, raw, mode, expected):
    assert evaluate([raw], lambda c: text.normalize_case(c, mode)) == [expected]


def test_unknown_case_mode():
    with pytest.raises(ValueError, match="incorrecto"):
        text.normalize_case(F.lit("x"), "incorrecto")


@pytest.mark.parametrize(
    ("raw", "keep", "digits", "expected"),
    [
        ("Joh@n123", "", False, "John"),
        ("O'Brian!", "'", False, "O'Brian"),
        ("Jean-Claude!", "-", False, "Jean-Claude"),
        ("John Smith", "", False, "John Smith"),
        ("Food & Bev'er-ages (x) #1", "'-&", False, "Food & Bev'er-ages x "),
        ("Food & Bev'er-ages (x) #1", "'-&", True, "Food & Bev'er-ages x 1"),
        ("a*b+c(d)e,f.g/h&i", "'-&/().", False, "abc(d)ef.g/h&i"),
        ("a]b^c\\d", "]^\\", False, "a]b^c\\d"),
        ("José", "", False, "Jos"),
    ],
)
def test_strip_special(evaluate, raw, keep, digits, expected):
    assert evaluate([raw], lambda c: text.remove_special_chars(c, keep, digits)) == [expected]


def test_strip_special_unicode(evaluate):
    assert evaluate(["José Müller 7!"], lambda c: text.remove_special_chars(c, unicode=True)) == ["José Müller "]


def test_sentinel(evaluate):
    assert evaluate([None, "", "   ", "John"], text.normalize_to_null) == ["UNKNOWN"] * 3 + ["John"]
    assert evaluate([""], lambda c: text.normalize_to_null(c, "N/A")) == ["N/A"]


def test_strip_html(evaluate):
    assert evaluate(["<p>a</p><p>b</p>", "x < y", "a<br/>b"], text.strip_html_tags) == ["ab", "x < y", "ab"]


def test_clean_text_keeps_sentinel_spelling(evaluate):
    assert evaluate([None, "  jOHN  o'neil! "], text.clean_text) == ["UNKNOWN", "John O'neil"]
    titled = lambda c: text.clean_text(c, replacement="No title")
    assert evaluate([None, "#42"], titled) == ["No title", "No title"]


def test_clean_code(evaluate):
    values = [" zhy15 ", "txn-847388", "tx n # 1", "", None, " "]
    assert evaluate(values, text.clean_code) == ["ZHY15", "TXN-847388", "TXN1", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_match_key(evaluate):
    assert evaluate([" De "], text.match_key) == ["de"]
    assert evaluate([" De "], lambda c: text.match_key(c, "upper")) == ["DE"]


dirty = st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=20, max_size=40)


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=dirty)
def test_text_functions_are_idempotent_on_any_text(evaluate, values):
    for function in (text.strip_and_normalize_spaces, text.remove_special_chars, text.normalize_to_null, text.clean_code):
        once = evaluate(values, function)
        assert evaluate(once, function) == once
    assert None not in evaluate(values, text.clean_text)


def test_special_characters_are_those_of_the_expression(spark):
    draw = random.Random(3)
    signs = "aZ09 \t\n\x0b\x0c\r\x00\x1c'-.\\^]&é\x85\xa0ÿĀ中\U0001f600"
    texts = [None, "", *["".join(draw.choices(signs, k=draw.randint(0, 12))) for _ in range(500)], *map(chr, range(300))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for keep, digits in (("", False), ("'-", False), ("'-.\\^]&", True)):
        slow = F.regexp_replace("t", f"[^{text.kept_class(keep, digits)}]", "")
        assert df.where(~text.remove_special_chars(F.col("t"), keep, digits).eqNullSafe(slow)).collect() == []


def test_codes_keep_what_is_asked_for(spark):
    df = spark.createDataFrame([("a s-1 \\s^]",)], "t string")
    assert [df.select(text.clean_code(F.col("t"), keep)).first()[0] for keep in ("-", "s", "^]\\")] == ["AS-1S", "AS1S", "AS1\\S^]"]
