"""JSON5 and wiki markup: what is allowed, what is an error, and depth."""

import json
import time

import pytest
from pyspark.sql import functions as F

from glossa.functions import json5, wiki

GOOD = [
    ("{a: 0x1F, b: -0x10, c: .5, d: 5., e: +1e3, f: -.5E-2}", {"a": 31, "b": -16, "c": 0.5, "d": 5.0, "e": 1000.0, "f": -0.005}),
    ("[Infinity, -Infinity, NaN]", ["Infinity", "-Infinity", "NaN"]),
    ("/* a */ {'single': 'it\\'s', \"double\": \"a 'b'\", // c\n $n_1: [], unié: {},}", {"single": "it's", "double": "a 'b'", "$n_1": [], "unié": {}}),
    ("'a\\\nb\\\r\nc\\x41\\u00e9\\v\\0\\q'", "abcAé\v\0q"),
    ("'\\uD83D\\uDE00\\uD800'", "\U0001f600�"),
    ("{a: 1, 'a': 2, b: [1, [2, [3,],],], a: 3}", {"b": [1, [2, [3]]], "a": 3}),
    ("﻿  null ", None),
    ("{true: false, null: true, \\u0061b: 1}", {"true": False, "null": True, "ab": 1}),
]
BAD = ["", "{", "[1,,2]", "{,}", "[,]", "{a}", "{a:}", "{a:1 b:2}", "01", "1 2", "'a\nb'", "'open", "{a:1}}", "[1}", "undefined", "1_0", "0x", "+", "'\\u12'", "'\\1'", "/* open", "{1: 2}", "[" * 600 + "]" * 600]


@pytest.mark.parametrize(("text", "value"), GOOD)
def test_json5(text, value):
    assert json.loads(json5.to_json(text)) == value


@pytest.mark.parametrize("text", BAD)
def test_what_is_not_json5(text):
    with pytest.raises(ValueError):
        json5.to_json(text)


def test_json_is_json5():
    value = {"a": [1, -2.5, 1e-7, True, None, "  \" \\ / \b", {"": []}], "é\U0001f600": {}}
    assert json.loads(json5.to_json(json.dumps(value))) == json.loads(json5.to_json(json.dumps(value, ensure_ascii=False, indent=1))) == value


def test_errors_are_raised_or_null(spark):
    frame = spark.createDataFrame([("{a: 1,}",), ("{a",), (None,)], "t string")
    assert [r[0] for r in frame.select(json5.lenient(F.col("t"))).collect()] == ['{"a":1}', None, None]
    assert [r[0] for r in frame.filter("t IS NULL OR t LIKE '%}'").select(F.variant_get(json5.variant(F.col("t")), "$.a", "int")).collect()] == [1, None]
    with pytest.raises(Exception, match="the text ends early"):
        frame.select(json5.strict(F.col("t"))).collect()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("a {{b {{c {{d}} e}} f}} g", "a  g"),
        ("{| x {| y |} z |}t", "t"),
        ("[[a]] [[b|c]] [[d|e|f]] [[g|[[h|i]] j]]", "a c f i j"),
        ("[[File:x|[[a|b]] c]]d[[category: e]] [[:Image:y]]", "d "),
        ("[http://x.y/z a b] [http://x.y] [no]", "a b  [no]"),
        ("<ref>x {{</ref>a<ref name=b/>c<b>d</b><!-- }} --> '''e''' ==f==", "acd e f"),
        ("open {{ a | b [[ c | d", "open {{ a | b [[ c | d"),
        ("}} close ]] |} a ] b | c", "}} close ]] |} a ] b | c"),
        ("{{a [[b}} c]]", " c]]"),
        ("<!-- never closed", ""),
        ("a < b > c & 1 < 2", "a < b > c & 1 < 2"),
        ("", ""),
    ],
)
def test_wiki_markup(page, text):
    assert wiki.without_markup(page) == text


def test_depth_and_length_cost_time_in_proportion():
    began = time.time()
    for opening, closing in (("{{a|", "}}"), ("[[a|", "]]"), ("{|", "|}"), ("[[a|", ""), ("{{", "")):
        wiki.without_markup(opening * 100_000 + "x" + closing * 100_000)
    assert time.time() - began < 10


def test_wiki_tokens(spark):
    rows = spark.createDataFrame([("{{a}}One two threee É",), (None,)], "p string")
    assert [r[0] for r in rows.select(wiki.tokens(F.col("p"), 3, 5)).collect()] == [["one", "two"], None]
