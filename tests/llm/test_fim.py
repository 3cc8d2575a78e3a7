"""Fill-in-middle: unit grammars against plain patterns, forms against a plain version, exact round trips."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from glossa.llm import fim

TEXTS = [
    "",
    None,
    "abc",
    "a1b \n é日本\U0001f600\U0001f600x",
    "Hi\U0001f600\U0001f601 you\r\n\n",
    "x" * 3000 + " y" * 60_000,
    " a",
    "..",
    "z\n",
    "holds <P> itself",
    "<S",
    "ends with <M",
    "<M>",
    "one two  three\n\nfour",
    "\x00nul\x00",
    "é combining",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k % 5 or None, t, "p", "b") for k, t in enumerate(TEXTS * 12)] + [(k, "def f(x):\n    return x + 1\n", "p", "b") for k in range(100, 160)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, pieces string, body string").repartition(3)


def whole(doc_id, text):
    """(n, form, prefix, middle, output) by the contract's words."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_equals_a_plain_version_and_restores_every_text(docs):
    out = fim.fill_in_middle(docs)
    assert out.columns == [*docs.columns, "fim"]
    rows = out.select("doc_id", "text", "fim", fim.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(rows) == docs.count() and {r.fim.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert tuple(r.fim) == whole(r.doc_id, r.text) and r.back == (r.text or "")


@pytest.mark.parametrize(
    ("grammar", "pattern"),
    [
        (fim.CODE, r"[A-Za-z]+|[^A-Za-z]"),
        (fim.CHARACTERS, r"(?s)."),
        (fim.WORDS, r"[\x20\x09-\x0d]+|[^\x20\x09-\x0d]+"),
        (fim.LINES, r"[^\n]*\n|[^\n]+"),
        ((("0-9", "run"), ("a-z", "run"), ("^0-9a-z", "single")), r"[0-9]+|[a-z]+|[^0-9a-z]"),
    ],
)
def test_units_of_each_grammar(docs, grammar, pattern):
    for r in docs.select("text", fim.units(F.col("text"), grammar).alias("u")).distinct().collect():
        assert r.u == (None if r.text is None else re.findall(pattern, r.text))


def test_other_grammars_restore_as_well(docs):
    for grammar in (fim.CHARACTERS, fim.WORDS, fim.LINES):
        out = fim.fill_in_middle(docs, grammar=grammar, plain=0, suffix_first=50)
        assert out.filter(fim.restored(F.col("fim.output"), F.col("fim.form")) != F.coalesce("text", F.lit(""))).count() == 0


def test_a_column_of_the_results_name_gives_way(docs):
    out = fim.fill_in_middle(docs.withColumn("FIM", F.lit(1)).withColumn("output", F.lit("o")))
    assert out.columns == [*docs.columns, "output", "fim"] and out.count() == docs.count()


def test_an_empty_table(docs):
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
