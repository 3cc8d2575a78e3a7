"""Every operator on nulls, repeated rows, empty tables, and columns with all the names that operators use inside."""

import pytest

from glossa.llm import decontaminate, fim, licenses, linededup, maintext, mixing, phrases, pieces, pii, quality, secrets, simhash, warc

NAMES = "rid place words hashes ids first copies mark dup doc version no line later holes stays row print keys key head n x y a b u v w spans own term entity digest original bit label word token pos id".split()
CLEAN = "a b c d e f g\nshort"


@pytest.fixture(scope="module", params=[True, False], ids=["rows", "empty"])
def docs(request, spark):
    texts = [(1, CLEAN), (1, CLEAN), (None, None), (2, f"{CLEAN}\nx@y.zz secret is Kx9Lm2Pq8Rt5Vw3Z"), (None, "other text entirely here")]
    frame = spark.createDataFrame([(*t, *["z" if k % 2 else None] * len(NAMES)) for k, t in enumerate(texts)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in NAMES))
    return frame if request.param else frame.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id bigint, quality int")


@pytest.fixture(scope="module")
def benchmark_items(spark):
    return spark.createDataFrame([(1, "a b c d e f g"), (None, None)], "item_id bigint, text string")


@pytest.mark.parametrize(("apply", "left"), [(linededup.dedup_lines, 5), (simhash.one_of_each, 4)])
def test_filters_keep_all_columns(docs, apply, left):
    out = apply(docs)
    assert out.columns == docs.columns and out.count() == min(left, docs.count())


def test_filters_with_a_second_table_keep_all_columns(docs, labels, benchmark_items):
    clean = decontaminate.remove_contaminated(docs, benchmark_items)
    assert clean.columns == docs.columns and clean.count() == min(2, docs.count())
    good = quality.keep_good(docs, quality.fit(docs, labels))
    assert good.columns == docs.columns and good.count() == 0


@pytest.mark.parametrize("apply", [simhash.near_duplicates, licenses.scan_licenses, pii.find_personal_data, secrets.find_secrets])
def test_scans_give_a_row_for_each(docs, apply):
    assert apply(docs).count() == docs.count()


def test_the_others_give_a_row_for_each(docs, labels, benchmark_items):
    n = docs.count()
    assert decontaminate.find_contamination(docs, benchmark_items).count() == n
    assert quality.judge(docs, quality.fit(docs, labels)).count() == n
    assert pieces.encode(docs, pieces.Pieces.load()).count() == n
    for out in (fim.fill_in_middle(docs), mixing.mix(docs, source="key")):
        assert out.count() == n and out.columns[:-1] == docs.columns
    found = {tuple(r) for r in phrases.mine(docs, lang="id", least=2).select("lang", "phrase", "a").collect()}
    assert found == ({("z", "a b c d", 2), ("z", "b c d e", 2), ("z", "c d e f", 2), ("z", "d e f g", 2)} if n else set())
    pages = docs.withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", docs["key"])
    assert maintext.extract(pages, maintext.fit(pages)).count() == n
    assert warc.round_trip(pages).count() == n
