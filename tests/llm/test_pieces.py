"""Piece search against enumeration of all segmentations; exact round trips."""

import random

import pytest

from glossa.llm import pieces as pc
from glossa.llm.queries import op4_sentencepiece


@pytest.fixture(scope="module")
def model():
    return pc.Pieces.load()


def every(model, unit):
    out = []

    def go(at, score, ids):
        if at == len(unit):
            out.append((score, ids))
            return
        single = False
        for end in range(at + 1, len(unit) + 1):
            if unit[at:end] in model.piece:
                k, s = model.piece[unit[at:end]]
                single |= end == at + 1
                go(end, score + s, [*ids, k])
        if not single:
            char = pc.SPACE if unit[at] == pc.LITERAL else unit[at]
            go(at + 1, score + model.unknown, ids + [model.bytes[b] for b in char.encode()])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["hello", "ab", "  x ", "é日", "a▁b", "the cat", "Zürich\n", "a  b", "x²."])
def test_n_best_equals_enumeration(model, text):
    marked = pc.SPACE + text.replace(pc.SPACE, pc.LITERAL).replace(" ", pc.SPACE)
    want = [s for s, _ in every(model, marked)][:5]
    got = model.n_best(text, 5)
    assert [s for s, _ in got] == pytest.approx(want)
    assert all(model.decode(ids) == text for _, ids in got)
    for n in (1, 2, 5):
        ids, score, _, scores = model.encode(text, n)
        assert score == pytest.approx(want[0]) and scores == pytest.approx(want[:n]) and model.decode(ids.tolist()) == text


def test_units_fall_apart_exactly(model):
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ab.,² \n▁é日!_-x9’…") for _ in range(9))
        marked = pc.SPACE + text.replace(pc.SPACE, pc.LITERAL).replace(" ", pc.SPACE)
        assert "".join(model.units(text)) == marked
        assert model.encode(text)[1] == pytest.approx(model.search(marked, 1)[0][0])


def test_frames(spark, model, weird):
    got = pc.encode(weird, model)
    back = pc.decode(got, model)
    assert sorted(str((r.doc_id, r.text)) for r in back.collect()) == sorted(str((r.doc_id, r.text)) for r in weird.collect())
    assert sorted(str(r.round_trip) for r in got.collect()) == ["None"] + ["True"] * 8
    assert pc.encode(weird.limit(0), model).count() == 0


def test_query(spark, sf_dir):
    got = op4_sentencepiece(spark, sf_dir).collect()
    assert len(got) == 200 and all(r.round_trip and (r.margin is None or r.margin >= 0) for r in got)


def k_best(model, text, k):
    """Scores of the k best segmentations of a whole text, by a plain list of k sums for each place."""
    from heapq import nlargest

    line = pc.SPACE + text.replace(pc.SPACE, "\ud800").replace(" ", pc.SPACE)
    best = [[] for _ in range(len(line) + 1)]
    best[0] = [0.0]
    for end in range(1, len(line) + 1):
        sums = []
        for start in range(max(0, end - model.widest), end):
            found = model.piece.get(line[start:end])
            if found is not None:
                sums += [s + found[1] for s in best[start]]
            elif end == start + 1:
                sums += [s + model.unknown for s in best[start]]
        best[end] = nlargest(k, sums)
    return best[-1]


def test_query_equals_a_plain_search_of_whole_texts(spark, sf_dir):
    """Score and margin of each document by brute force over the whole text, and its ids read back by the library."""
    import hashlib

    import numpy as np
    from sentencepiece import SentencePieceProcessor

    model, library = pc.Pieces.load(), SentencePieceProcessor(model_file=pc.MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 1500").collect()}
    got = {r.doc_id: r for r in op4_sentencepiece(spark, sf_dir).collect()}
    for d, text in list(texts.items())[:60]:
        top, second = k_best(model, text, 2)
        ids = model.encode(text)[0]
        assert (got[d].score, got[d].margin) == (pytest.approx(top, abs=2e-6), pytest.approx(top - second, abs=2e-6))
        assert got[d].ids_sha256 == hashlib.sha256(np.asarray(ids, dtype="<i4").tobytes()).hexdigest() and got[d].n_pieces == len(ids)
        assert library.decode(ids.tolist()) == text.strip(" ") or library.decode(ids.tolist()) == text


def test_best_segmentation_equals_another_librarys(spark, sf_dir):
    """The same pieces and scores in an independent unigram search give the same sums for every word of the table."""
    from tokenizers import models

    model = pc.Pieces.load()
    vocabulary = [(t, s) for t, (_, s) in model.piece.items()]
    other = models.Unigram([("<unk>", -1e4), *vocabulary], unk_id=0, byte_fallback=False)
    score = dict(vocabulary)
    units = {u for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() for u in model.units(r.text or "") if all(c in score for c in u)}
    assert len(units) > 5000
    for u in units:
        assert sum(score[t.value] for t in other.tokenize(u)) == pytest.approx(model.search(u, 1)[0][0], abs=1e-6)


@pytest.mark.parametrize("text", ["hello", "ab", "é日", "a▁b", "the cat", "Zürich, a_.", "a  b", "no, no", ""])
def test_all_n_segmentations_are_spelt(model, text):
    """Not only their scores: each is one of the enumerated ones, with its own score, and none comes twice."""
    marked = pc.SPACE + text.replace(pc.SPACE, pc.LITERAL).replace(" ", pc.SPACE)
    want = {tuple(ids): s for s, ids in every(model, marked)} if text else {(): 0.0}
    for n in (1, 2, 5):
        for _ in range(2):  # units just searched, then remembered ones
            found, _ = model.best(text, n)
            got = [tuple(ids.tolist()) for _, ids in found]
            assert len(set(got)) == len(got) == min(n, len(want))
            scores = [s for s, _ in found]
            assert scores == pytest.approx([want[ids] for ids in got]) and scores == pytest.approx(sorted(want.values(), reverse=True)[:n])


def test_frames_have_all_segmentations(spark, model, weird):
    import hashlib

    import numpy as np

    digest = lambda ids: hashlib.sha256(np.asarray(ids, dtype="<i4").tobytes()).hexdigest()
    rows = pc.encode(weird, model, n_best=3).collect()
    texts = {r.doc_id: r.text for r in weird.collect()}
    for r in rows:
        if r.round_trip is None:
            assert (r.ids, r.others, r.others_sha256) == (None, None, [])
        else:
            assert len(r.others) == len(r.scores) - 1 and all(model.decode(x) == texts[r.doc_id] for x in r.others)
            assert r.others_sha256 == [digest(x) for x in r.others] and len({tuple(x) for x in [r.ids, *r.others]}) == len(r.scores)
    assert max(len(r.scores) for r in rows) == 3
    plain = pc.encode(weird, model, with_ids=False).columns
    assert "others" not in plain and "others_sha256" in plain


def test_query_has_the_second_segmentation(spark, sf_dir):
    import hashlib

    model = pc.Pieces.load()
    got = {r.doc_id: r.second_sha256 for r in op4_sentencepiece(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        found, _ = model.best(r.text or "", 2)
        assert got[r.doc_id] == (hashlib.sha256(found[1][1].tobytes()).hexdigest() if len(found) > 1 else None)


def test_marks_are_cut_from_words_unless_a_piece_joins_them(model):
    assert model.units("word, word. x_.y") == ["▁word", ",", "▁word", ".", "▁x_.y"]


def test_the_best_is_the_same_whatever_n(spark, sf_dir, model):
    """Ties in score too go the same way; scores are summed without rounding."""
    units = {u for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() for u in model.units(r.text or "")}
    assert len(units) > 5000
    for u in units:
        one, two, five = (model.search(u, n) for n in (1, 2, 5))
        assert one == two[:1] == five[:1] and [s for s, *_ in two] == [s for s, *_ in five[:2]]


def test_an_idle_worker_forgets_its_units():
    """Its memory is free for other stages; a task that begins in time finds them again."""
    import time

    model = pc.Pieces([("▁", 0.0, False), ("a", -1.0, False)])
    before = model.best("a aa", 2)[0][0][1].tolist()
    model.rest(0.2)
    model.wake()
    time.sleep(0.4)
    assert model.known[2].row
    model.rest(0.05)
    time.sleep(0.5)
    assert not model.known and not model.older
    assert model.best("a aa", 2)[0][0][1].tolist() == before


def test_tables_of_units_are_bounded_by_the_caller(spark, sf_dir):
    """The pipeline's encoding keeps small tables, whatever the number of units; the rows are the same."""
    import corpus_pipeline

    model = pc.Pieces.load()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).coalesce(1)
    one, two = (sorted(map(str, pc.encode(docs, model, remembered=n).collect())) for n in (pc.REMEMBERED, 40))
    assert one == two
    model.wake(40)
    sizes = []
    for r in docs.collect():
        before = len(model.known.get(2, pc.Known()).ids)
        model.best_decoded(r.text or "", 2)
        sizes.append(before)
    assert max(sizes) < 40 + max(len(set(model.units(r.text or ""))) for r in docs.collect())
    assert corpus_pipeline.UNITS < pc.REMEMBERED
