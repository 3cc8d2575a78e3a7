"""The pipeline's stages in order, each against plain loops over its own input."""

import test_decontaminate
import test_line_dedup
import test_quality
import test_simhash

import corpus_pipeline
from glossa.llm import quality
from glossa.llm.pieces import Pieces


def plain_quality(docs, judged):
    out = {}
    for d, text in docs.items():
        counts, features = quality.statistics(text)
        if counts[0] >= 50 and 2 * counts[4] <= counts[0] and test_quality.plain_score(judged.forest, features) < judged.threshold:
            out[d] = text
    return out


def plain_near_dedup(docs):
    ids = list(docs)
    grams = {d: frozenset(zip(*(lowered(t).split()[k:] for k in range(5)), strict=False)) for d, t in docs.items()}
    prints = {d: test_simhash.naive_print(t, 5) for d, t in docs.items()}
    links = [(a, b) for n, b in enumerate(ids) for a in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 2 or len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]) > 0]
    kept = set(test_simhash.roots(links, ids).values())
    return {d: t for d, t in docs.items() if d in kept}


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_decontamination(docs, items):
    found = test_decontaminate.brute(list(docs.items()), items)
    return {d: t for d, t in docs.items() if not found[d][1]}


def texts_of(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_and_run_equal_plain_loops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    plain = [
        lambda d: plain_quality(d, judged),
        lambda d: dict(test_line_dedup.brute(list(d.items()))),
        plain_near_dedup,
        lambda d: plain_decontamination(d, items),
    ]
    state, want, sizes = docs, texts_of(docs), []
    for (name, stage), loop in zip(corpus_pipeline.STAGES, plain, strict=False):
        out = stage(spark, state, sf_dir).cache()
        assert out.columns == docs.columns, name
        want = loop(want)
        assert texts_of(out) == want, name
        assert out.filter("n_chars <> length(text)").count() == 0, name
        sizes.append(len(want))
        state = out
    assert 200 > sizes[0] > sizes[2] > sizes[3] > 50
    model = Pieces.load()
    ran = corpus_pipeline.run(spark, sf_dir)
    assert ran.columns == ["doc_id", "n_pieces", "n_unknown", "ids", "ids_sha256", "round_trip"]
    assert {r.doc_id: model.decode(r.ids) for r in ran.collect()} == want
    assert {r.doc_id: r.ids for r in ran.collect()} == {d: model.encode(t)[0].tolist() for d, t in want.items()}


def test_encoding_reads_all_segmentations_back(spark, monkeypatch):
    """A second segmentation that doesn't decode to the text fails the round trip."""

    class Odd(Pieces):
        def __reduce__(self):
            return Odd, (self.source,)

        def decode(self, ids):
            return "x" if ids == [0, 2, 3] else super().decode(ids)

    odd = Odd([("\u2581", 0.0, False), ("ab", -1.0, False), ("a", -2.0, False), ("b", -3.0, False)])
    monkeypatch.setattr(Pieces, "load", classmethod(lambda cls: odd))
    docs = spark.createDataFrame([(1, "ab"), (2, "b"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: (r.ids, r.round_trip) for r in corpus_pipeline.encoding(spark, docs, "").collect()}
    assert got == {1: ([0, 1], False), 2: ([0, 3], True), 3: (None, None)}
