import numpy as np
import pytest
import sentencepiece

from firnline.llm import sentencepiece_scan as scan

TEXTS = [
    None, "", " ", "   ", "a", "the of and\n\tthe", "x" * 70, "ab" * 50, "word  two   spaces ", "▁mark and ▁▁", "naïve 東京 ⚙️⚙️ 🇩🇪 ①②③",
    "nospaces" * 30, "été " * 40, "\u0000nul", "⚙" * 50, "(((((((((((((())))))))))))", "    indented    code    " * 6, "1234567890" * 9,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=scan.MODEL)


@pytest.mark.parametrize("chunk", [3, 7, 16, 40])
def test_cut_texts_are_encoded_as_whole_ones(spark, library, chunk):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "repeated row"), (3, TEXTS[3]), (None, "repeated row")]
    docs = spark.createDataFrame([(*r, "other", 1) for r in rows], "doc_id long, text string, k string, rid int")
    got = sorted(((r.doc_id, r.n_tokens, list(r.ids), r.round_trip) for r in scan.encode(docs, chunk=chunk).collect()), key=repr)
    want = sorted(((i, len(x), x, True) for i, t in rows for x in [library.encode(t or "")]), key=repr)
    assert got == want


def test_decode_gives_the_text_back(spark):
    docs = spark.createDataFrame([(1, "some text\nhere"), (2, None)], "doc_id long, text string")
    back = {r.doc_id: r.text for r in scan.decode(scan.encode(docs)).collect()}
    assert back == {1: "some text\nhere", 2: ""}
    assert scan.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().text is None


def test_empty_table(spark):
    assert scan.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_products_are_associative_and_scanned():
    rng = np.random.default_rng(3)
    ms = [np.where(rng.random((4, 4)) < 0.5, 0.0, -np.inf) for _ in range(7)]
    whole = ms[0]
    for i, got in enumerate(scan.scan(ms)):
        whole = ms[0] if i == 0 else scan.combine(whole, ms[i])
        assert np.array_equal(whole, got)
