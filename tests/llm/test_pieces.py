import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from lakeops.llm.pieces import Encoder, Pieces, default_model, token_digests, tokenize

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [
    "", " ", "  a  b ", "a\nb\t\tc", "The the of and thing singing in the ring", "aaaaaaaa aaaaaaaaaaaaaaa " * 3, "▁hi▁ x",
    "\x00a", "<s>hi</s> <0x0A> <unk>", "\U0001f600\U0001f600 x�y", "中文字符漢字 ﬁ Ａ\xa0b　c", "é́x ñ", "=" * 500, "abcab" * 4000, "ththeththe" * 50,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


@pytest.fixture(scope="module")
def pieces():
    return Pieces(default_model())


def check(pieces, library, texts):
    ids, counts = Encoder(pieces).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        own = ids[at : at + n].tolist()
        at += n
        want = library.encode(text)
        assert own == want, text[:80]
        assert pieces.decode(own) == library.decode(want), text[:80]


def test_equals_the_library(pieces, library):
    check(pieces, library, TEXTS)
    check(pieces, library, ["x" + " ".join(TEXTS[:9])])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="aehinrst .,'\n", max_size=300)), max_size=6))
def test_equals_the_library_on_any_text(texts):
    check(PIECES, LIBRARY, texts)


@settings(max_examples=150, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=20))
def test_decodes_any_ids(ids):
    assert PIECES.decode(ids) == LIBRARY.decode(ids)


PIECES = Pieces(default_model())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_forgetting_words_changes_nothing(pieces, library, monkeypatch):
    monkeypatch.setattr("lakeops.llm.pieces.KNOWN_WORDS", 2)
    encoder = Encoder(pieces)
    for text in TEXTS[:8]:
        assert encoder.encode([text])[0].tolist() == library.encode(text)


def test_rows_nulls_and_clashing_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "The end.", None)]
    got = tokenize(spark.createDataFrame(rows, "doc_id long, text string, ids string"), default_model()).collect()
    assert sorted((str(r.row.doc_id), str(r.row.ids), list(r.ids), r.decoded) for r in got) == sorted(
        [("1", "x", [], ""), ("2", "y", [], ""), ("2", "y", [], ""), ("None", "None", library.encode("The end."), "The end.")]
    )
    assert tokenize(spark.createDataFrame([], "doc_id long, text string"), default_model()).count() == 0


def test_query_digests(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in token_digests(docs).collect()}
    for row in docs.collect():
        ids = library.encode(row.text)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert tuple(got[row.doc_id])[1:] == want
