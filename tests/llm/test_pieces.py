import hashlib
import random

import pytest
from conftest import SF
from threadloom.llm.common import table
from threadloom.llm.pieces import Pieces, encoded
from threadloom.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def pieces():
    return Pieces(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())


def ids_of(raw):
    return list(memoryview(raw).cast("I"))


def texts():
    rng = random.Random(5)
    yield from ["", " ", "  a  b ", "a\n\nb", "\ta", "<s>hi</s>", "<0x0A>", "ﬁ ﬀ é", "▁a ▁", "\x00x", "\U0001f600 ok"]
    yield from [" " * n for n in range(1, 70)] + [" " * n + "the" for n in range(1, 40)] + ["a" * n for n in range(1, 40)]
    letters = "aaeeinorstlhd  \n.,-'éçü中\U0001f600▁=_0123<>/"
    for _ in range(3000):
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(1, 60)))


def test_ids_and_texts_equal_those_of_the_library(pieces, library):
    for text in texts():
        raw = pieces.encode(text)
        assert ids_of(raw) == library.encode(text, add_bos=True, add_eos=True), repr(text)
        assert pieces.decode(raw) == library.decode(ids_of(raw)), repr(text)


def test_decoding_of_any_ids(pieces, library):
    from array import array

    rng = random.Random(6)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(1, 12))]
        assert pieces.decode(array("I", ids).tobytes()) == library.decode(ids), ids


def test_table_agrees_with_merges(pieces):
    for text in ["internationalization", "theronblestof", "▁▁▁▁▁the", "aaaaaaaaaaaaaaaaaaa"]:
        assert pieces.tokens(text) == pieces.merged(text)


def test_whole_table(spark, library):
    docs = table(spark, SF, "documents")
    found = {r["doc_id"]: r for r in encoded(docs, vocabulary_path()).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        got = found[r["doc_id"]]
        assert (got["n_tokens"], bytes(got["ids"])) == (len(ids), raw)
        assert got["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_edges(spark, rows, library):
    long = "x中" * 60_000
    docs = rows([(1, None, "a"), (2, "", "b"), (3, long, "c"), (3, long, "d"), (None, "a b", "e")], "doc_id long, text string, ids string")
    found = encoded(docs, vocabulary_path()).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in found][:2] == [(1, 2), (2, 2)]
    assert found[2]["ids"] == found[3]["ids"]
    assert ids_of(bytes(found[2]["ids"])) == library.encode(long, add_bos=True, add_eos=True)
    assert found[4]["doc_id"] is None
    assert encoded(docs.limit(0), vocabulary_path()).collect() == []
