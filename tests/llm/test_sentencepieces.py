import random

import numpy as np
import pytest
import sentencepiece

from railmill.llm.sentencepieces import Decoder, Encoder, decode_documents, encode_documents, load_vocabulary, round_trip

PATH = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype="<i4").tolist()


def samples():
    rng = random.Random(11)
    yield from ["", " ", "   ", "\n", "a" * 3000, "ab" * 2000, "今日は" * 300, "x" * 40 + " " * 45 + "y", "▁a▁▁b", "<s> <unk> <0x41>"]
    for alphabet, number in (("etaoin shrdlu  \n\t.,!ABC123éüß漢字\U0001f917", 1500), ("ab ", 300), (" ", 40)):
        for _ in range(number):
            yield "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 150)))


def test_ids_equal_the_library(vocabulary, library):
    encoder = Encoder(vocabulary)
    for text in samples():
        assert ids(encoder, text) == library.encode(text), text[:80]


def test_decoding_restores_the_text(vocabulary, library):
    encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
    for text in samples():
        got = decoder.decode(np.array(ids(encoder, text), dtype=np.int32))
        assert got == text.replace("▁", " ")
    assert decoder.decode(np.array([1, 2, -5, 99_999, 0], dtype=np.int32)) == ""


def test_ids_are_committed_before_the_text_ends(vocabulary):
    """The window stays small on a long unit without spaces."""
    encoder = Encoder(vocabulary)
    sizes, commit = [], encoder._commit
    encoder._commit = lambda unit, base, last, width, out: (sizes.append(len(last)), commit(unit, base, last, width, out))
    rng = random.Random(1)
    encoder.search("".join(rng.choice("abcdefghij") for _ in range(20_000)))
    assert len(sizes) > 100 and max(sizes) < 20 * encoder.longest


def test_whole_documents(spark, small, vocabulary, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    encoded = encode_documents(docs, vocabulary)
    assert encoded.columns == [*docs.columns, "ids"]
    decoded = decode_documents(encoded, vocabulary).collect()
    assert all(r["ids"] == library.encode(r["text"]) and r["decoded"] == r["text"] for r in decoded)
    checked = round_trip(docs, vocabulary).collect()
    assert {r["doc_id"]: r["n_ids"] for r in checked} == {r["doc_id"]: len(r["ids"]) for r in decoded}
    assert all(r["restored"] for r in checked)


def test_odd_rows(spark, odd_documents, vocabulary, library):
    encoded = encode_documents(odd_documents, vocabulary)
    assert sorted(encoded.columns) == sorted(odd_documents.columns)  # the clashing column is replaced
    rows = decode_documents(encoded, vocabulary).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["ids"] == (None if r["text"] is None else library.encode(r["text"]))
        assert r["decoded"] == (None if r["text"] is None else r["text"].replace("▁", " "))
    checked = {r["doc_id"]: r for r in round_trip(odd_documents, vocabulary).collect()}
    assert checked[1]["n_ids"] == 0 and checked[1]["restored"] and not checked[8]["restored"]
    assert encode_documents(odd_documents.limit(0), vocabulary).collect() == []
    assert round_trip(odd_documents.limit(0), vocabulary).collect() == []
