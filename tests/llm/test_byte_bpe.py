import hashlib
import random

import pytest

from facetforge.llm.byte_bpe import (
    PIECE_CHARS,
    decode_documents,
    encode,
    encode_documents,
    encoding_of,
    rank_bytes,
    round_trip,
    safe_pieces,
)


@pytest.fixture(scope="module")
def encoding():
    return encoding_of(rank_bytes())


def long_texts():
    rng = random.Random(4)
    alphabet = "ab  \n\t'’éß中1😀.,!s  \x1c\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(50_000)) for _ in range(3)]
    texts += [" ".join(["don't", "it's"] * 20_000), "x" * 70_000, " " * 70_000, "\n a" * 30_000, "1 2" * 30_000]
    return texts


def test_cut_texts_have_the_ids_of_whole_texts(encoding):
    for text in long_texts():
        assert "".join(safe_pieces(text)) == text
        assert encode(encoding, text) == encoding.encode_ordinary(text)
    assert len(list(safe_pieces(" ".join(["word"] * 40_000)))) > 40_000 * 5 // (2 * PIECE_CHARS)


def test_round_trip_of_documents(spark, encoding, hard_docs):
    rows = encode_documents(hard_docs)
    for row in decode_documents(rows).collect():
        text = row["text"] or ""
        assert row["ids"] == encoding.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    for row in round_trip(hard_docs).collect():
        ids = encoding.encode_ordinary(row["text"] or "")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_special_tokens_are_ordinary_text(make_docs):
    ids = encode_documents(make_docs(["<|endoftext|>"])).first()["ids"]
    assert len(ids) > 1 and max(ids) < 50256


def test_part_of_a_character_decodes_to_raw_bytes(spark, encoding):
    ids = encoding.encode_ordinary("😀")
    rows = spark.createDataFrame([(ids[:1],), (None,), ([],)], "ids array<int>")
    decoded = [bytes(r["decoded"]) for r in decode_documents(rows).collect()]
    assert "😀".encode().startswith(decoded[0]) and decoded[0] != "😀".encode()
    assert decoded[1:] == [b"", b""]


def test_empty_table_and_clashing_name(no_docs, spark):
    assert encode_documents(no_docs).count() == 0
    docs = spark.createDataFrame([("a", 1)], "text string, IDS int")
    result = encode_documents(docs)
    assert result.columns == ["text", "ids"] and result.first()["ids"] == [64]
