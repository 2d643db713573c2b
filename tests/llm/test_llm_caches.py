"""What the encoder keeps: the ids of what follows a space, and no second call for a known word with marks."""

import array
import types

import public_tokenizers
import pytest

from lapsewise.llm import tokens


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_with_marks_take_one_model_call_each(vocabulary):
    """A word that is known is not encoded again with marks after it, and the ids are the library's."""
    encoder, seen = tokens.Encoder(public_tokenizers.path(vocabulary)), []
    model = encoder.model
    encoder.model = types.SimpleNamespace(tokenize=lambda piece: seen.append(piece) or model.tokenize(piece))
    text = "Zq xylo, xylo; xylo!! xylo xylo:. naïve, naïve. d\\ e\\- it's, 12, a1. straße? \n xylo,\n\n, ,"
    whole = array.array("I", encoder.whole.encode(text, add_special_tokens=False).ids).tobytes()
    assert encoder.encode(text) == whole and encoder.encode(text) == whole
    assert sum("xylo" in piece for piece in seen) == 1


def test_parts_are_kept_as_what_follows_a_space():
    encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode("a word, word, 12ab.")
    assert {"word", "word,", "12ab."} <= encoder.words.new.keys()


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_what_follows_a_space_is_looked_up_once_a_batch(vocabulary):
    """Texts encoded together give the library's ids; a repeated word is one look-up, also where the cache holds nothing."""
    encoder, seen = tokens.Encoder(public_tokenizers.path(vocabulary), words=1), []
    model = encoder.model
    encoder.model = types.SimpleNamespace(tokenize=lambda piece: seen.append(piece) or model.tokenize(piece))
    texts = ["xylo", "", " ", "a xylo xylo, ", "naïve  xylo  b", "xylo xylo! other xylo, xylo\nq xylo", "  ", "  x", "x "]
    whole = [array.array("I", encoder.whole.encode(t, add_special_tokens=False).ids).tobytes() + b"\2\0\0\0" for t in texts]
    assert encoder.encode_all([t.encode() for t in texts], b"\2\0\0\0").to_pylist() == whole
    assert encoder.encode_all([], b"\2\0\0\0").to_pylist() == []
    seen.clear()
    many = encoder.encode_all([b"a" + b" zorp other" * 50] * 20, b"").to_pylist()
    assert set(many) == {array.array("I", encoder.whole.encode("a" + " zorp other" * 50, add_special_tokens=False).ids).tobytes()}
    assert sum("zorp" in piece for piece in seen) == 1
