"""Texts cut at single spaces and line ends, without the pattern: the ids are those of the library."""

import random

import public_tokenizers
import pytest

from finchlake.llm import tokenizing

PARTS = [" ", "\n", "\t", "  ", "\n\n", " \n", "\n ", "a", "The", "don't", ".", ",", "é", "ß", "Ab.", "x,", "1",
         " ", "　", "字", "\r\n", "\x0b", "'s", "\n'", "ll", "...", ",,", "😀", "<|endoftext|>", "_", "İ"]


@pytest.mark.parametrize("name, drops_space", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_are_those_of_the_whole_text(monkeypatch, name, drops_space):
    monkeypatch.setattr(tokenizing, "PIECES_KEPT", 100)
    encoder = tokenizing.PieceEncoder(public_tokenizers.path(name), drops_space)
    draws = random.Random(5)
    for _ in range(2_000):
        text = "".join(draws.choice(PARTS) for _ in range(draws.randint(0, 14)))
        assert encoder.ids(text) == encoder._whole(text), repr(text)


def test_plain_texts_need_no_pattern(monkeypatch):
    encoder = tokenizing.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), False)
    monkeypatch.setattr(encoder, "split", lambda text: pytest.fail("cut by the pattern"))
    for text in ("One line. Two words,\nanother line\n1 more: it's", "One líne. Twö words,\n字 line\n1 more: it’s"):
        assert encoder.ids(text) == encoder._whole(text)


@pytest.mark.parametrize("name, drops_space", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_signs_after_letters_are_pieces_of_their_own(monkeypatch, name, drops_space):
    encoder = tokenizing.PieceEncoder(public_tokenizers.path(name), drops_space)
    texts = ["One two$$$ Three.%%% four!! fünf&&& Six,### it's, it's! a'b.. \"x\" 5.% ''' word'' (one) two_ Éa***\nNine### ten's.",
             "a <|endof b>! c|> ..' d.'s e!'ll İ. ſ! Σ? ΑΣ! á. ́! ½. ٣! x²; ª:"]
    for text in texts:
        assert encoder.ids(text) == encoder._whole(text), text
    whole = []
    monkeypatch.setattr(encoder, "_whole", lambda text: whole.append(text) or b"")
    encoder.ids("seven$$$ Eight.%%% nein!! gehen&&&")   # words that were not seen before
    assert all(not any(c.isalpha() for c in text) for text in whole), whole
