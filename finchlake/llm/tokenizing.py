"""Whole texts to token ids with a public tokenizer, fast where words repeat.

Neither vocabulary joins anything across white space: the byte-level one starts a piece before every run
of white space, the word-level one drops white space. So a text is cut there, every piece is given to the
tokenizers library once, and its ids are kept for the next time. The memory of pieces is bounded.
"""

from __future__ import annotations

import functools
import operator
import os
import re
import string
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd

PIECES_KEPT = 600_000   # and as many of the generation before: some 200 MB a worker
# The separators that Python takes for white space and the tokenizers do not.
UNSURE = ("\x1c", "\x1d", "\x1e", "\x1f")
OTHER_SPACE = "\t\r\x0b\x0c"   # of ASCII, beside the space and the line's end
WITH_SPACE = re.compile(r"\s*\S+|\s+")
# Byte-level vocabularies write bytes as signs: printable Latin-1 ones as themselves, the others, in order,
# as the characters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
SPACE_SIGN = chr(BYTE_SIGNS[ord(" ")])
# After plain letters these make one piece, up to the next letter, digit or white space; an apostrophe may take letters.
CLOSING = string.punctuation.replace("'", "")
ID = operator.attrgetter("id")


def _bytes(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _AfterSpace(dict):
    """Ids of the words that follow one space; a missing one comes from the generation before or the encoder."""

    def __init__(self, encoder):
        self.old: dict[str, bytes] = {}
        self.tokenize, self.find = encoder.model.tokenize, encoder._found

    def __missing__(self, word: str) -> bytes:
        known = self.old.get(word)
        if known is None:   # most are plain letters, which are their own signs
            known = _bytes(map(ID, self.tokenize(SPACE_SIGN + word))) if (
                word.isascii() and word.isalpha()) else self.find(" " + word)
        self[word] = known
        return known


class PieceEncoder(dict):
    """``ids(text)``: little-endian unsigned 32-bit ids of the whole text, as the library gives them.

    No special tokens are put around a text; the string of one in a text gets its id.

    The dictionary itself holds the ids of known pieces; a missing one is looked for among those of the
    generation before, and encoded at last.
    """

    def __init__(self, path: str, drops_space: bool, kept: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]   # a text that holds one of these is cut there first
        self.folded = [token.content.lower() for token in added if token.normalized]
        self.model, self.drops_space, self.kept = self.tokenizer.model, drops_space, kept or PIECES_KEPT
        self.split = str.split if drops_space else WITH_SPACE.findall
        self.old: dict[str, bytes] = {}
        self.after = _AfterSpace(self)

    def _encoded(self, text: str) -> bytes:
        word = self._one_word(text)
        if word is None:
            return self._whole(text)
        return _bytes(map(ID, self.model.tokenize(word)))

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _one_word(self, piece: str) -> str | None:
        """A piece of letters only, as the tokenizer's own model takes it; None for any other piece.

        Such a piece needs no cutting, which is most of the cost of a short text.
        """
        if self.drops_space:
            lower = piece.lower()
            if piece.isascii():
                return lower if lower.isalpha() else None
            if not (lower.isalpha() and len(lower) == len(piece) and "Σ" not in piece
                    and unicodedata.is_normalized("NFC", piece)):
                return None
            piece = lower
        elif not self._plain(piece):
            return None
        elif piece.isascii():   # its bytes are their own signs, but for the space
            return SPACE_SIGN + piece[1:] if piece[0] == " " else piece
        return piece.encode("utf-8").decode("latin-1").translate(BYTE_SIGNS)

    def _plain(self, piece: str) -> bool:
        """Letters only, for the byte-level vocabulary after one space at most."""
        if self.drops_space:
            return self._one_word(piece) is not None
        return (piece[1:] if piece[:1] == " " else piece).isalpha()

    def __missing__(self, piece: str) -> bytes:
        known = self.old.get(piece)
        if known is None:
            known = self._found(piece)
        self[piece] = known
        return known

    def _found(self, piece: str) -> bytes:
        # Both vocabularies end a piece between plain letters and the signs after them.
        word = piece.rstrip(CLOSING)
        if len(word) < len(piece) and word and self._plain(word):
            known = self.after[word[1:]] if word[0] == " " else self[word]
            return known + self[piece[len(word):]]
        if self.drops_space and piece != piece.lower() and self._one_word(piece) is not None:
            return self[piece.lower()]   # this vocabulary takes plain words without regard to case
        # The byte-level one also ends a piece between a line's end and the letters after it.
        if not self.drops_space and piece[0] == "\n" and word[1:].isalpha():
            return self["\n"] + self[piece[1:]]
        return self._encoded(piece)

    def _by_line(self, text: str) -> bytes | None:
        """The ids of a text whose white space is single spaces and line ends, which is cut fastest; else None."""
        out, head = [], ""
        for line in text.split("\n"):
            words = line.split(" ")
            if "" in words:
                return None
            out.append(self[head + words[0]])
            out.extend(map(self.after.__getitem__, words[1:]))
            head = "\n"
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        if any(c in text for c in UNSURE) or any(s in text for s in self.added) or (
                self.folded and any(s in text.lower() for s in self.folded)):
            return self._whole(text)
        out = None
        if not self.drops_space and (not any(c in text for c in OTHER_SPACE) if text.isascii()
                                     else text.split() == text.replace("\n", " ").split(" ")):
            out = self._by_line(text)
        if out is None:
            out = b"".join(map(self.__getitem__, self.split(text)))
        if len(self) + len(self.after) > self.kept:  # the pieces of late live on, the others go
            self.old, self.after.old = dict(self), dict(self.after)
            self.clear()
            self.after.clear()
        return out


@functools.lru_cache(maxsize=4)
def encoder(path: str, drops_space: bool, kept: int | None = None) -> PieceEncoder:
    """One per Python worker, kept between tasks; ``kept`` pieces are remembered, by default PIECES_KEPT."""
    return PieceEncoder(path, drops_space, kept)


def chunks(batches: Iterable[pd.DataFrame], rows: int = 512) -> Iterator[pd.DataFrame]:
    """The batches in slices of few rows, so that what a task emits at once stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at:at + rows]
