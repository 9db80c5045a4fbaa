"""Token ids of whole texts by the tokenizers library, with a cache of what recurs.

The byte-pair vocabularies cut a text before any merge: at white space, and between letters and other
characters. So the ids of a text are those of its parts in a row, a part being a run of letters with
a blank before it, or a run of other characters. Each worker keeps the ids of parts it has seen, as
bytes, and asks the library only for new ones. That holds for texts of Latin-1 characters with single
blanks and line breaks, without apostrophes (contractions are cut otherwise) and without the start of
a special token; the library encodes any other text whole.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd

ID = np.dtype("<u4")
#: Parts that a worker remembers at most, about 200 bytes each; beyond that it starts anew.
REMEMBERED = 800_000

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_PARTS = re.compile(f" ?[{_LETTERS}]+|(?: (?![{_LETTERS}])|[^ {_LETTERS}])+")
_WORD = re.compile(f" ?[{_LETTERS}]+")
_WHOLE = ("'", "<|", "  ", "\n\n", " \n", "\n ")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class _Known(dict):
    """The ids of parts; a new one is asked for once."""

    def __init__(self, ask: Callable[[str], bytes]) -> None:
        self.ask = ask

    def __missing__(self, part: str) -> bytes:
        self[part] = ids = self.ask(part)
        return ids


class Encoder:
    """Encodes texts with the vocabulary file at ``path``; ``end`` follows each text's ids."""

    def __init__(self, path: str, end: int | None = 1, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.end = b"" if end is None else np.array([end], ID).tobytes()
        self.known = _Known(self._part)
        self.remembered = remembered
        self.letters = dict(enumerate(_byte_letters()))
        #: Whether blanks are dropped and words made lower case before the merges.
        self.lowers = self.whole(" ÀB") == self.whole("àb")

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, ID).tobytes()

    def _part(self, part: str) -> bytes:
        if not _WORD.fullmatch(part):
            return self.whole(part)
        # Letters go straight to the merges, in the spelling of byte-level vocabularies.
        word = part.lstrip(" ") if self.lowers else part
        spelled = word.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.library.model.tokenize(spelled)]
        return np.array(ids, ID).tobytes()

    def _text(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        if any(sign in text for sign in _WHOLE) or not text.replace("\n", " ").isprintable():
            return self.whole(text)
        if self.lowers:
            text = text.lower()
        if len(self.known) > self.remembered:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, _PARTS.findall(text)))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null is empty."""
        return [(self._text(text) if text else b"") + self.end for text in texts]


@cache
def encoder(path: str, end: int | None = 1, remembered: int = REMEMBERED) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path, end, remembered)


def ids_crc32(ids: pd.Series) -> pd.Series:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return ids.map(lambda row: zlib.crc32(np.asarray(row).astype(ID).tobytes()))
