"""Encoding texts word by word with a public tokenizer.

The tokenizer drops white space and never joins across it, so the ids of a text are
those of its words in a row. Words repeat, and each is encoded once per worker as long
as the bounded cache holds it.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from operator import itemgetter

import numpy as np

#: Letters that lower-casing and composition treat one by one, then signs.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
#: What keeps a text from being lower-cased and parted from its full stops beforehand:
#: signs in a row, special tokens, letters beyond Latin-1.
UNEVEN = re.compile(r"[\W_][.,]\s|<\||[^\x00-\xff]")
CACHE_WORDS = 600_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    bytes stand for themselves, the others take the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder(dict):
    """Words as UTF-8 bytes to the bytes of their ids."""

    def __init__(self, path: str, cache: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(self.code).newbyteorder("<")
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for letters in [byte_letters()] for c in range(256)}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.cache:
            self.clear()
        text = word.decode()
        if plain := PLAIN.fullmatch(text):
            units = [u for u in (plain[1].lower(), plain[2]) if u]
            ids = [t.id for u in units for t in self.model.tokenize(u if u.isascii() else u.translate(self.letters))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        ids = self[word] = array(self.code, ids).tobytes()
        return ids

    def __call__(self, text: str, end_id: int) -> np.ndarray:
        if not UNEVEN.search(text):
            text = text.lower().replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ")
        words = text.encode().split()  # parts at ASCII white space only
        found = b"".join(itemgetter(*words)(self)) if len(words) > 1 else b"".join(map(self.__getitem__, words))
        return np.frombuffer(found + array(self.code, [end_id]).tobytes(), self.kind)


@lru_cache(maxsize=1)
def encoder_for(path: str) -> Encoder:
    """One encoder for each worker process and tokenizer."""
    return Encoder(path)
