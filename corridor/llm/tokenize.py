"""Token ids by a public tokenizer file, exactly as its library gives them for the whole text.

The word tokenizer drops white space and never joins across it, so a text's ids are those of its
pieces between spaces and line ends, one after another. Pieces the worker has met are looked up;
the others go to the library together. Commas and full stops after a word are split off and
Latin letters lower-cased first, both only where the library would do the same.
"""

from __future__ import annotations

import json
import re
from array import array

#: Pieces kept by a worker; the table is emptied beyond that, which changes no result.
MOST_KEPT = 600_000

#: Beyond these characters lower-casing may differ between libraries (İ lower-cases to two).
_BEYOND_LATIN = re.compile(r"[^\x00-įı-ſ‐-‧]")
_models: dict[str, object] = {}


def library(path: str):
    """The tokenizer of a .json file, loaded once in a worker."""
    if path not in _models:
        from tokenizers import Tokenizer

        _models[path] = Tokenizer.from_file(path)
    return _models[path]


def drops_blanks(path: str) -> bool:
    """Whether the file lower-cases, drops white space and encodes each run of letters by itself, byte by byte."""
    rules = json.loads(library(path).to_str())
    normal = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
    before = [x["type"] for x in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if normal != ["NFC", "Replace", "Lowercase"] or before != ["Split", "ByteLevel"]:
        return False
    split, bytes_ = rules["pre_tokenizer"]["pretokenizers"]
    return split["behavior"] == "Removed" and split["invert"] and not bytes_["add_prefix_space"] and not bytes_["use_regex"]


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.path, self.known = path, {}
        self.cut, self.characters = drops_blanks(path), byte_characters()
        one = library(path).encode_batch_fast([".", ","], add_special_tokens=False)
        self.stops = {c: array("I", x.ids).tobytes() for c, x in zip(".,", one, strict=True)}

    def _pieces(self, text: str) -> list[str]:
        if not self.cut:
            return [text]
        if "<|" not in text and (text.isascii() or not _BEYOND_LATIN.search(text)):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _letters(self, model, word: str) -> bytes:
        """Lower-case Latin words need none of the library's normalising and go straight to its model."""
        plain = word if word.isascii() else "".join(map(self.characters.__getitem__, word.encode()))
        return array("I", [t.id for t in model.tokenize(plain)]).tobytes()

    def _learn(self, unknown: set[str]) -> None:
        """A comma or full stop after a word is a token of its own; what else there is goes to the library whole."""
        encoder, known, others = library(self.path), self.known, []
        model = encoder.model
        for word in unknown:
            if not self.cut or not word.islower() or not (word.isascii() or not _BEYOND_LATIN.search(word)):
                others.append(word)
            elif word.isalpha():
                known[word] = self._letters(model, word)
            elif word[-1] in self.stops and word[:-1].isalpha():
                known[word] = (known.get(word[:-1]) or self._letters(model, word[:-1])) + self.stops[word[-1]]
            else:
                others.append(word)
        for word, found in zip(others, encoder.encode_batch_fast(others, add_special_tokens=False), strict=True):
            known[word] = array("I", found.ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        pieces = [self._pieces(x) for x in texts]
        if len(self.known) > MOST_KEPT:
            self.known.clear()
        self._learn(set().union(*pieces) - self.known.keys())
        return [b"".join(map(self.known.__getitem__, x)) for x in pieces]
