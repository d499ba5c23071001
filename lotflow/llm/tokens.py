"""Token ids of whole texts, as the tokenizers library gives them, with remembered pieces.

A byte-pair encoder treats each piece that its pre-tokenizer cuts apart from the
others, so the ids of a text are those of its pieces in a row. The pieces of
common characters are cut here and each is encoded once by the library; a text
with any other character, or with what may be a special token, goes to the
library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata

import numpy as np

from lotflow.llm.common import chunks

# The patterns of the two pre-tokenizers, L for letters and N for numbers.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^\sLN]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[L]+|[N]|[^\sLN]+"
WORD_LEVEL_SOURCE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters cut here: printable ASCII, line ends, Latin-1 and Latin Extended-A without the dotted capital I.
_OTHER = re.compile("[^\n\r\t -~ -įı-ſ]")
_HIGH = [chr(c) for c in range(0xA0, 0x180) if c != 0x130]


def _pattern(template: str) -> re.Pattern:
    letters = "A-Za-z" + "".join(c for c in _HIGH if unicodedata.category(c)[0] == "L")
    numbers = "0-9" + "".join(c for c in _HIGH if unicodedata.category(c)[0] == "N")
    classes = {"[L]": f"[{letters}]", "[N]": f"[{numbers}]", r"\sLN": rf"\s{letters}{numbers}"}
    for name, characters in classes.items():
        template = template.replace(name, characters)
    return re.compile(template)


def version(path: str) -> str:
    """Digest of a tokenizer's file: counts made by another version are not reused."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Encoder:
    """Encodes texts with one tokenizer file; ``remember`` bounds the pieces kept in memory."""

    def __init__(self, path: str, remember: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.remember, self.pieces = remember, {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.lower, self.pattern = False, None
        pre, norm = spec["pre_tokenizer"], spec["normalizer"]
        if norm is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.pattern = _pattern(BYTE_LEVEL)
        elif norm and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and pre["type"] == "Sequence" and pre["pretokenizers"][0].get("pattern") == {"Regex": WORD_LEVEL_SOURCE}:
            self.lower, self.pattern = True, _pattern(WORD_LEVEL)

    def _library(self, batch: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(batch, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        """Encode new pieces. Printable ASCII stands for itself in both byte alphabets, the blank aside: it needs the model only."""
        model = self.tokenizer.model.tokenize
        plain = [p for p in new if p.isascii() and p.isprintable()]
        for p in plain:
            self.pieces[p] = np.array([t.id for t in model(p.replace(" ", "Ġ"))], "<u4").tobytes()
        other = list(new.difference(plain))
        self.pieces.update(zip(other, self._library(other)))

    def _cut(self, text: str) -> list[str] | None:
        if self.pattern is None or _OTHER.search(text) or any(s in text for s in self.special):
            return None
        return self.pattern.findall(text.lower() if self.lower else text)

    def encode(self, values: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        for part in chunks(values, len, 500_000):
            cut = [self._cut(t) for t in values[part]]
            if len(self.pieces) > self.remember:
                self.pieces.clear()
            self._learn(set().union(*filter(None, cut)).difference(self.pieces))
            get = self.pieces.__getitem__
            for text, pieces in zip(values[part], cut):
                out.append(self._library([text])[0] if pieces is None else b"".join(map(get, pieces)))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
