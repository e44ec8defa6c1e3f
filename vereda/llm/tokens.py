"""Encoding with a public BPE vocabulary, pre-token by pre-token.

Blanks end a pre-token whatever stands around them, so a text of plain letters, digits and
signs is split here and each pre-token goes through the library's own BPE model once per
worker. Anything else, and whatever could hold a special token, goes to the library word by
word. Both give the ids of the library for the whole text.
"""

import json
import re

import numpy as np

CACHE = 1 << 19  # pre-tokens kept per worker

#: Characters that neither the normaliser nor letter classes treat in any special way: visible
#: ASCII and the composed Latin letters, but for the dotted capital I, whose lower case is two.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-įıĲ-ž]*")
_BLANKS = re.compile(r"[ \t\n\r]+")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-įıĲ-žß]+|[0-9]|[^\sa-zà-öø-įıĲ-žß0-9]+")


def _byte_characters():
    """The character that stands for each byte in a byte-level vocabulary."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in kept]
    return {**{b: chr(b) for b in kept}, **{b: chr(256 + n) for n, b in enumerate(moved)}}


class _Pieces(dict):
    """Ids of pre-tokens as little-endian 32-bit bytes, made when first asked for."""

    def __init__(self, model):
        self.model = model
        self.characters = _byte_characters()

    def __missing__(self, piece):
        shown = piece if piece.isascii() else "".join(
            self.characters[b] for b in piece.encode("utf-8")
        )
        ids = [token.id for token in self.model.tokenize(shown)]
        if len(self) >= CACHE:
            self.clear()
        self[piece] = found = np.array(ids, dtype="<u4").tobytes()
        return found


class Encoder:
    """Encodes with a tokenizer file; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [token["content"] for token in spec["added_tokens"]]
        self.pieces = _Pieces(self.tokenizer.model)
        names = sorted(self.tokenizer.get_vocab().items(), key=lambda item: item[1])
        self.names = [None] * (names[-1][1] + 1)
        for name, at in names:
            self.names[at] = name
        self.short_way = self._knows(spec)

    def _knows(self, spec):
        """Whether the file is of the kind that ``_SPLIT`` describes."""
        steps = [step.get("type") for step in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [step.get("type") for step in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        return (
            steps == ["NFC", "Replace", "Lowercase"] and splits == ["Split", "ByteLevel"]
            and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex") == pattern
            and spec["post_processor"] is None
        )

    def _library(self, text):
        return np.array(
            self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4"
        ).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text."""
        if not self.short_way:
            return self._library(text)
        if _PLAIN.fullmatch(text) and not any(word in text for word in self.special):
            return b"".join(map(self.pieces.__getitem__, _SPLIT.findall(text.lower())))
        out = []
        for word in _BLANKS.split(text):
            if not word:
                continue
            if _PLAIN.fullmatch(word) and not any(special in word for special in self.special):
                out.append(b"".join(map(self.pieces.__getitem__, _SPLIT.findall(word.lower()))))
            else:
                out.append(self._library(word))
        return b"".join(out)

    def decode(self, ids) -> str:
        """Text of ids as the library gives it without a decoder: the tokens with blanks between."""
        return " ".join(map(self.names.__getitem__, ids))


_encoders = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one per worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
