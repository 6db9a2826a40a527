"""Byte-level BPE by the tokenizers library, with the ids of frequent units kept by each Python worker.

White space that is followed by another character starts a pre-token wherever it stands, so a text can be cut there and its parts encoded apart. So can
a full stop or comma after a letter at the end of a part. Of the parts that a worker has not met yet, those of letters only are one pre-token each and go to
the library's merges directly. Texts with white space side by side are cut at fewer places; texts with special tokens are left to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from struct import Struct

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
KEPT_UNITS, KEPT_CHARS = 250_000, 48

_SIDE_BY_SIDE = re.compile(r"\s(?:\s|$)")
_STOPS = ".,"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def units(text: str) -> list[str]:
    """What stands before the first cut, then what follows each: with its line feed where it was cut before one, without its space otherwise."""
    if not _SIDE_BY_SIDE.search(text):
        return text.replace("\n", " \n").split(" ")
    parts = text.split(" ")
    out = parts[:1]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(p)
        else:
            out[-1] += " " + p
    return out


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in byte-level tokens: visible Latin-1 characters for themselves, the rest from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _stem(unit: str) -> str | None:
    """The unit without its full stop or comma, where that is a pre-token of its own."""
    return unit[:-1] if len(unit) > 1 and unit[-1] in _STOPS and unit[-2] < "ɐ" and unit[-2].isalpha() else None


class _Known(dict):
    """Ids of units; one that is missing is encoded, and kept unless it is long."""

    def __init__(self, tokenizer, kind: np.dtype) -> None:
        self.encode, self.merges, self.kind = tokenizer.encode, tokenizer.model.tokenize, kind
        self.code = "H" if kind.itemsize == 2 else "I"
        self.forms = [Struct(f"<{n}{self.code}") for n in range(64)]
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[0x20]
        self.marks = {c: self.packed(tokenizer.encode(c, add_special_tokens=False).ids) for c in _STOPS + "\n"}

    def packed(self, ids: list[int]) -> bytes:
        return (self.forms[len(ids)] if len(ids) < len(self.forms) else Struct(f"<{len(ids)}{self.code}")).pack(*ids)

    def __missing__(self, unit: str) -> bytes:
        if unit.isalpha() and (unit.isascii() or max(unit) < "ɐ"):  # so that every version of the Unicode tables calls these letters
            ids = self.packed([x.id for x in self.merges(self.space + (unit if unit.isascii() else self.mapped(unit)))])
        elif stem := _stem(unit):
            ids = self[stem] + self.marks[unit[-1]]
        elif unit[:1] == "\n" and unit[1:].isalpha() and max(unit) < "ɐ":
            ids = self.marks["\n"] + self.packed([x.id for x in self.merges(self.mapped(unit[1:]))])
        else:
            ids = self.packed(self.encode(unit if unit[:1] == "\n" else " " + unit, add_special_tokens=False).ids)
        if len(unit) <= KEPT_CHARS:
            self[unit] = ids
        return ids

    def mapped(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.alphabet)


class Encoder:
    """Encodes and decodes texts as the library's own calls do with add_special_tokens=False and skip_special_tokens=False."""

    def __init__(self, path: str, most: int) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            special = [x["content"] for x in json.load(f)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        vocabulary = self.tokenizer.get_vocab()
        self.type = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a byte-level token has a character for each byte
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)
        self.most = most
        self.known = _Known(self.tokenizer, self.type)

    def _plain(self, text: str) -> bytes:
        return self.known.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _one(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special and self.special.search(text):
            return self._plain(text)
        parts = units(text)
        head = parts.pop(0)
        return (self._plain(head) if head else b"") + b"".join(map(self.known.__getitem__, parts))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``self.type``."""
        out = []
        for text in texts:
            if len(self.known) > self.most:
                self.known.clear()
            out.append(self._one(text))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(path: str, most: int = KEPT_UNITS) -> Encoder:
    """One per Python worker and file, which keeps the ids of up to ``most`` units."""
    return Encoder(path, most)
