"""Byte-level BPE of whole texts to little-endian 32-bit ids, as the tokenizers library gives them.

Texts of common characters are cut into the tokenizer's own pre-tokens by a plain regex and each distinct pre-token is
encoded once by the library and remembered; any text with another character or a special token's beginning goes to the
library as it is.
"""

from __future__ import annotations

import array
import functools
import re
import sys

#: Characters whose classes (letter, number, space, other) the regex below spells out.
COMMON = re.compile(r"[\t\n\r -~\xa0-\u024f\u2013\u2014\u2018-\u201d\u2022\u2026]*")
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t\n\r \xa0"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Distinct pre-tokens in each of two generations that are remembered: what is used stays, memory is bounded.
CACHE_ENTRIES = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves,
    the others, in order, for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def pack(ids) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Pieces(dict):
    """Pre-token -> packed ids."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model, self.letters, self.older = tokenizer.model, [c for c, _ in sorted(byte_alphabet().items(), key=lambda x: x[1])], {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            # of printable ASCII only the blank has a stand-in
            letters = piece.replace(" ", self.letters[32]) if piece.isascii() and piece.isprintable() else "".join([self.letters[b] for b in piece.encode()])
            ids = pack([t.id for t in self.model.tokenize(letters)])
        if len(piece) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self.tokenizer)

    def encode(self, text: str) -> bytes:
        if COMMON.fullmatch(text) is None or any(s in text for s in self.special):
            return pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each Python worker: its memory of pre-tokens serves all the worker's tasks."""
    return Encoder(path)
