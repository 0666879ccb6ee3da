"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can't be merged over, so a text may be cut there for certain. The
cuts of a whole block are found by one table look-up per byte; the fragments between them are encoded independently,
each distinct one once, and their ids concatenated. Used cuts: before white space, and between printable ASCII bytes
of a forced pair. A cut inside a run of letters or of symbols doesn't end a word, so its left fragment is encoded
without the word-end mark. Texts with characters beyond Latin and common punctuation, or with a special token, go to
the library whole.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .arrow import map_batches, texts
from .common import table
from .tokens import byte_alphabet, pack

#: Characters that NFC leaves alone, whose lower case is one character, and whose class is known.
COMMON = re.compile(r"[\t\n\r -~\xa0-\u012f\u0131-\u01c3\u2013\u2014\u2018-\u201d\u2022\u2026]*")
#: Distinct fragments in each of two generations that are remembered.
CACHE_ENTRIES = 150_000
OPEN = b"\x01"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_table(tokens, suffix: str) -> np.ndarray:
    """For each byte pair 0 (no cut), 1 (cut, and a word ends there) or 2 (cut inside a run)."""
    alphabet = byte_alphabet()
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        t = t.removesuffix(suffix)
        b = [alphabet.get(c) for c in t]
        for x, y in zip(b, b[1:], strict=False):
            if x is not None and y is not None:
                inside[x, y] = True
    kind = np.zeros(256, np.int8)  # 1 letter, 2 digit, 3 symbol, 4 white space, 0 not used
    for c in range(33, 127):
        kind[c] = 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3
    kind[[9, 10, 13, 32]] = 4
    out = np.zeros((256, 256), np.uint8)
    a, b = kind[:, None], kind[None, :]
    known = (a > 0) & (b > 0) & (a < 4) & (b < 4) & ~inside
    out[known & ((a != b) | (a == 2))] = 1
    out[known & (a == b) & (a != 2)] = 2
    out[:, 39][(kind == 3)] = 0  # what follows an apostrophe after a symbol depends on that symbol
    out[39, :] = 0  # and an apostrophe's own end on what follows
    out[np.ix_(kind != 4, kind == 4)] = 1
    return out.ravel()


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        import json

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        model = json.loads(self.tokenizer.to_str())["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.closed = self.tokenizer.model
        self.open = models.BPE(vocab=model["vocab"], merges=merges)
        self.names = {i: t for t, i in self.tokenizer.get_vocab().items()}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = cut_table(model["vocab"], model["end_of_word_suffix"])
        self.ids, self.text = _Fragments(self, 0), _Fragments(self, 1)

    def fragment(self, key: bytes) -> tuple[bytes, bytes]:
        """Packed ids and decoded text of a lower-cased fragment; a last byte OPEN says that its word goes on."""
        goes_on = key.endswith(OPEN)
        bare = key[:-1] if goes_on else key
        if (word := bare.strip(b" \n\r\t")).isalpha():  # one word of ASCII letters, which stand for themselves
            words = [word.decode()]
        else:
            words = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(bare.decode())]
        found = [t for i, w in enumerate(words) for t in (self.open if goes_on and i == len(words) - 1 else self.closed).tokenize(w)]
        return pack(t.id for t in found), " ".join(self.names[t.id] for t in found).encode()

    def whole(self, text: str) -> tuple[bytes, bytes]:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(ids), self.tokenizer.decode(ids, skip_special_tokens=False).encode()

    def encode(self, values: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids and decoded text of each value."""
        out: list = [None] * len(values)
        plain = []
        for i, v in enumerate(values):
            if COMMON.fullmatch(v) is None or any(s in v for s in self.special):
                out[i] = self.whole(v)
            else:
                plain.append(i)
        if not plain:
            return out
        parts = [b"\n" + values[i].lower().encode() for i in plain]
        buf = b"".join(parts)
        flat = np.frombuffer(buf, np.uint8)
        kind = self.cuts[flat[:-1].astype(np.uint16) * np.uint16(256) + flat[1:]] if len(flat) > 1 else np.zeros(0, np.uint8)
        starts = np.cumsum([0] + [len(p) for p in parts])
        kind[starts[1:-1] - 1] = 1
        at = np.flatnonzero(kind) + 1
        goes_on = np.flatnonzero(kind[at - 1] == 2)
        edges = [0, *at.tolist(), len(buf)]
        fragments = [buf[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        for k in goes_on.tolist():
            fragments[k] += OPEN
        bounds = np.searchsorted(np.asarray(edges), starts).tolist()
        for memory in (self.ids, self.text):
            memory.age()
        ids, text = self.ids, self.text
        for i, a, b in zip(plain, bounds, bounds[1:], strict=False):
            own = fragments[a:b]
            packed = b"".join(map(ids.__getitem__, own))
            out[i] = packed, b" ".join(filter(None, map(text.__getitem__, own)))
        return out


class _Fragments(dict):
    """Fragment -> packed ids (which 0) or decoded text (which 1), in two generations."""

    def __init__(self, encoder: Encoder, which: int):
        super().__init__()
        self.encoder, self.which, self.older = encoder, which, {}

    def age(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key: bytes) -> bytes:
        value = self.older.get(key)
        if value is None:
            both = self.encoder.fragment(key)
            value = both[self.which]
            if not self.which:
                self.encoder.text[key] = both[1]
        self[key] = value
        return value


@functools.lru_cache(2)
def encoder_of(path: str) -> Encoder:
    """One for each Python worker: its memory of fragments serves all the worker's tasks."""
    return Encoder(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian 32-bit), decoded. One row per row of docs; null texts are empty."""
    return _run(docs, path, {"n_tokens": T.LongType(), "ids": T.BinaryType(), "decoded": T.StringType()}, lambda x: [pa.array([len(i) // 4 for i, _ in x], pa.int64()), pa.array([i for i, _ in x], pa.binary()), pa.array([d.decode() for _, d in x])])


def _run(docs: DataFrame, path: str | None, types: dict, columns) -> DataFrame:
    path = path or default_tokenizer()
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(k, v) for k, v in types.items())])

    def make():
        encoder = encoder_of(path)
        return lambda batch: [batch.column(0), *columns(encoder.encode([t.decode() for t in batch.column(1).to_pylist()]))]

    return map_batches(texts(docs), make, schema)


def op9_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = lambda values: pa.array([hashlib.sha256(v).hexdigest() for v in values])
    types = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return _run(table(spark, sf_dir, "documents"), None, types, lambda x: [pa.array([len(i) // 4 for i, _ in x], pa.int64()), sha([i for i, _ in x]), sha([d for _, d in x])])
