"""Boolean trigram queries from regular expressions, and a block's inverted index (Cox, 2012).

A query is None (every text may match), a trigram (bytes of length 3), ("and", [...]) or ("or", [...]). Queries are
over texts with A-Z lower-cased, so they serve patterns with and without IGNORECASE.
"""

from __future__ import annotations

import re._parser as parser
from re._constants import ASSERT, AT, BRANCH, IN, LITERAL, MAX_REPEAT, MIN_REPEAT, NEGATE, RANGE, SUBPATTERN

import numpy as np

#: More alternatives than this are not told apart; the query then only gets weaker.
MAX_STRINGS = 32


def _and(parts):
    parts = [p for p in parts if p is not None]
    flat = [x for p in parts for x in (p[1] if isinstance(p, tuple) and p[0] == "and" else [p])]
    flat = list(dict.fromkeys(_key(x) for x in flat))
    return None if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _or(parts):
    parts = list(dict.fromkeys(_key(p) for p in parts))
    return None if not parts or None in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _key(q):
    return (q[0], tuple(q[1])) if isinstance(q, tuple) else q


def _of_string(s: bytes):
    return _and([s[i : i + 3] for i in range(len(s) - 2)])


def _of_strings(strings):
    return _or([_of_string(s) for s in strings])


def _chars(items) -> set[bytes] | None:
    out: set[bytes] = set()
    for op, arg in items:
        if op is LITERAL and arg < 128:
            out.add(bytes([arg]).lower())
        elif op is RANGE and arg[1] < 128:
            out |= {bytes([c]).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
        if len(out) > MAX_STRINGS:
            return None
    return None if any(op is NEGATE for op, _ in items) else out


def _walk(tree) -> tuple[list[set[bytes] | None], list]:
    """The pattern as a row of string sets (None: a gap of anything), and queries that hold besides."""
    row: list[set[bytes] | None] = []
    more: list = []
    for op, arg in tree:
        if op is LITERAL:
            row.append({bytes([arg]).lower()} if arg < 128 else None)
        elif op is IN:
            row.append(_chars(arg))
        elif op is SUBPATTERN:
            r, m = _walk(arg[3])
            row += r
            more += m
        elif op is BRANCH:
            sides = [_walk(x) for x in arg[1]]
            exact = [_exact(r) for r, _ in sides]
            if all(e is not None for e in exact) and len(u := set().union(*exact)) <= MAX_STRINGS:
                row.append(u)
            else:
                row.append(None)
                more.append(_or([_and([_row_query(r), *m]) for r, m in sides]))
        elif op in (MAX_REPEAT, MIN_REPEAT):
            low, high, body = arg
            r, m = _walk(body)
            e = _exact(r)
            if e is not None and (low, high) == (0, 1):
                row.append(e | {b""})
            elif low >= 1:
                row += (r * int(low) if e is not None and low <= 8 else r) if e is not None and low == high else [*r, None]
                more += m
            else:
                row.append(None)
        elif op in (AT, ASSERT):
            continue
        else:
            row.append(None)
    return row, more


def _exact(row) -> set[bytes] | None:
    out = {b""}
    for s in row:
        if s is None or len(out) * len(s) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _row_query(row):
    parts, run = [], {b""}
    for s in [*row, None]:
        if s is not None and len(run) * len(s) <= MAX_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        parts.append(_of_strings(sorted(run)))
        run = s if s is not None else {b""}
    parts.append(_of_strings(sorted(run)))
    return _and(parts)


def query(pattern: bytes, flags: int = 0):
    """The strongest query found that every match's text must satisfy; None where no trigram is mandatory."""
    row, more = _walk(parser.parse(pattern, flags))
    return _and([_row_query(row), *more])


def leaves(q) -> set[bytes]:
    return set() if q is None else {q} if isinstance(q, bytes) else set().union(*(leaves(x) for x in q[1]))


class Index:
    """Postings of the wanted trigrams over a block of texts: trigram -> sorted text numbers."""

    def __init__(self, wanted: set[bytes]):
        self.codes = {t: int.from_bytes(t, "big") for t in wanted}
        self.listed = np.zeros(1 << 24, bool)
        self.listed[list(self.codes.values())] = True

    def build(self, flat: np.ndarray, ends: np.ndarray) -> dict[bytes, np.ndarray]:
        """flat: the texts' bytes one after another; ends: where each text ends there. Trigrams don't cross texts."""
        low = flat + ((flat >= 65) & (flat <= 90)).astype(np.uint8) * np.uint8(32)
        if len(low) < 3:
            return {t: np.empty(0, np.int64) for t in self.codes}
        code = (low[:-2].astype(np.uint32) << 16) | (low[1:-1].astype(np.uint32) << 8) | low[2:]
        at = np.flatnonzero(self.listed[code])
        text = np.searchsorted(ends, at, side="right")
        inside = at + 3 <= ends[text]
        at, text = at[inside], text[inside]
        found = code[at]
        return {t: np.unique(text[found == c]) for t, c in self.codes.items()}

    @staticmethod
    def search(q, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if q is None:
            return np.arange(n)
        if isinstance(q, bytes):
            return postings[q]
        each = [Index.search(x, postings, n) for x in q[1]]
        out = each[0]
        for x in each[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if q[0] == "and" else np.union1d(out, x)
        return out
