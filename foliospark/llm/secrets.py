"""Secret scans by a trigram inverted index.

Each rule's regex gives a Boolean trigram query. A block of documents (one Arrow step) gets an inverted index of the
trigrams that the queries name; postings are united and intersected to candidates, and only these are matched against
the regex. Rules without mandatory trigrams match every document. Blocks are independent: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import trigrams
from .arrow import map_batches, steps, texts
from .common import table


@dataclass(frozen=True)
class Rule:
    """kind; regex over UTF-8 bytes; a match counts if `group` has at least `least` bytes. A match that is too short
    still takes its place, so later matches don't start inside it."""

    kind: str
    pattern: bytes
    flags: int = 0
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE, 2, 6),
    Rule("access", rb"AKIA[A-Z0-9]+", 0, 0, 20),
    Rule("hex", rb"[0-9a-f]{24,}"),
)
MORE = (
    # to the END line before another BEGIN; without one, the lines of base64 that follow
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/=]{16,})*(?:\s+[A-Za-z0-9+/]+={1,2})?)"),
    Rule("code_host", rb"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_app", rb"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("cloud_api", rb"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", rb"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]+:[^\s:/@]+@"),
)
RULES = BASE + MORE
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class Scanner:
    def __init__(self, rules=RULES):
        self.rules = [(i, r, re.compile(r.pattern, r.flags), trigrams.query(r.pattern, r.flags)) for i, r in enumerate(rules)]
        self.index = trigrams.Index(set().union(*(trigrams.leaves(q) for *_, q in self.rules)))

    def scan(self, values: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, rule number, end) in code points, in order."""
        flat = np.frombuffer(b"".join(values), np.uint8)
        ends = np.cumsum([len(v) for v in values])
        postings = self.index.build(flat, ends)
        out: list[list[tuple[int, int, int]]] = [[] for _ in values]
        for i, rule, regex, q in self.rules:
            for k in self.index.search(q, postings, len(values)):
                v = values[k]
                out[k] += [(m.start(), i, m.end()) for m in regex.finditer(v) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        for k, spans in enumerate(out):
            if spans:
                spans.sort()
                if not values[k].isascii():
                    at = np.frombuffer(values[k], np.uint8)
                    points = np.concatenate([[0], np.cumsum((at & 0xC0) != 0x80)])
                    out[k] = [(int(points[s]), i, int(points[e])) for s, i, e in spans]
        return out


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, spans: array of (kind, start, end) by start, then in the rules' order. One row per row of docs; null or
    empty texts have no spans; other columns aren't read. Matches of one rule don't overlap, those of two rules may."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("spans", SPANS)])

    def make():
        scanner, kinds = Scanner(rules), [r.kind for r in rules]

        def step(batch):
            found = scanner.scan(batch.column(1).to_pylist())
            spans = pa.array([[{"kind": kinds[i], "start": s, "end": e} for s, i, e in x] for x in found], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            return [batch.column(0), spans]

        return step

    return map_batches(texts(docs), make, schema)


def digest(docs: DataFrame, rules=RULES) -> DataFrame:
    """The contract's columns of scan(): counts of the base kinds, a digest of their spans, and all spans as one string."""
    types = {"doc_id": docs.schema["doc_id"].dataType, "n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "base_sha256": T.StringType(), "spans": T.StringType()}
    schema = T.StructType([T.StructField(k, v) for k, v in types.items()])

    def make():
        scanner, kinds, base = Scanner(rules), [r.kind for r in rules], [[r.kind for r in rules].index(r.kind) for r in BASE]

        def step(batch):
            found = scanner.scan(batch.column(1).to_pylist())
            join = lambda x: ",".join(f"{kinds[i]}:{s}:{e}" for s, i, e in x)
            sha = [hashlib.sha256(join(y for y in x if y[1] in base).encode()).hexdigest() for x in found]
            counts = [pa.array([sum(y[1] == k for y in x) for x in found], pa.int64()) for k in base]
            return [batch.column(0), *counts, pa.array(sha), pa.array([join(x) for x in found])]

        return step

    return map_batches(texts(docs), make, schema)


def redact(docs: DataFrame, rules=RULES) -> DataFrame:
    """docs with every span replaced by [kind] (overlapping spans by the kind that starts first) and n_chars, if there,
    counted anew for changed texts. All columns stay; null texts stay null."""
    names = docs.columns

    def run(batches):
        scanner, kinds, at = Scanner(rules), [r.kind for r in rules], names.index("text")
        for batch in (part for whole in batches for part in steps(whole, at)):
            new = batch.column(at).to_pylist()
            counts = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
            for k, spans in enumerate(scanner.scan([(v or "").encode() for v in new])):
                if spans:
                    out, last = [], 0
                    for s, i, e in spans:
                        if s >= last:
                            out += [new[k][last:s], f"[{kinds[i]}]"]
                        last = max(last, e)
                    new[k] = "".join([*out, new[k][last:]])
                    if counts:
                        counts[k] = len(new[k])
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            if counts:
                j = names.index("n_chars")
                arrays[j] = pa.array(counts, batch.schema.field(j).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op4_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
