"""The pipeline against its stages in plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

import corpus_pipeline
from foliospark.llm import packing, quality, secrets

from .test_operators import brute_fp, components

DIR = "/root/testdata/sf0.001"


def base_ok(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    g = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if g[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(w) >= quality.MIN_WORDS and 100 * len(hit) <= 20 * len(w)


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, DIR).columns == docs.columns
    table = pq.read_table(f"{DIR}/documents.parquet").to_pydict()
    texts = {i: t for i, t in sorted(zip(table["doc_id"], table["text"], strict=True)) if base_ok(t)}
    assert all(v.host_ok for v in quality.host_verdicts(quality.rules(docs)).collect())
    fp = {i: brute_fp(t) for i, t in texts.items()}
    comp = components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    texts = {i: t for i, t in texts.items() if comp[i] == i}
    seen, scanner = set(), secrets.Scanner()
    for i, t in texts.items():
        b = t.encode()
        mask = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                mask[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        t = bytes(c for c, m in zip(b, mask, strict=True) if not m).decode(errors="ignore")
        out, last = [], 0
        for s, k, e in scanner.scan([t.encode()])[0]:
            if s >= last:
                out += [t[last:s], f"[{secrets.RULES[k].kind}]"]
            last = max(last, e)
        texts[i] = "".join([*out, t[last:]])
    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    rows = corpus_pipeline.run(spark, DIR).collect()
    assert {r.doc_id for r in rows} == set(want)
    for r in rows:
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
