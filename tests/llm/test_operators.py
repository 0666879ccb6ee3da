"""Operators against plain Python on small rows: nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import bpe, common, hnsw, licenses, minhash, packing, preference, quality, registry, secrets, simhash, suffixes, tokens, trigrams

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, texts, first=0):
    rows = [(first + i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [words(rng, rng.randrange(1, 120)) + "." for _ in range(60)]
    passage = words(rng, 70) + ". " + words(rng, 30) + "."
    near = base[3].replace("w1", "v1", 1)
    out = [*base, base[3], base[3], near, base[7] + "\n" + passage, base[8] + " " + passage + " " + base[9], None, "", "   \n\t", "é" * 150 + "à" * 150, "x" + "é" * 150, "ab" * 300, "the the the " * 80]
    return out + [words(rng, 9000)]


def brute_suffix(texts, n=100):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        mask = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if b[p : p + n] in seen:
                mask[p : p + n] = b"\1" * n
            else:
                seen.add(b[p : p + n])
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        out[i] = (len(b), sum(mask), spans, hashlib.sha256(bytes(c for c, m in zip(b, mask, strict=True) if not m)).hexdigest())
    return out


def test_suffixes_match_brute_force(spark, corpus):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(make(spark, corpus)).collect()}
    assert got == brute_suffix(corpus)
    assert sum(x[1] for x in got.values()) > 500


def test_suffix_strip_keeps_columns_and_clean_texts(spark, corpus):
    docs = make(spark, corpus).withColumnRenamed("lang", "spans")
    out = {r.doc_id: r for r in suffixes.strip(docs).collect()}
    assert suffixes.strip(docs).columns == docs.columns and len(out) == len(corpus)
    assert out[0].text == corpus[0] and out[60].text == "" if len(corpus[3]) >= 100 else True
    assert out[65].text is None


def test_suffixes_of_repeated_rows(spark):
    rng = random.Random(21)
    a, c = words(rng, 120, 9000), words(rng, 120, 9000)
    texts = [a, "x " + a[60:140] + " y" + words(rng, 30, 9000), "z " + a[200:360] + " z", c, c]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([r for r in rows for _ in range(1 + 2 * (r[0] in (0, 2)))], DOC)
    want = brute_suffix(texts)
    assert want[0][1] == want[1][1] == 0 < want[2][1]
    got = suffixes.removed(docs).collect()
    assert len(got) == 9 and {tuple(r) for r in got} == {(i, *v) for i, v in want.items()}
    kept = {(r.doc_id, r.text) for r in suffixes.strip(docs).collect()}
    assert (0, a) in kept and len(kept) == len(texts)


def test_suffixes_in_small_batches_and_periodic_texts(spark, monkeypatch):
    """Groups that cross Arrow batches and steps; texts in which a seed comes back; partial overlaps at every offset."""
    rng = random.Random(22)
    base = words(rng, 90, 10**6)
    texts = [base[i : i + rng.randrange(100, 400)] for i in range(0, 300, 7)] + ["ab" * 200, "c" * 150 + "ab" * 90, "xyz" * 70 + base[:120] + "xyz" * 70, base[50:149], base[50:150], base[:40] * 12, base[3:40] * 9]
    texts += [f"{base[:100]}{i}{base[100:260]}" for i in range(80)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(suffixes, "STEP", 900)
    try:
        rows = suffixes.removed(make(spark, texts).withColumn("k", F.lit(1)).withColumn("spans", F.lit(1)).withColumn("rank", F.lit(1))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == brute_suffix(texts)


def test_suffixes_of_texts_beyond_one_step(spark):
    rng = random.Random(23)
    long = words(rng, 170_000, 10**6)
    assert len(long) > suffixes.STEP
    rows = suffixes.removed(make(spark, [long, long[700_000:700_400], long[:90]])).collect()
    assert [r.n_removed for r in sorted(rows, key=lambda r: r.doc_id)] == [0, 400, 0]


def brute_fp(t):
    low = "".join(c.lower() if c.isascii() else c for c in (t or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_matches_brute_force(spark, corpus):
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.classes(make(spark, corpus)).collect()}
    fp = {i: brute_fp(t) for i, t in enumerate(corpus)}
    comp = components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    assert got == {i: (fp[i], comp[i]) for i in fp}


def test_gray_index_finds_every_link():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 300, np.uint64)
    code = np.concatenate([centre, *(centre ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) for _ in range(6))])
    group = rng.integers(0, 3, len(code))
    order = np.lexsort((simhash.gray_rank(code), group))
    code, group = code[order], group[order]
    lab = simhash.linked(group, code)
    want = components(range(len(code)), [(a, b) for a in range(len(code)) for b in np.flatnonzero((np.bitwise_count(code ^ code[a]) <= 3) & (group == group[a])) if a < b])
    assert lab.tolist() == [want[i] for i in range(len(code))]


def test_views_lose_no_link(spark, monkeypatch):
    """Every top level, dealt blocks and small Arrow batches give the same classes."""
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 60, np.uint64)
    code = centre
    for _ in range(3):
        code = np.unique(np.concatenate([code, *(code ^ (np.uint64(1) << rng.integers(0, 64, len(code)).astype(np.uint64)) for _ in range(2))]))
    code = rng.permutation(code)[:700]
    want = components(range(len(code)), [(a, int(b)) for a in range(len(code)) for b in np.flatnonzero(np.bitwise_count(code ^ code[a]) <= 3) if a < b])
    rows = spark.createDataFrame([(int(c.view(np.int64)), i) for i, c in enumerate(code)], "fp long, rep long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        for parts, block in ((4, 8192), (4, 5), (5, 8192), (6, 2)):
            monkeypatch.setattr(simhash, "BLOCK", block)
            monkeypatch.setattr(simhash, "parts_for", lambda n, node=64, p=parts: p)
            got = {r.node: r.component for r in common.components(simhash.links(rows)).collect()}
            assert {i: got.get(i, i) for i in range(len(code))} == want, (parts, block)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.undo()
    assert [simhash.parts_for(n) for n in (1, 1 << 22, 1 << 23, 1 << 31, 1 << 33, 1 << 39)] == [4, 4, 5, 5, 6, 7]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, k) for k in range(2, 40)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == components(nodes, edges)
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_paragraphs(text, least=10):
    """(start, end, words) of each paragraph: sentences of a line, short ones joined to the short ones after them."""
    out = []
    for line in re.finditer(r"[^\n]+", text or ""):
        w = [(m[0], line.start() + m.start(), line.start() + m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", line[0])]
        sentences, now = [], []
        for k, x in enumerate(w):
            now.append(x)
            if k + 1 == len(w) or (x[0][-1] in ".!?" and not re.match("[a-z]", w[k + 1][0])):
                sentences.append(now)
                now = []
        held = []
        for s in sentences:
            if held and len(s) >= least:
                out.append(held)
                held = []
            held = held + s
            if len(held) >= least:
                out.append(held)
                held = []
        out += [held] if held else []
    return [(x[0][1], x[-1][2], ["".join(c.lower() if c.isascii() else c for c in t) for t, _, _ in x]) for x in out]


def brute_repeated(texts, min_run):
    units = {(d, n): x for d, t in enumerate(texts) for n, x in enumerate(brute_paragraphs(t))}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, (_, _, w) in units.items()}
    keys = list(units)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if units[a][2] == units[b][2] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    comp = components(keys, links)
    size = Counter(comp.values())
    out, run = {}, []
    for k in [*sorted(keys), (-1, -1)]:
        if run and (k != (run[-1][0], run[-1][1] + 1) or size[comp[k]] < 2):
            if sum(len(units[x][2]) for x in run) >= min_run:
                out |= {x: (*units[x][:2], len(units[x][2]), *comp[x], x != comp[x]) for x in run}
            run = []
        if k in comp and size[comp[k]] > 1:
            run.append(k)
    return out


@pytest.mark.parametrize("settings", [{}, {"min_run_words": 0}])
def test_paragraphs_match_brute_force(spark, settings):
    rng = random.Random(11)
    say = lambda n: words(rng, n, 5000)
    base = [". ".join(say(rng.randrange(2, 40)).capitalize() for _ in range(rng.randrange(1, 5))) + "." for _ in range(40)]
    texts = ["\n".join(rng.sample(base, 5)) for _ in range(30)]
    long = [say(60) for _ in range(20)]
    texts += [x + "\n" + say(40) for x in long]
    for x in long:  # one word of a paragraph changed
        w = x.split()
        w[rng.randrange(len(w))] = "other"
        texts.append(" ".join(w).upper() + "\n" + say(40))
    texts += [None, "", " \n\t", "short", "é à", base[0] + "\n" + base[0], "a b.\n" * 12]
    assert max(len(w) for t in texts for _, _, w in brute_paragraphs(t)) < minhash.CHUNK * 2
    got = {(r.doc_id, r.paragraph): tuple(r)[2:] for r in minhash.repeated(make(spark, texts), **settings).collect() if r.paragraph < len(brute_paragraphs(texts[r.doc_id]))}
    assert got == brute_repeated(texts, settings.get("min_run_words", minhash.MIN_RUN_WORDS))
    assert any(not r[-1] for r in got.values()) and any(r[0] in {t + 50 for t in range(20)} for r in got)


def test_paragraphs_of_repeated_rows_and_long_texts(spark):
    rng = random.Random(12)
    once, twice, long = words(rng, 60, 9000), words(rng, 60, 9000), words(rng, 300_000, 10**6)
    docs = make(spark, [once, twice, "x " + twice, long, long[1_200_000:1_201_000], None])
    wide = docs.union(docs).withColumn("fp", docs.lang).withColumn("word", docs.lang).withColumn("paragraph", docs.lang)
    rows = minhash.repeated(wide.union(wide.where("false"))).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4} and len(rows) == len({(r.doc_id, r.paragraph) for r in rows})
    assert len(long) > 2 * minhash.STEP


def test_hot_groups_around_pivots(spark, monkeypatch):
    """Crowds near one pivot, chains that lead away from it, and sets like no other: the components of all links."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(31)
    sets = {}
    for c in range(3):
        s = [1000 * c + k for k in range(40)]
        for step in range(30):  # each a little further from the first
            sets[len(sets)] = sorted(s)
            if step % 2:
                s = [*s[2:], 1000 * c + 500 + 2 * step, 1000 * c + 501 + 2 * step]
            else:
                sets[len(sets)] = sorted([*s[:-1], 10**6 + len(sets)])
    for _ in range(40):
        sets[len(sets)] = sorted(rng.sample(range(10**7), 30))
    ids = rng.sample(range(-1000, 1000), len(sets))
    sets = dict(zip(ids, sets.values(), strict=True))
    rows = spark.createDataFrame([(7, i, v) for i, v in sets.items()], "band long, fp long, shingles array<long>")
    got = common.components(minhash._links(rows.select("band", "fp"), rows.select("fp", "shingles"), 0.8))
    links = [(a, b) for a in sets for b in sets if a < b and 10 * len(set(sets[a]) & set(sets[b])) >= 8 * len(set(sets[a]) | set(sets[b]))]
    want = components(sets, links)
    assert {i: want[i] for i in sets} == {i: i for i in sets} | {r.node: r.component for r in got.collect()} and len(set(want.values())) < len(sets) / 2


def test_small_groups_are_compared_like_large_ones():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 40, 30)) for _ in range(400)]
    group = np.sort(rng.integers(0, 90, 400))
    i, j = minhash.similar_in_groups(group, np.array([len(s) for s in sets]), np.concatenate(sets), 0.5)
    s = [set(x.tolist()) for x in sets]
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(a, b) for a in range(400) for b in range(a + 1, 400) if group[a] == group[b] and len(s[a] & s[b]) >= 0.5 * len(s[a] | s[b])]


def test_hot_buckets_in_blocks_and_batches(spark, monkeypatch):
    """More near copies than one block or one Arrow batch holds."""
    monkeypatch.setattr(minhash, "BLOCK", 64)
    rng = random.Random(13)
    w = words(rng, 80, 9000).split()
    texts = [" ".join([*w[:i], "odd", *w[i:]][:80]) + f"\n{words(rng, 30, 10**6)}" for i in range(1, 60) for _ in range(5)] + [words(rng, 80, 9000) for _ in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(r.doc_id, r.paragraph): tuple(r)[2:] for r in minhash.repeated(make(spark, texts)).collect() if r.paragraph < len(brute_paragraphs(texts[r.doc_id]))}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_repeated(texts, minhash.MIN_RUN_WORDS) and len(got) >= 295


def test_passages_without_whole_paragraphs(spark):
    rng = random.Random(17)
    say = lambda n: words(rng, n, 10**6)
    short = ". ".join(f"S{say(4)}" for _ in range(14)) + "."
    inside, tail = say(51), say(20)
    texts = [short, short, say(80) + " " + inside + " " + say(80), say(33) + " " + inside.upper() + "\n" + say(70), "ok then", "ok then", tail + " " + say(70), tail + " " + say(60), say(200), "same " * 400, None, ""]
    rows = minhash.repeated(make(spark, texts)).collect()
    assert {r.doc_id for r in rows} == {0, 1, 2, 3, 4, 5, 9}
    assert len(rows) == len({(r.doc_id, r.paragraph) for r in rows})
    for r in rows:
        assert len(texts[r.doc_id][r.start : r.end].split()) == r.n_words
        if r.doc_id in (2, 3):
            assert texts[r.doc_id][r.start : r.end].lower() in inside and r.keeper_doc_id == 2
    assert sum(r.n_words for r in rows if r.doc_id == 9) <= 2 * 400


def test_similar_in_blocks():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 30)) for _ in range(80)]
    i, j = minhash.similar(sets, 0.5)
    s = [set(x.tolist()) for x in sets]
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a in range(80) for b in range(a + 1, 80) if len(s[a] & s[b]) >= 0.5 * len(s[a] | s[b])}


def test_trigram_queries():
    q = trigrams.query(rb"AKIA[A-Z0-9]+")
    assert trigrams.leaves(q) == {b"aki", b"kia"}
    assert trigrams.query(rb"[0-9a-f]{24,}") is None
    assert trigrams.query(rb"(abc|xy).*") is None


SECRET = ["PASSWORD = 'abcdef' passwd:abc secret==tokenX api_key=\"abcdef1\" APIKEY:abcdefgh", "é" + "AKIA" + "Z" * 16 + " é " + "a" * 24 + " AKIAZZ", None, "", "toKen=abcdefg tok", "x" * 5000 + " token: ABCDEFGH", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18, "password=password=abcdefg"]


def test_secrets_match_a_full_scan(spark):
    either = "".join
    key = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    assign = re.compile(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    rows = {r.doc_id: r for r in secrets.digest(make(spark, SECRET)).collect()}
    for i, t in enumerate(SECRET):
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 6] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        said = either(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)))
        r = rows[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in found) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert {x for x in r.spans.split(",") if x.startswith(("assign", "access", "hex"))} == {x for x in said.split(",") if x}
    assert "private_key" in rows[6].spans and "code_host" in rows[6].spans


def test_redaction(spark):
    docs = make(spark, SECRET).withColumnRenamed("lang", "kind")
    out = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert out[2].text is None and out[3].text == "" and "AKIAZZZ" not in out[1].text and out[1].text.endswith(" AKIAZZ")
    assert out[1].n_chars == len(out[1].text)


def test_whole_keys_and_long_logins():
    body = "\n".join("Ab1/" * 16 for _ in range(5)) + "\nQ2+x=="
    key = f"-----BEGIN RSA PRIVATE KEY-----\nDEK-Info: AES-128-CBC,00\n\n{body}\n-----END RSA PRIVATE KEY-----"
    cut, login = f"-----BEGIN PRIVATE KEY-----\n{body}", "https://" + "u" * 90 + ":" + "t" * 300 + "@"
    texts = [f"a {key} b", f"{cut}\nplain words here", f"{cut}\nmore {key}", f"see {login}host/x"]
    kinds = [r.kind for r in secrets.RULES]
    found = [[t[s:e] for s, i, e in x if kinds[i] in ("private_key", "url_login")] for t, x in zip(texts, secrets.Scanner().scan([t.encode() for t in texts]), strict=True)]
    assert found == [[key], [cut], [cut, key], [login]]


TOKENS = ["", None, "  a  b ", "don't 'tis ,'s ''s x's'd", "İstanbul ſ ΑΣ", "emoji 😀 ok", "a<|endoftext|>b", "Qz qzjq 12 3a4 a1?!(?'re) ...  x  y", "ÀÉx", "tab\t\ttab \r\n x", "日本語 text", "zz" * 3000, "x\x1cy\x00z", "\n\n\n", "a — b’s"]


def test_byte_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    t, e = Tokenizer.from_file(path), tokens.Encoder(path)
    for x in TOKENS:
        assert np.frombuffer(e.encode(x or ""), "<u4").tolist() == t.encode(x or "", add_special_tokens=False).ids


def test_forced_boundaries_are_the_librarys(spark, corpus):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_tokenizer())
    texts = [*TOKENS, *corpus]
    got = {r.doc_id: r for r in bpe.encode(make(spark, texts)).collect()}
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == t.decode(ids, skip_special_tokens=False)


def test_cuts_are_inside_no_token():
    e = bpe.Encoder(bpe.default_tokenizer())
    own, table = bpe.byte_alphabet(), e.cuts.reshape(256, 256)
    inside = {(own[a], own[b]) for n in e.tokenizer.get_vocab() if not n.startswith("<|") for n in [n.removesuffix("</w>")] for a, b in zip(n, n[1:], strict=False)}
    assert not [p for p in inside if table[p]]


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    rows = packing.pack(make(spark, corpus).repartition(3), keep_ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
    for i, x in enumerate(corpus):
        parts = sorted(by_doc[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist()
        assert ids == [*t.encode(x or "", add_special_tokens=False).ids, 1] and parts[0].doc_tokens == len(ids)
    for s, parts in by_seq.items():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert sum(r.length for r in parts) == packing.LENGTH or s == max(by_seq)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 24))
    x = np.concatenate([x, np.repeat(x[:1], 40, 0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] + [1.0] * 23), (5060, [None] + [1.0] * 23)]
    df = hnsw.valid(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = defaultdict(list)
    for r in hnsw.nearest(df, df.where("vec_id % 20 = 0"), shard_size=1000).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, len(x), 20):
        score = x @ x[q]
        order = [int(i) for i in np.lexsort((np.arange(len(x)), -np.round(score, 9))) if i != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and q not in [v for _, v, _ in mine]
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(order))
    assert hits / (20 * len(range(0, len(x), 20))) >= 0.9
    assert [v for _, v, _ in sorted(got[0])][:5] == [3000, 3001, 3002, 3003, 3004]  # copies, smallest ids first
    assert hnsw.nearest(df.where("false"), df).count() == 0


@pytest.mark.parametrize("kind", ["normal", "varied", "unit", "wide"])
def test_recall_of_the_registered_settings(kind):
    """A shard of the registered size against brute force, also where lengths differ."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(hnsw.SHARD, 128 if kind == "wide" else 64))
    x *= rng.lognormal(0, 0.6, (len(x), 1)) if kind == "varied" else 1
    x /= np.linalg.norm(x, axis=1, keepdims=True) if kind == "unit" else 1
    graphs = [hnsw.Graph(hnsw.Graph.make(x[own]) | {"members": [[int(i)] for i in own]}, x.shape[1]) for own in hnsw.length_ranges(np.linalg.norm(x, axis=1))]
    asked = rng.choice(len(x), 100, False).tolist()
    best = [[] for _ in asked]
    for g in graphs:
        g.nearest(asked, x[asked], best, hnsw.TOP, hnsw.BEAM)
    score = x[asked] @ x.T
    score[np.arange(100), asked] = -np.inf
    true = np.argsort(-score, 1)[:, : hnsw.TOP]
    assert np.mean([len({-v for _, v in b} & set(t.tolist())) for b, t in zip(best, true, strict=True)]) >= 0.95 * hnsw.TOP


def test_every_node_can_be_reached():
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(300, 4)) * 1e-3 + c for c in rng.normal(size=(9, 4)) * 50]).astype(np.float32)
    layers = hnsw.build(x, degree=4, beam=8)
    nodes, nb = layers[-1]
    full = np.empty_like(nb)
    full[nodes] = nb
    seen, front = set(), {int(layers[0][0][0])}
    while front:
        seen |= front
        front = {int(v) for k in front for v in full[k] if v >= 0} - seen
    assert len(seen) == len(x)


def test_vectors_of_any_size_and_length(spark):
    big = [3e200, -1.0, 2.0]
    rows = [(0, big), (20, [1.0, 0.0]), (1, [2.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [-1e-200, 0.0, 5.0]), (3, [0.0, 1e307, 1e307])]
    df = hnsw.valid(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("r", F.lit(1)), "vec_id", "embedding")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in hnsw.nearest(df, df.where("vec_id % 20 = 0")).collect()}
    assert got == {(20, 1): (0, 3e200), (20, 2): (1, 2.0), (20, 3): (3, 0.0), (20, 4): (2, -1e-200), (0, 1): (3, 1e307), (0, 2): (1, 6e200), (0, 3): (20, 3e200), (0, 4): (2, -3.0 + 10.0)}


def rule_table(spark, corpus):
    docs = make(spark, [*corpus, "### $$$ %%% a b c d e f g h", "one two three four five six seven eight nine ten"])
    pdf = docs.toPandas()  # noqa: F841  DuckDB reads it by name
    con = duckdb.connect()
    con.register("documents", pdf)
    return docs, con


def test_quality_sql(spark, corpus):
    docs, con = rule_table(spark, corpus)
    got = sorted(map(tuple, quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()))
    assert got == sorted(con.execute(quality.SQL).fetchall())
    kept = {r[0] for r in got if r[-1]}
    assert {r.doc_id for r in quality.keep(docs).collect()} == kept and quality.keep(docs).columns == docs.columns
    assert quality.judge(docs.where("false")).count() == 0


def test_bad_host_is_rejected_and_small_ones_shrink(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, 40) if i % 2 else "junk", "en", "bad" if i < 200 and not i % 2 else "good", 1) for i in range(400)] + [(1000, "junk", "en", "tiny", 1), (1001, words(rng, 40), "en", None, 1)]
    v = {r.host: r for r in quality.host_verdicts(quality.rules(spark.createDataFrame(rows, DOC))).collect()}
    assert not v["bad"].host_ok and v["good"].host_ok and v["tiny"].rate < 1.0 and None in v


def test_hosts_that_differ_by_chance_are_kept(spark):
    rng = random.Random(19)
    rows = [(i, words(rng, 40) if rng.random() > 0.1 else "junk", "en", f"h{i % 30}", 1) for i in range(1500)]
    v = quality.host_verdicts(quality.rules(spark.createDataFrame(rows, DOC))).collect()
    assert all(r.host_ok for r in v) and max(r.rate for r in v) - min(r.rate for r in v) < 0.1
    worse = [(2000 + i, "junk" if i % 3 else words(rng, 40), "en", "worse", 1) for i in range(60)]
    v = {r.host: r.host_ok for r in quality.host_verdicts(quality.rules(spark.createDataFrame(rows + worse, DOC))).collect()}
    assert not v.pop("worse") and all(v.values())


def test_hot_openings_either_way(spark, monkeypatch):
    rows = [(i, k, ("user", "assistant")[k % 2], "hello" if i % 3 and not k else f"{i} {k}") for i in range(60) for k in range(3)] + [(None, 0, "user", "hello")]
    t = spark.createDataFrame(rows + rows[:3], "conv_id long, turn long, role string, text string").withColumn("head", F.lit(1)).withColumn("opening", F.lit("x"))
    few = sorted(map(tuple, preference.format_pairs(preference.pairs_from(t)).collect()))
    monkeypatch.setattr(preference, "MAX_BROADCAST_HEADS", 0)
    assert few == sorted(map(tuple, preference.format_pairs(preference.pairs_from(t)).collect()))
    assert sum(r[0].startswith("same-") for r in few) == 39
    assert preference.format_pairs(preference.pairs_from(t.where("false"))).count() == 0


def test_preference_pairs(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (2, 0, "user", "a"), (2, 1, "assistant", "x"), (3, 0, "system", None), (4, 0, "user", "q"), (4, 1, "assistant", "r")]
    out = {r.pair_id: r for r in preference.format_pairs(preference.pairs_from(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert set(out) == {"swap-1", "swap-2", "swap-4", "same-2"}
    r = out["swap-1"]
    assert r.n_common == 3 and r.prompt.count("<|im_start|>") == 3 and r.chosen.endswith("assistant\nd<|im_end|>\n") and r.rejected.endswith("assistant\nb<|im_end|>\n")
    s, e = map(int, r.chosen_mask.split(":"))
    assert r.chosen[s:e] == "d<|im_end|>\n"
    assert out["same-2"].n_common == 1 and out["swap-4"].rejected == "<|im_start|>assistant\n<|im_end|>\n"
    same = spark.createDataFrame([("p", "chosen", 0, "user", "a"), ("p", "rejected", 0, "user", "a")], "pair_id string, side string, turn int, role string, text string")
    assert tuple(preference.format_pairs(same).select("n_common", "chosen", "rejected", "chosen_mask").first()) == (1, "", "", "")


def test_license_inheritance(spark):
    rows = [("r/LICENSE", "Released under the MIT License."), ("r/a.py", "code"), ("r/s/COPYING", "Licensed under the Apache License, Version 2.0."), ("r/s/b.py", "code"), ("r/s/t/c.py", "x\nLicensed under CC BY-NC 4.0.\ny"), ("r/s/t/d.py", None), ("q/e.py", "plain"), ("q/f.py", "A license to nothing we know of at all, ever")]
    out = {r.path: (r.license, r.origin) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert out == {"r/LICENSE": ("MIT", "r/LICENSE"), "r/a.py": ("MIT", "r/LICENSE"), "r/s/COPYING": ("Apache-2.0", "r/s/COPYING"), "r/s/b.py": ("Apache-2.0", "r/s/COPYING"), "r/s/t/c.py": ("CC-BY-NC-4.0", "r/s/t/c.py"), "r/s/t/d.py": ("Apache-2.0", "r/s/COPYING"), "q/e.py": (None, None), "q/f.py": (None, None)}


def test_full_licence_files_and_clashing_columns(spark):
    texts = dict(licenses.licence_texts())
    wrap = lambda t, n: "\n".join("# " + t[i : i + n] for i in range(0, len(t), n))
    rows = [(f"{k}/LICENSE", t.replace("<year> <copyright holders>", "2020 A. Person"), "x", 1) for k, t in texts.items()] + [(f"{k}/code.py", "code", "x", 1) for k in texts]
    notice = dict(licenses.TEMPLATES)["BSD-3-Clause"]
    half = notice.index(" in source")
    rows += [("h/a.py", f"import os\n\n# {notice[:half]}\n#{notice[half:]}\n\n" + "some code here\n" * 50, "x", 1), ("h/b.py", "Some words before that. Licensed under CC BY-SA 4.0. And after it a great many other words " + "go on " * 40, "x", 1)]
    rows += [("two/LICENSE", "nothing", "x", 1), ("two/LICENSE", "Released under the MIT License.", "x", 1), ("two/LICENSE", "Released under the MIT License.", "x", 1), (None, texts["MIT"], "x", 1), ("two/c", None, "x", 1), ("prose/LICENSE", "the of to and a in that is for you or not " * 200, "x", 1)]
    files = spark.createDataFrame(rows, "path string, text string, license string, dir long").withColumn("m", F.lit(1)).withColumn("own_path", F.lit(2)).withColumn("score", F.lit("s"))
    out = licenses.scan(files)
    assert out.columns == ["path", "dir", "m", "own_path", "license", "score", "origin"] and out.count() == len(rows)
    got = {r.path: (r.license, r.origin) for r in out.collect()}
    for k in texts:
        assert got[f"{k}/LICENSE"] == got[f"{k}/code.py"] == (k, f"{k}/LICENSE")
    assert got["h/a.py"][0] == "BSD-3-Clause" and got["h/b.py"][0] == "CC-BY-SA-4.0"
    assert got["two/LICENSE"] == got["two/c"] == ("MIT", "two/LICENSE") and got[None] == got["prose/LICENSE"] == (None, None)


def test_key_terms_lose_nothing():
    rng = random.Random(8)
    for _ in range(200):
        v = {str(i): rng.random() ** 3 for i in range(rng.randrange(1, 30))}
        size = sum(x * x for x in v.values()) ** 0.5
        v = {k: x / size for k, x in v.items()}
        keys = licenses.key_terms(v, 0.6)
        rest = sum(v[k] ** 2 for k in set(v) - keys)  # the square of the best cosine of a unit without key terms
        assert keys and rest < 0.36 and rest + min(v[k] for k in keys) ** 2 >= 0.36 - 1e-5


@pytest.mark.parametrize("name", ["op3_host_quality", "op5_preference_pairs", "op6_license_inheritance"])
def test_sql_twins(spark, name):
    d, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    df = registry.QUERIES[name](spark, d)
    cur = con.execute(registry.ORACLE_SQL[name])
    names, cols = [c[0] for c in cur.description], sorted(df.columns)
    norm = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())


def test_empty_tables(spark):
    none = make(spark, ["x"]).where("false")
    for f in (suffixes.removed, simhash.classes, minhash.repeated, secrets.digest, bpe.encode, packing.pack, quality.judge, lambda d: licenses.scan(licenses.as_files(d)), suffixes.strip, secrets.redact, simhash.keep_first, quality.keep):
        assert f(none).count() == 0
