"""Lineage, bibliography and scalar functions on small rows."""

import difflib
import unicodedata

from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.operators import bibliography, lineage
from foliospark.sources import artifacts


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("r")).first()[0]


def test_scalars(spark):
    words = ["ﬁnal  Eﬀect ½", "Ｆull", "", None]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, c string").select("i", text.heading_key(F.col("c")).alias("k")).collect()
    assert [r.k for r in sorted(rows)] == ["final effect 1⁄2", "full", "", ""]
    assert unicodedata.normalize("NFKC", "ﬃ") == one(spark, "ﬃ", text.compatible)
    assert one(spark, 'Here: ```{"a": [1, 2]}', text.json_value) == '{"a": [1, 2]}'
    assert one(spark, '{"a": ', text.json_value) is None and one(spark, None, text.json_value) is None
    caption = lambda c, kind: one(spark, c, lambda x: text.canonical_caption(x, F.lit(kind)))
    assert caption("Figure 3: | A  thing ||", "figure") == "Fig. 3 | A thing" and caption("TABLE 2b", "table") == "Table 2b"
    assert caption("Fig. 1 x", "table") == "Fig. 1 x" and caption("  ", "figure") is None
    assert one(spark, "see arXiv:2101.01234v2 there", bibliography.arxiv_id) == "2101.01234v2" and one(spark, "none", bibliography.arxiv_id) is None
    pairs = [("a study of things", "a study of thing"), ("x", ""), ("same", "same"), ("abc", "xyz")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", bibliography.title_similarity("a", "b").alias("s")).collect()
    assert {r.a: r.s for r in got} == {a: 0.0 if not b else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs}


def test_parsed_reference(spark):
    said = "[12] Smith J.A., Doe B., and Roe C. A study of small things. Nature of Things. 2003;4:5-6. doi:10.1234/Ab.5. PMID: 12345678"
    r = bibliography.parse(spark.createDataFrame([(said,), (None,), ("Untitled",)], "text string")).collect()
    assert (r[0].title, r[0].venue, r[0].year, r[0].doi, r[0].pmid) == ("A study of small things", "Nature of Things", 2003, "10.1234/ab.5", "12345678")
    assert r[0].authors[0].startswith("Smith") and r[1].title == "" and r[1].authors == [] and r[2].title == "Untitled" and r[2].year is None


def test_backfill_is_bounded(spark):
    refs = spark.createDataFrame([(1, f"k{i}", i, None if i else "own", "v") for i in range(4)], "doc_id int, ref_key string, ord int, doi string, venue string")
    given = spark.createDataFrame([(f"k{i}", p, None, r) for i in range(4) for p, r in (("late", 2), ("first", 1))], "ref_key string, doi string, venue string, rank int")
    out = {r.ref_key: (r.doi, r.venue, r.filled) for r in bibliography.backfill(refs, given, ("doi", "venue"), most=2).collect()}
    assert out == {"k0": ("own", "v", 0), "k1": ("first", "v", 1), "k2": ("first", "v", 1), "k3": (None, "v", 0)}


def test_split_and_expanded(spark):
    blocks = spark.createDataFrame([(1, "b1", "METHODS\nWe did  it\n\nand more\nRESULTS\nFine"), (1, "b2", None), (1, "b3", "x")], "doc_id int, block_id string, text string")
    out = {r.block_id: (r.source_block_id, r.first_line, r.last_line, r.text) for r in lineage.split_lines(blocks, F.col("line").rlike("^[A-Z]+$")).collect()}
    assert out == {"b1__s0": ("b1", 0, 3, "METHODS We did it and more"), "b1__s1": ("b1", 4, 5, "RESULTS Fine"), "b2": ("b2", 0, 0, ""), "b3": ("b3", 0, 0, "x")}
    order = spark.createDataFrame([(1, 1, "b1__s1"), (1, 2, "b3"), (1, 3, "b1__s0")], "doc_id int, pos int, block_id string")
    kin = spark.createDataFrame([(1, f"b1__s{k}", "b1", k) for k in range(2)], "doc_id int, block_id string, source_block_id string, k int")
    assert [tuple(r) for r in sorted(lineage.expand_order(order, kin).collect())] == [(1, 1, "b1"), (1, 2, "b3")]


def test_later_file_wins(spark, tmp_path):
    for name, conf in (("p001_out.json", 1), ("p001b_out.json", 2)):
        (tmp_path / name).write_text(f'{{"page": 1,\n "conf": {conf}}}')
    schema = spark.createDataFrame([], "page int, conf int").schema
    assert [r.conf for r in artifacts.read_documents(spark, str(tmp_path / "*.json"), schema).collect()] == [2]


def test_external_sources(spark, tmp_path):
    import http.server
    import json
    import sqlite3
    import threading

    from foliospark.sources import external

    db = sqlite3.connect(tmp_path / "refs.db")
    db.execute("CREATE TABLE refs (title TEXT, year INT, other BLOB)")
    db.executemany("INSERT INTO refs VALUES (?, ?, x'00')", [(f"t{i}", i if i % 2 else None) for i in range(100)])
    db.execute("CREATE TABLE none (title TEXT)")
    db.commit()
    db.close()
    rows = external.read_sqlite(spark, str(tmp_path / "refs.db"), "refs", "year int, title string", partitions=3)
    assert sorted((r.title, r.year) for r in rows.collect()) == sorted((f"t{i}", i if i % 2 else None) for i in range(100)) and rows.rdd.getNumPartitions() == 3
    assert external.read_sqlite(spark, str(tmp_path / "refs.db"), "none", "title string").count() == 0

    class Pages(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            n = int(self.path.rsplit("=", 1)[-1])
            self.send_response(200 if n < 4 else 500)
            self.end_headers()
            self.wfile.write(json.dumps({"items": [{"title": f"p{n}"}, {"title": f"q{n}", "year": n}]}).encode() if n < 4 else b"")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/x?page={{page}}"
    out = external.read_rest(spark, url, 4, "title string, year int", items="items", tolerant="true").collect()
    server.shutdown()
    assert sorted((r.title, r.year) for r in out) == sorted([(f"p{n}", None) for n in (1, 2, 3)] + [(f"q{n}", n) for n in (1, 2, 3)])


def test_image_measures(spark):
    from foliospark.operators import images

    rows = spark.createDataFrame([(1, bytearray([255, 255, 0, 0])), (2, bytearray()), (3, None)], "image_id int, gray binary")
    assert {r.image_id: (r.white_ratio, r.entropy) for r in images.histogram_measures(rows).collect()} == {1: (0.5, 1.0), 2: (0.0, 0.0), 3: (0.0, 0.0)}
