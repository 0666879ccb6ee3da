"""Stated behaviours on literal rows."""

from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.operators import assets, citations, gates, layout, paragraphs, telemetry
from foliospark.sources import artifacts, html
from foliospark.streaming.telemetry import fault_counts

BLOCK = "doc_id long, block_id string, ord int, page int, x0 double, y0 double, x1 double, y1 double, text string, font_size double, is_bold boolean, font string, column_guess int"


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first().x


def block(i, box, words, page=1):
    return (1, f"b{i}", i, page, *box, words, 8.2, False, "BodyFont", 1)


def test_islands_end_at_gaps_and_captions(spark):
    boxes = [(40.0, 100.0, 295.0, 180.0), (40.5, 183.0, 295.5, 220.0), (40.0, 260.0, 295.0, 320.0)]
    rows = [block(i + 1, b, t) for i, (b, t) in enumerate(zip(boxes, ("Paragraph part one", "Paragraph part two", "New paragraph"), strict=True))]
    found = layout.paragraph_islands(spark.createDataFrame(rows, BLOCK)).collect()
    assert [r.block_id for r in found] == ["b1", "b2"]
    rows[1] = block(2, boxes[1], "Fig. 1 | Caption block")
    assert layout.paragraph_islands(spark.createDataFrame(rows, BLOCK)).count() == 0


def test_marker_expansion(spark):
    assert one(spark, "1,3-5;9-8;2-99;0", text.expand_markers) == [1, 3, 4, 5]
    assert one(spark, "", text.expand_markers) == []


def test_suppression_rules(spark):
    lines = ["5", "Check for updates", "1 Department of Radiology, Example University, New York, NY 10016", "Narrative line that should stay."]
    out = paragraphs.suppress_lines(spark.createDataFrame([(1, t) for t in lines], "doc_id int, text string")).collect()
    assert [r.rule_id for r in out] == ["page_number_only", "check_for_updates_banner", "affiliation_address_line", None]


def test_template_folds_digits(spark):
    assert one(spark, "Downloaded from sample by 1.2.3.4", text.template) == one(spark, "Downloaded from sample by 8.8.8.8", text.template)
    assert one(spark, "micro­scope", text.clean_line) == "microscope"


def test_nearest_paragraph(spark):
    p = spark.createDataFrame([(1, "a", 4, 0.0, 500.0, 10.0), (1, "b", 4, 0.0, 210.0, 10.0), (1, "c", 3, 0.0, 205.0, 10.0), (2, "d", 2, 0.0, 0.0, 1.0), (2, "e", 7, 0.0, 0.0, 1.0)], "doc_id int, para_id string, page int, x0 double, y0 double, x1 double")
    a = spark.createDataFrame([(1, "x", 4, 5.0, 200.0), (2, "y", 5, 0.0, 0.0)], "doc_id int, anchor_id string, page int, ax double, ay double")
    assert {r.anchor_id: r.para_id for r in citations.nearest_paragraphs(a, p).collect()} == {"x": "b", "y": "e"}


def test_asset_with_caption_wins(spark):
    rows = [(1, "tbl_001", 1, "table", 9, None, "", 0.4), (1, "tbl_001", 2, "table", 10, "para_tbl_1", "", 0.5)]
    out = assets.dedupe_assets(spark.createDataFrame(rows, "doc_id int, asset_id string, ord int, asset_type string, page int, caption_id string, caption_text string, confidence double")).collect()
    assert [r.page for r in out] == [10]


def test_same_doi_is_one_record(spark):
    rows = [(1, "api", "pubmed", 1, "T", "10.1/A", None, 2020, None, 0.7), (1, "api", "crossref", 2, "T", "10.1/a", None, 2020, "J", 0.9)]
    r = citations.merge_references(spark.createDataFrame(rows, "doc_id int, kind string, provider string, ord int, title string, doi string, pmid string, year int, venue string, confidence double")).collect()
    assert [(x.venue, x.confidence, x.source_chain, x.n_records) for x in r] == [("J", 0.9, "crossref+pubmed", 2)]


def test_unknown_paragraph_is_recovered_only_if_unique(spark):
    p = spark.createDataFrame([(1, "p1", "k", 6, "t"), (2, "p1", "k", 6, "t"), (2, "p2", "k", 6, "t")], "doc_id int, para_id string, block_id string, page int, text string")
    f = spark.createDataFrame([(1, "f", "?", 6, "k", "", "s", "none"), (2, "f", "?", 6, "k", "", "s", "none")], "doc_id int, fact_id string, para_id string, page int, block_id string, quote string, statement string, category string")
    assert {r.doc_id: r.reason for r in gates.anchored_facts(f, p).collect()} == {1: "ok", 2: "ambiguous_paragraph_mapping"}


def test_citation_precision_counts_missing_keys(spark):
    t = spark.createDataFrame([(1, "a", "doi:10.1000/xyz"), (2, "a", "pmid:12345678")], "doc_id int, anchor_id string, expected string")
    m = spark.createDataFrame([(1, "a", "doi:10.1000/xyz"), (1, "b", "doi:10.2000/extra"), (2, "a", None)], "doc_id int, anchor_id string, ref_key string")
    assert {r.doc_id: (r.status, r.value) for r in gates.citation_coverage(t, m).collect()} == {1: ("PASS", 1.0), 2: ("FAIL", 0.0)}


def test_fault_classes_and_stream_twin(spark):
    rows = [("a1", "vision", "vision-parse-failure", 1, "parse_failure", None, False, "degraded", True, "2024-01-01 00:00:00"), ("a1", "vision", "none", 1, "none", None, True, "ok", False, "2024-01-01 00:01:00")]
    e = spark.createDataFrame(rows, "attempt_id string, stage string, fault string, page int, error_type string, http_status int, success boolean, status string, fallback_used boolean, observed_at string")
    r = {x.fault: (x.category, x.retryable, x.degraded_output_used) for x in telemetry.enrich(e).collect()}
    assert r == {"vision-parse-failure": ("parse/validation", False, True), "none": ("none", False, False)}
    assert [(x.category, x.n) for x in fault_counts(e).collect()] == [("parse/validation", 1)]


def test_boundary_rules():
    def how(a, b, x=(0.3, 0.3), y=(0.8, 0.2), page=(1, 1)):
        return paragraphs.continues((a, page[0], x[0], y[0], False), (b, page[1], x[1], y[1], b.startswith("row")))

    assert how("effe-", "ctive improvement") == how("effect-", "tive results") == "wrap"
    assert how("effect-", "Results") is None
    assert how("effect-", "tive", y=(0.3, 0.9)) is None
    assert how("re-", "cruitment process", x=(0.3, 0.65), y=(0.8, 0.15)) == "wrap"
    assert how("re-", "cruitment") is how("re-", "cruitment", x=(0.3, 0.65), y=(0.3, 0.5)) is how("re-", "Recruitment", x=(0.3, 0.65), y=(0.8, 0.15)) is None
    assert how("upregulation of BMP-", "2, BMP-4, IGF-2 pathways were detected", x=(0.72, 0.74), y=(0.78, 0.86)) == "wrap"
    assert how("there remains some contro-", "versy regarding effects", x=(0.3, 0.78), y=(0.9, 0.9)) == "wrap"
    long = "In short, the distinctive material architecture enables robust transport"
    turn = {"x": (0.78, 0.22), "y": (0.83, 0.2), "page": (10, 11)}
    assert how(long, "physicochemical properties of graphene", **turn) == "blank"
    assert how(long, "row 1 2 3 4 5", **turn) is None
    cited = "These signals facilitated cell recruitment and promoted cartilage formation. Damaraju et al. [ 159c ]"
    far = {"x": (0.2, 0.9), "y": (0.2, 0.9)}
    assert how(cited, "developed a pliable scaffold.", **far) == "blank"
    assert how("1. Damaraju et al. [ 159c ]", "developed a pliable scaffold.", **far) is None
    assert paragraphs.trim_numeric_lead("2, BMP-4, IGF-2, and VEGF in osteoblasts. Notably, it grew.") == "Notably, it grew."


def test_boundary_repair(spark):
    rows = [(1, 1, "effe-", 10.0, 90.0), (1, 2, "ctive improvement", 10.0, 93.0), (1, 3, "Results follow.", 10.0, 100.0), (2, 1, None, 0.0, 0.0), (2, 2, "lower start", 0.0, 50.0), (3, 1, "one two three four five six " * 200, 0.0, 0.0)]
    rows += [(3, i, "and so on it goes", 0.0, float(i)) for i in range(2, 500)]
    df = spark.createDataFrame([(d, o, 1, x, y, x + 5, y + 1, t) for d, o, t, x, y in rows], "doc_id int, ord int, page int, x0 double, y0 double, x1 double, y1 double, text string")
    out = sorted((r.doc_id, r.n, r.text) for r in paragraphs.repair_boundaries(df).collect())
    assert out[:3] == [(1, 1, "Results follow."), (1, 2, "effective improvement"), (2, 1, "lower start")]
    assert out[3][1] == 499 and out[3][2] == " ".join(["one two three four five six"] * 200 + ["and so on it goes"] * 498)


def test_inline_anchors(spark):
    given = ["Results improved (1) with n=20 compared.", "Prior studies (1,2;4-5) support this.", "See ref (3) for details.", "As said (7), a reference.", "Both [2, 3] and [2].", None]
    rows = [(1, f"p{i}", 1, t, False) for i, t in enumerate(given)] + [(1, "list", 1, "[1] An entry", True)]
    found = citations.inline_anchors(spark.createDataFrame(rows, "doc_id int, para_id string, page int, text string, is_reference boolean")).collect()
    of = {}
    for r in found:
        of.setdefault(r.para_id, []).append(r.anchor_text)
    assert of == {"p1": ["[1]", "[2]", "[4]", "[5]"], "p2": ["[3]"], "p3": ["[7]"], "p4": ["[2]", "[3]", "[2]"]}


ANCHOR = "doc_id int, anchor_id string, anchor_text string, link_type string, dest_name string, anchor_type string, nearest_para_id string"


def test_citation_mapping(spark):
    refs = spark.createDataFrame([(1, 1, 1, "doi:10.1/one"), (1, 1, 2, "doi:10.1/two"), (1, 4, 3, "bib:ref_x")], "doc_id int, marker int, ord int, ref_key string")
    paras = spark.createDataFrame([(1, "p1", "[9] Doe, J. Study. 2019. 10.1000/nine")], "doc_id int, para_id string, text string")
    cite = "citation_marker"
    rows = [
        ("a", "[1]", "inline", None, cite, None, "doi:10.1/one", "internal_dest"), ("b", "[2-4]", "inline", None, cite, None, "bib:ref_x", "internal_dest"), ("c", "[7]", "internal", "adfm202314079-bib-0007", cite, None, "bib:dest_0007", "internal_dest"),
        ("d", "see 10.1000/ABC.", "external", None, cite, None, "doi:10.1000/abc", "regex"), ("e", "[8]", "inline", None, cite, None, None, "none"), ("f", "home", "external", None, "resource_link", None, None, "none"),
        ("g", None, "internal", None, cite, "p1", "doi:10.1000/nine", "internal_dest"), ("h", None, "external", None, cite, None, None, "none"), ("i", "PMID: 1234567", "external", None, cite, None, "pmid:1234567", "regex"),
    ]
    anchors = spark.createDataFrame([(1, *r[:6]) for r in rows], ANCHOR)
    got = {r.anchor_id: (r.ref_key, r.strategy) for r in citations.map_citations(anchors, refs, paras).collect()}
    assert got == {r[0]: r[6:] for r in rows}
    free = citations.map_citations(spark.createDataFrame([(2, "a", "[1] Smith, J. A wide study. 2019", "inline", None, cite, None)], ANCHOR), refs, paras).first()
    assert free.ref_key.startswith("bib:smith_2019_") and free.confidence == 0.62


def test_demotion(spark):
    refs = spark.createDataFrame([(1, 2, "bib:x")], "doc_id int, marker int, ref_key string")
    rows = [(1, "a", "1", "inline", None, "citation_marker", None), (1, "b", "2", "inline", None, "citation_marker", None), (1, "c", "[1]", "inline", None, "citation_marker", None), (1, "d", "[1]", "internal", "sec-3", "citation_marker", None), (1, "e", "[1]", "internal", "bib3", "citation_marker", None)]
    got = {r.anchor_id: r.anchor_type for r in citations.demote(spark.createDataFrame(rows, ANCHOR), refs).collect()}
    assert got == {"a": "structural_link", "b": "citation_marker", "c": "citation_marker", "d": "structural_link", "e": "citation_marker"}


def test_resolution_by_title_and_author(spark):
    mapped = spark.createDataFrame([(1, c, k, "internal_dest", 0.86) for c, k in (("a", "doi:10.1/m"), ("b", "bib:t"), ("c", "bib:y"), ("d", "bib:z"), ("e", None))], "doc_id int, anchor_id string, ref_key string, strategy string, confidence double")
    entries = spark.createDataFrame([(1, "bib:t", "A Wide Study 2020", "x", 2020), (1, "bib:y", "Other", "Doe", 2019), (1, "bib:z", "Third", "roe", 2018)], "doc_id int, ref_key string, title string, author string, year int")
    merged = spark.createDataFrame([(1, "doi:10.1/m", "A wide study", "poe", 2020, "10.1/m", 0.95), (1, "doi:10.1/n", "Unlike", "doe", 2019, "10.1/N", 0.5)], "doc_id int, ref_key string, title string, author string, year int, doi string, confidence double")
    got = {r.anchor_id: (r.ref_key, r.strategy, r.confidence) for r in citations.resolve_keys(mapped, entries, merged).collect()}
    assert got == {"a": ("doi:10.1/m", "internal_dest", 0.86), "b": ("doi:10.1/m", "internal_dest", 0.95), "c": ("doi:10.1/n", "author_year_match", 0.75), "d": ("bib:z", "internal_dest", 0.86), "e": (None, "internal_dest", 0.86)}


def test_json_lines(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_text('{"k": "a", "v": 1}\nbroken\n{"k": "a", "v": 2}\n')
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("k", StringType()), StructField("v", IntegerType())])
    rows = artifacts.read_tolerant(spark, str(f), schema)
    assert artifacts.last_wins(rows, "k", order="v").collect()[0].v == 2
    artifacts.write_lines(rows, str(tmp_path / "out"))
    assert artifacts.read_strict(spark, str(tmp_path / "out"), schema).count() == 2


def test_html_text(spark):
    p = spark.createDataFrame([(1, "<h1>A &amp; B</h1><script>x</script><p>c</p>")], "page_id int, html string")
    assert html.plain_text(p).first().text == "A & B\nc"
    assert html.outline(p).first().n_headings == 1
