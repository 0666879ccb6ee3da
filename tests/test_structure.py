"""Stated behaviours of roles, tables, orders and selections on literal rows."""

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.operators import roles, sequences, tables
from foliospark.plans import registry

ROLED = "doc_id long, block_id string, ord int, page int, x0 double, y0 double, x1 double, y1 double, text string, font_size double, is_bold boolean, font string, is_heading boolean, role string"


def values(spark, rows, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_hyphens(spark):
    given = ["electro- magnetic response", "micro­ scope imaging", "inter- Related signaling", "COVID- 19 cohort", None]
    assert values(spark, given, text.repair_hyphens) == ["electro-magnetic response", "microscope imaging", "inter- Related signaling", "COVID- 19 cohort", ""]


def test_coherence(spark):
    labels = ["0", "5", "10", "Hw", "Iw", "Ir", "Inflammation", "Log2 of FC", "Up", "Down"]
    prose = ["RNA sequence", "Total RNA was extracted from the tissue using TRIzol Reagent", "according to the manufacturer's instructions."]
    rows = [(1, t) for t in labels] + [(2, t) for t in prose] + [(3, None)]
    found = sequences.coherence(spark.createDataFrame(rows, "cluster int, text string"), "cluster").collect()
    assert {r.cluster: r.label for r in found} == {1: "non_narrative_graphic", 2: "narrative", 3: "uncertain"}


def test_table_text(spark):
    given = ["[1, 2, 3]", "Table 2. (Continued)", "Advantages Disadvantages Applications", "3.1. Methods of study", "Low cost; high strength; 12 MPa", "We measured the force of every sample and found that it was always larger than before.", "", None]
    assert values(spark, given, tables.is_noise) == [True, True, True, False, True, False, False, False]
    assert values(spark, given, tables.is_artifact) == [True, False, True, False, True, False, False, False]
    assert values(spark, ["", "Low cost; 5 mm", "Advantages and applications", None], tables.score) == [0.0, 2.8, 1.0, 0.0]


def test_artifact_spans(spark):
    prose = "We then measured the force of every one of the samples, and it was always larger than it had been before the change, as the first study says."
    lines = [prose, "Low cost; strong", "High cost; weak", "and more so", "Iron; 12 mm", "Steel; 14 mm", prose, prose, prose, "Zinc; 3", prose]
    rows = [(d, i, t) for d in (1, 2, 3) for i, t in enumerate(lines)] + [(4, 0, None)]
    given = spark.createDataFrame(rows, "doc_id long, ord long, text string")
    owned = spark.createDataFrame([(1, 2), (2, 1), (3, 0), (4, 1)], "doc_id long, n_tables int")
    found = sorted(tuple(r) for r in tables.artifact_spans(given, owned).collect())
    assert found == [(1, 1, 5, 5), (1, 9, 9, 1), (2, 1, 9, 9)]
    assert tables.artifact_spans(given.limit(0), owned).count() == 0


def test_plausible_assets(spark):
    rows = [(1, "c", 0.0, 300.0, 40.0, 330.0), (2, None, 0.0, 300.0, 40.0, 330.0), (3, None, 50.0, 300.0, 150.0, 400.0), (4, None, 50.0, 0.0, 150.0, 60.0), (5, "c", 0.0, 0.0, 34.0, 90.0)]
    found = tables.plausible_assets(spark.createDataFrame(rows, "i int, caption_id string, x0 double, y0 double, x1 double, y1 double"))
    assert sorted(r.i for r in found.collect()) == [1, 3]


CASES = [
    ("A wide study of seven different kinds of samples", 1, 12.0, True, "Heading", 0.1, "main_title"),
    ("Fig. 3 Change of the measured force", 3, 8.0, False, "Body", 0.5, "figure_caption"),
    ("see also Table 2 Forces of the samples", 3, 8.0, False, "Body", 0.5, "table_caption"),
    ("Fig. 2a. Change of the measured force", 3, 8.0, False, "Body", 0.5, "body_text"),
    ("P-value HR CI", 3, 8.0, False, "Body", 0.5, "nuisance"),
    ("Keywords: bone, shoulder, force", 1, 8.0, False, "Body", 0.6, "keywords"),
    ("https://doi.org/10.1000/182 online", 1, 8.0, False, "Body", 0.6, "doi"),
    ("Received 3 May 2019", 2, 8.0, False, "Body", 0.6, "received"),
    ("1 Department of Radiology, Example University, New York", 1, 8.0, False, "Body", 0.6, "affiliation_meta"),
    ("John A. Doe, Jane Roe and Max Moe", 1, 8.0, False, "Body", 0.6, "author_meta"),
    ("[3] Smith, J. A wide study. Nature 2019.", 9, 8.0, False, "Body", 0.6, "reference_entry"),
    ("Materials and Methods", 4, 12.0, True, "Body", 0.5, "section_heading"),
    ("x", 4, 8.0, False, "TableData", 0.5, "nuisance"),
    (None, 4, 8.0, False, "Body", 0.5, "body_text"),
]


def test_clean_roles(spark):
    rows = []
    for i, (t, page, size, bold, role, y, _) in enumerate(CASES):
        rows.append((i, "top", 0, page, 0.0, 0.0, 10.0, 0.0, "x", 8.0, False, "F", False, "HeaderFooter"))
        rows.append((i, "end", 1, page, 0.0, 1000.0, 10.0, 1000.0, "x", 8.0, False, "F", False, "HeaderFooter"))
        rows.append((i, "b", 2, page, 0.0, y * 1000, 10.0, y * 1000, t, size, bold, "B" if size > 10 else "F", False, role))
    b = spark.createDataFrame(rows, ROLED)
    profile = spark.createDataFrame([(i, 12.0, 1.0, "B", 8.0) for i in range(len(CASES))], "doc_id long, heading_size double, heading_bold double, heading_font string, body_size double")
    out = {r.doc_id: r.clean_role for r in roles.clean_roles(b, profile).where("block_id = 'b'").collect()}
    assert [out[i] for i in range(len(CASES))] == [c[-1] for c in CASES]
    repeated = spark.createDataFrame([(7, "b", 3, 4, False), (11, "b", 1, 4, True)], "doc_id long, block_id string, n int, n_blocks int, is_nuisance boolean")
    out = {r.doc_id: r.clean_role for r in roles.clean_roles(b, profile, repeated).where("block_id = 'b'").collect()}
    assert (out[7], out[11], out[5]) == ("nuisance", "nuisance", "keywords")


def test_reference_paragraphs(spark):
    rows = [("a", "Body", None, "Text with 10.1000/abc only."), ("b", "Body", None, "[1] Smith, J. A study. Nature 2019."), ("c", "ReferenceList", None, "anything"), ("d", "Body", None, "as shown [1] [2] [3] [4] [5]"), ("e", "Body", "References", "[1] One [2] Two"), ("f", None, None, None)]
    found = roles.reference_paragraphs(spark.createDataFrame([(1, *r) for r in rows], "doc_id int, para_id string, role string, section string, text string"))
    assert {r.para_id: r.is_reference for r in found.collect()} == {"a": False, "b": True, "c": True, "d": False, "e": True, "f": False}


def test_titles(spark):
    rows = [(1, "b1", 1, 10.0, 50.0, "main_title", "Article A wide study of seven samples"), (1, "b2", 1, 20.0, 10.0, "body_text", "Another large line that is no title"), (1, "b3", 2, 30.0, 10.0, "main_title", "A title on the second page is none"), (2, "b1", 1, 9.0, 9.0, "body_text", "Too short")]
    found = roles.titles(spark.createDataFrame(rows, "doc_id int, block_id string, page int, font_size double, y0 double, clean_role string, text string"))
    assert [tuple(r) for r in found.collect()] == [(1, "A wide study of seven samples")]


def test_seeds_spread_over_cells_until_half_are_found(spark):
    long = "many long words in this one block"
    rows = [(1, 1, f"b{i}", i, float(x), 0.0, float(x) + 10, 10.0, long + "." * n, False, False) for i, (x, n) in enumerate([(0, 9), (20, 8), (40, 7), (1000, 1)])]
    b = spark.createDataFrame(rows, "doc_id int, page int, block_id string, ord int, x0 double, y0 double, x1 double, y1 double, text string, is_heading boolean, is_header_footer boolean")
    assert [r.block_id for r in sequences.coarse_seeds(b, 3).orderBy("seed_no").collect()] == ["b0", "b1", "b2"]
    b4 = b.union(b.where("ord = 0").selectExpr("doc_id", "page", "'b9' AS block_id", "9 AS ord", "x0", "y0", "x1", "y1", "text", "is_heading", "is_header_footer"))
    assert [r.block_id for r in sequences.coarse_seeds(b4, 4).orderBy("seed_no").collect()] == ["b0", "b3", "b9", "b1"]
    assert sequences.coarse_seeds(b4, 5).count() == 5


def test_chunks_of_lines(spark):
    word, end = "word " * 60, "word " * 59 + "end."
    rows = [(1, 1, i, 40.0, 20.0 * i, 300.0, 20.0 * i + 18, t) for i, t in enumerate([word, end, "Next one", word, word, word, "after"])]
    rows += [(1, 2, 0, 40.0, 0.0, 300.0, 10.0, "one"), (1, 2, 1, 40.0, 10.0, 300.0, 20.0, None), (1, 2, 2, 40.0, 20.0, 300.0, 30.0, "2. item"), (1, 2, 3, 40.0, 60.0, 300.0, 70.0, "gap"), (1, 2, 4, 200.0, 0.0, 300.0, 10.0, "column")]
    found = sequences.chunk_lines(spark.createDataFrame(rows, "doc_id long, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")).orderBy("page", "chunk").collect()
    assert [(r.page, r.first_ord, r.n_lines, r.n_words) for r in found] == [(1, 0, 2, 120), (1, 2, 4, 182), (1, 6, 1, 1), (2, 0, 2, 1), (2, 2, 1, 2), (2, 3, 1, 1), (2, 4, 1, 1)]


def test_hints(spark):
    groups = spark.createDataFrame([(1, "a"), (1, "b")], "doc_id int, block_id string")
    hints = spark.createDataFrame([(1, 0, ["b", "c"]), (1, 1, ["c", "d"]), (1, 2, ["d", "e"]), (1, 3, ["e", "f", "f", ""]), (1, 4, ["g"]), (2, 0, ["a", "b"])], "doc_id int, hint_ord int, block_ids array<string>")
    found = {(r.doc_id, r.hint_no): r.block_ids for r in sequences.regrouping_hints(groups, hints).collect()}
    assert found == {(1, 0): ["c", "d"], (1, 1): ["e", "f"], (2, 0): ["a", "b"]}


def test_section_parents(spark):
    rows = [(1, "2 Results"), (1, "2.1 Force"), (1, "2.1.1 Bone"), (1, "21 Other"), (1, "Closing"), (2, "2.1. Alone"), (2, None)]
    found = sequences.parents_of_sections(spark.createDataFrame(rows, "doc_id int, section string"))
    assert sorted(r.section for r in found.collect()) == ["2 Results", "2.1 Force"]


@pytest.mark.parametrize("name", ["fact_candidates", "balanced_selection", "caption_reviews", "input_packages", "coarse_seeds"])
def test_full_limits_lose_no_rows(spark, name):
    d = "/root/testdata/sf0.001"
    assert registry.QUERIES[f"{name}_full"](spark, d).count() > registry.QUERIES[name](spark, d).count()
