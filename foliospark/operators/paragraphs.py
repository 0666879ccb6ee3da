"""Repeated templates, line suppression, section headings and boundary repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_line, template, words

#: What marks an affiliation line.
AFFILIATION = ("department", "university", "hospital", "institute", "medical center", "faculty", "school of", "address", "correspondence")


def template_documents(lines: DataFrame) -> DataFrame:
    """template, n_lines, n_docs of templates that occur in two documents or more. Pre-aggregated by (template,
    document), so that a line common to a third of all documents is a third of one partial sum each, not of one task."""
    per_doc = lines.select("doc_id", template(F.col("text")).alias("template")).where("template <> ''").groupBy("template", "doc_id").agg(F.count("*").alias("n"))
    return per_doc.groupBy("template").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_docs")).where("n_docs >= 2")


def template_hits(blocks: DataFrame) -> DataFrame:
    """Each block with its template's count, pages, hits near the top or bottom and near a side of its document. One
    exchange by document serves the pages' bounds and the templates' counts."""
    page, own = W.partitionBy("doc_id", "page"), W.partitionBy("doc_id", "template")
    low, left, high, right = F.min("y0").over(page), F.min("x0").over(page), F.max("y1").over(page), F.max("x1").over(page)
    y = ((F.col("y0") + F.col("y1")) / 2 - low) / F.greatest(F.lit(1e-6), high - low)
    x = ((F.col("x0") + F.col("x1")) / 2 - left) / F.greatest(F.lit(1e-6), right - left)
    b = blocks.select("doc_id", "page", "block_id", template(F.col("text")).alias("template"), "x0", "y0", "x1", "y1").repartition("doc_id")
    b = b.select("doc_id", "block_id", "page", "template", ((y <= 0.12) | (y >= 0.88)).cast("int").alias("_edge"), ((x <= 0.05) | (x >= 0.95) | (F.col("x0") <= 12)).cast("int").alias("_side")).where("template <> ''")
    return b.select("doc_id", "block_id", "template", F.count("*").over(own).alias("n"), F.size(F.collect_set("page").over(own)).cast("long").alias("n_pages"), F.sum("_edge").over(own).alias("edge_hits"), F.sum("_side").over(own).alias("side_hits"))


def suppression_rule(c: Column) -> Column:
    """The rule that takes a line out of the main body, or null."""
    t = clean_line(c)
    low = F.lower(t)
    keyword = F.lit(False)
    for k in AFFILIATION:
        keyword = keyword | F.contains(low, F.lit(k))
    sign = t.rlike(r"^\d+[\s).,-]") | F.contains(t, F.lit("@")) | t.rlike(r"\b\d{5}(-\d{4})?\b") | (F.length(t) - F.length(F.replace(t, F.lit(","), F.lit(""))) >= 2)
    return F.when(t.rlike(r"^\d{1,3}$"), "page_number_only").when(low.rlike(r"^check\s+for\s+updates\b"), "check_for_updates_banner").when(keyword & sign, "affiliation_address_line")


def suppress_lines(lines: DataFrame) -> DataFrame:
    """lines with rule_id (null: kept), blank lines left out."""
    return lines.withColumn("text", clean_line(F.col("text"))).where("text <> ''").withColumn("rule_id", suppression_rule(F.col("text")))


def sections(roled: DataFrame) -> DataFrame:
    """Each block under the last heading before it in its document."""
    order = W.partitionBy("doc_id").orderBy("page", "reading_pos")
    head = F.last(F.when(F.col("role") == "Heading", F.col("block_id")), ignorenulls=True).over(order)
    prev, nxt = F.lag("block_id").over(order), F.lead("block_id").over(order)
    return roled.select("doc_id", "page", "block_id", head.alias("heading_id"), prev.alias("prev_id"), nxt.alias("next_id"))


def document_metrics(blocks: DataFrame) -> DataFrame:
    """Counters of a document's kept quality: page numbers, banners, affiliation lines, repeated headings."""
    r = suppression_rule(F.col("text"))
    count = lambda t: F.sum(F.when(t, 1).otherwise(0))
    heading = F.when(F.col("role") == "Heading", F.lower(clean_line(F.col("text"))))
    m = blocks.withColumn("r", r).groupBy("doc_id").agg(count(F.col("r") == "page_number_only").alias("page_numbers"), count(F.col("r") == "check_for_updates_banner").alias("banners"), count(F.col("r") == "affiliation_address_line").alias("affiliations"), F.count(heading).alias("headings"), F.countDistinct(heading).alias("distinct_headings"))
    return m.withColumn("section_boundary_unstable", (F.col("headings") == 0) | ((F.col("headings") - F.col("distinct_headings")) > 0.2 * F.col("headings")))


def unique_texts(lines: DataFrame) -> DataFrame:
    """The first of a document's equal lines (lower case, cleaned), in order."""
    t = clean_line(F.col("text"))
    w = W.partitionBy("doc_id", F.lower(t)).orderBy("line_no")
    return lines.withColumn("text", t).where("text <> ''").withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


#: Heads that open a section; verbs that continue a sentence after a citation.
SECTION_CUE = r"^(results|discussion|materials\s+and\s+methods|methods|introduction|conclusion|background|clinical\s+study|cadaveric\s+study)\b"
CITING_VERBS = ("developed", "demonstrated", "employed", "found", "introduced", "prepared", "reported", "showed", "used")


def continues(prev: tuple, now: tuple, n: int | None = None) -> str | None:
    """How a paragraph continues the one before it: "wrap" (a divided word), "blank" (a sentence goes on), None (not).

    Both are (text, page, x, y, noise): a cleaned text, its page, the centre's place in the page's bounds from 0 to 1 and
    whether it looks like a table row; n is the number of words before, for a text given by its two ends. A divided word needs a tail of four letters, or of two or three at a turn from the
    left column's lower to the right column's upper part, or an acronym before a number. A sentence goes on in lower case
    after six words without end mark, in the same column or at such a turn or page turn; after ten words that end in a
    citation it goes on with a verb of reporting. Entries of bibliographies and section heads never continue."""
    import re

    (text, page, x, y, noise), (nxt, next_page, nx, ny, next_noise) = prev, now
    if not text or not nxt or re.match(SECTION_CUE, nxt, re.I):
        return None
    lower, turn = re.match(r"[a-z][a-z\-']*\b", nxt), x <= 0.46 and nx >= 0.54
    back, same = turn and ny + 0.2 < y, abs(x - nx) <= 0.2
    if text.endswith("-") and not text[-2:-1].isspace():
        numbered = re.search(r"\b[A-Z]{2,}-$", text) and re.match(r"\d+(?:\s*[,.;:])?(?:\s|$)", nxt)
        tail = len(re.search(r"([^\W\d_]*)-$", text).group(1))
        fits = tail >= 4 or (tail >= 2 and (numbered or (back and nxt[0].islower())))
        if fits and (lower or numbered) and (ny - y <= (0.4 if tail >= 4 else 0.25) if same else back or (turn and abs(ny - y) <= 0.08)):
            return "wrap"
    entry = r"(?:references\s*[:\-]?\s*)?(?:\d+[.)]\s+|\[\d+\]|et al)"
    if not lower or next_noise or re.match(entry, text, re.I) or re.match(entry, nxt, re.I):
        return None
    n = len(text.split()) if n is None else n
    if n >= 6 and text[-1] not in ".!?" and ((0 < next_page - page <= 4 and y >= 0.62 and ny <= 0.38) or back or (same and ny - y <= 0.4)):
        return "blank"
    if n >= 10 and not noise and re.search(r"\[\s*\d+[a-z]?\s*\]$", text) and nxt.split()[0].lower() in CITING_VERBS:
        return "blank"
    return None


def trim_numeric_lead(text: str, noise: bool = False) -> str:
    """Without a first sentence of at most 30 words that opens like `2, BMP-4`, if a fresh sentence follows."""
    import re

    m = None if noise else re.match(r"\d+\s*,\s*[A-Z]{2,}-\d+\b.*?[.!?](?:\s+|$)", text)
    rest = text[m.end() :].strip() if m else ""
    first = re.search("[A-Za-z0-9]", rest)
    return rest if first and not first.group().islower() and len(m.group().split()) <= 30 else text


def repair_boundaries(paragraphs: DataFrame) -> DataFrame:
    """doc_id, first_ord, n, text: paragraphs(doc_id, ord, page, x0, y0, x1, y1, text) joined to those they continue
    (`continues`). The merged text meets the next test at its last piece's place, so this is a fold in order over each
    partition's sorted documents; it holds one merged text at a
    time and tests only its ends, so long merges cost no more than their length. Places and table noise come from the JVM; a merged
    text counts as noise as its first piece does. Null and blank texts are left out."""

    import pyarrow as pa

    from .tables import is_noise

    names = ["doc_id", "first_ord", "n", "text"]

    def fold(batches):
        now, ends, words_, at = None, "", 0, None  # [doc_id, first_ord, n, pieces]; both ends of the text; its words; place

        def done():
            return [*now[:3], trim_numeric_lead("".join(now[3]), at[3])]

        for batch in batches:
            out = []
            for doc, ord_, text, page, x, y, noise in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = text.count(" ") + 1
                how = continues((ends, *at), (text, page, x, y, noise), words_) if now is not None and now[0] == doc else None
                if how == "wrap":
                    now[3][-1] = now[3][-1][:-1]
                    now[3].append(text)
                elif how:
                    now[3].append(" " + text)
                else:
                    if now is not None:
                        out.append(done())
                    now, ends, words_, at = [doc, ord_, 0, [text]], "", 0, (page, x, y, noise)
                now[2], at = now[2] + 1, (page, x, y, at[3])
                ends = text if not ends else ends[:-1] + text if how == "wrap" else ends + " " + text
                ends = ends if len(ends) <= 800 else ends[:400] + ends[-400:]
                words_ += n - (how == "wrap")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in done()], names)

    t, page = clean_line(F.col("text")), W.partitionBy("doc_id", "page")
    place = lambda a, b: ((F.col(a) + F.col(b)) / 2 - F.min(a).over(page)) / F.greatest(F.lit(1e-6), F.max(b).over(page) - F.min(a).over(page))
    x, y = place("x0", "x1"), place("y0", "y1")
    rows = paragraphs.select("doc_id", "ord", "page", "text", "x0", "y0", "x1", "y1").repartition("doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ord").cast("long").alias("ord"), t.alias("text"), F.col("page").cast("long").alias("page"), x.alias("x"), y.alias("y"), is_noise(F.col("text")).alias("noise")).where("text <> ''")
    return rows.sortWithinPartitions("doc_id", "ord").mapInArrow(fold, "doc_id long, first_ord long, n long, text string")


def word_statistics(lines: DataFrame) -> DataFrame:
    """Per line: words, share of title-case among words with a letter, words with a digit, share of lower-case words."""
    w = words(F.col("text"))
    alpha = F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))
    upper = F.size(F.filter(w, lambda x: x.rlike(r"^\p{Lu}")))
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(F.round(a / b, 6))
    return lines.select("doc_id", "line_no", F.size(w).alias("n_words"), ratio(upper, alpha).alias("title_ratio"), F.size(F.filter(w, lambda x: x.rlike("[0-9]"))).alias("digit_words"), ratio(F.size(F.filter(w, lambda x: x.rlike(r"^\p{Ll}"))), F.size(w)).alias("lower_ratio"))
