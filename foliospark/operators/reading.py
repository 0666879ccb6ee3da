"""Facts, themes and key lines out of paragraphs(doc_id, para_id, role, text, confidence, page, ord, narrative)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import count_words, first_statement, has_digit, let, quote, starts_upper, words

#: The first list with a hit names the category.
CATEGORIES = (
    ("recommendation", ("recommend", "should", "guideline", "建议", "应当")),
    ("limitation", ("limitation", "future work", "不足", "局限")),
    ("statistics", ("increase", "decrease", "odds", "p<", "p =", "significant", "%", "率")),
    ("comparison", ("compared", "versus", "vs", "higher than", "lower than", "相比", "高于", "低于")),
    ("mechanism", ("mechanism", "pathway", "mediated", "机制", "通路")),
    ("definition", ("defined", "definition", "classified", "定义", "分类")),
    ("result", ("result", "found", "showed", "conclude", "发现", "结果", "结论")),
)
#: Words that raise a candidate's or a key line's score.
SIGNALS = ("significant", "increase", "decrease", "risk", "associated")
KEY_SIGNALS = ("risk", "increase", "decrease", "outcome", "associated", "repair", "tear")
MAX_CANDIDATES = 160


def any_of(c: Column, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def category(c: Column) -> Column:
    low, out = F.lower(c), F.lit("background")
    for name, parts in reversed(CATEGORIES):
        out = F.when(any_of(low, parts), name).otherwise(out)
    return out


def is_noise_statement(c: Column, w: Column | None = None) -> Column:
    """w: the words of c, if they are known."""
    w, low = words(c) if w is None else w, F.lower(c)
    n = F.size(w)
    commas = F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))
    return any_of(low, ("department of", "orcid", "check for updates")) | (n < 5) | ((n <= 45) & (count_words(w, has_digit) >= 3) & (commas >= 2)) | ((n <= 50) & (count_words(w, starts_upper) > 0.6 * n) & (commas >= 2))


def is_strong_claim(statement: Column, kind: Column) -> Column:
    """Categories that assert something, or a number, a comparison, a cause or an advice."""
    return kind.isin("result", "statistics", "comparison", "limitation") | F.lower(statement).rlike(r"\d|\b(better|worse|superior|inferior|more effective|less effective|causes|leads to|results in|associated with|should|must|recommended|guideline)\b")


def fact_candidates(paragraphs: DataFrame, most: int = MAX_CANDIDATES) -> DataFrame:
    """The best statements of each document: narrative ones first, a quarter as many others where there are
    eight narrative ones or more. Ties keep the order of paragraphs."""
    def judged(statement: Column, w: Column) -> Column:
        low = F.lower(statement)
        score = F.least(F.lit(40), F.size(w)) + F.col("confidence") * 10 + F.when(F.col("role") == "Heading", -8).when(F.col("role") == "Body", 8).when(F.col("role").isin("FigureCaption", "TableCaption"), -10).otherwise(0) + F.when(statement.rlike("[0-9]"), 6).otherwise(0) + F.when(any_of(low, SIGNALS), 6).otherwise(0) + F.when(F.col("narrative"), 18).otherwise(-22)
        text, cut = quote(statement)
        good = (statement != "") & ~is_noise_statement(statement, w)
        return F.when(good, F.struct(statement.alias("statement"), category(statement).alias("category"), text.alias("quote"), cut.alias("quote_truncated"), F.round(score, 6).alias("score")))

    # the statement and its words are looked at by many rules and made once
    found = let(first_statement(F.col("text")), lambda st: let(words(st), lambda w: judged(st, w)))
    c = paragraphs.select("doc_id", "para_id", "page", "ord", "narrative", F.explode(F.array_compact(F.array(found))).alias("s")).select("doc_id", "para_id", "page", "ord", "narrative", "s.*")
    r = c.withColumn("r", F.row_number().over(W.partitionBy("doc_id", "narrative").orderBy(F.desc("score"), "ord")))
    n = F.least(F.lit(most), F.sum(F.col("narrative").cast("int")).over(W.partitionBy("doc_id")))
    room = F.lit(most) - F.col("n")
    others = F.when(F.col("n") >= 8, F.least(room, F.greatest(F.lit(1), F.floor(F.col("n") / 4)))).otherwise(room)
    return r.withColumn("n", n).where(F.when(F.col("narrative"), F.col("r") <= most).otherwise(F.col("r") <= others)).drop("r", "n")


def balanced_selection(paragraphs: DataFrame, most: int = 220) -> DataFrame:
    """doc_id, para_id of at most `most` paragraphs: the best of every section, then the best of the rest."""
    n = F.size(words(F.col("text")))
    score = F.least(F.lit(70), n) + F.col("confidence") * 10 + F.when(F.col("role") == "Heading", 12).when(F.col("role") == "Body", 4).otherwise(0) + F.when(n.between(18, 180), 6).otherwise(0)
    c = paragraphs.where((n >= 5) | (F.col("role") == "Heading")).withColumn("score", score).withColumn("section", F.coalesce("section", F.format_string("page_%03d", F.col("page"))))
    sections = c.groupBy("doc_id").agg(F.countDistinct("section").alias("k"))
    per = F.greatest(F.lit(3), F.least(F.lit(12), F.expr(f"{most} div k").cast("int")))
    c = c.join(sections, "doc_id").withColumn("r", F.row_number().over(W.partitionBy("doc_id", "section").orderBy(F.desc("score"), "page", "para_id"))).withColumn("own", F.col("r") <= per)
    c = c.withColumn("g", F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("own"), F.when(F.col("own"), F.lit(0.0)).otherwise(-F.col("score")), "ord")))
    return c.where(F.col("g") <= most).select("doc_id", "para_id", "section", F.round("score", 6).alias("score"))


def themes(facts: DataFrame) -> DataFrame:
    """One theme for each category of a document, numbered by name, with up to 20 fact ids in order."""
    g = facts.where("category <> 'none'").groupBy("doc_id", "category").agg(F.count("*").alias("n_facts"), F.transform(F.slice(F.array_sort(F.collect_list(F.struct("ord", "fact_id"))), 1, 20), lambda x: x["fact_id"]).alias("ids"))
    no = F.row_number().over(W.partitionBy("doc_id").orderBy("category"))
    return g.select("doc_id", F.format_string("theme_%03d", no).alias("theme_id"), "category", F.array_join("ids", ",").alias("fact_ids"), F.when(F.col("n_facts") >= 3, "moderate").otherwise("weak").alias("strength"))


def key_lines(facts: DataFrame, most: int = 8) -> DataFrame:
    """A document's best statements for a summary."""
    low = F.lower("statement")
    score = F.least(F.lit(60), F.size(words(F.col("statement")))) + F.when(F.col("category") != "none", 12).otherwise(0) + F.when(any_of(low, KEY_SIGNALS), 10).otherwise(0)
    r = facts.where(~is_noise_statement(F.col("statement"))).withColumn("s", score).withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("s"), "ord")))
    return r.where(F.col("r") <= most).select("doc_id", F.concat(F.lit("line_"), "fact_id").alias("line_id"), F.substring("statement", 1, 200).alias("statement"), F.col("r").alias("rank"))


def evidence_edges(facts: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """doc_id, source, target, relation: facts derived from paragraphs, paragraphs located on pages."""
    derived = facts.select("doc_id", F.col("fact_id").alias("source"), F.col("para_id").alias("target"), F.lit("derived_from").alias("relation"))
    located = paragraphs.join(facts.select("doc_id", "para_id").distinct(), ["doc_id", "para_id"], "left_semi").select("doc_id", F.col("para_id").alias("source"), F.concat(F.lit("page_"), F.col("page").cast("string")).alias("target"), F.lit("located_near").alias("relation"))
    return derived.union(located)


def is_noise_paragraph(text: Column, role: Column, page: Column) -> Column:
    """Contact lines, address and author lists, fragments: what no fact is taken from."""
    low, w = F.lower(text), words(text)
    n = F.size(w)
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    short = count_words(w, lambda x: F.length(F.regexp_replace(x, r"^[.,;:()\[\]]+|[.,;:()\[\]]+$", "")) <= 2)
    return (
        (F.trim(text) == "") | role.isin("HeaderFooter", "ReferenceList") | any_of(low, ("orcid.org", "check for updates")) | (any_of(text, ("@",)) & (n < 12))
        | (low.rlike(r"\bdepartment of\b") & low.rlike(r"\buniversity\b")) | ((commas >= 6) & low.rlike(r"\b(and|et al|jr|iii)\b"))
        | ((n < 20) & (short > 0.55 * n)) | ((page <= 2) & (count_words(w, has_digit) >= 3) & (commas >= 3) & (n <= 45))
        | ((page <= 2) & (n <= 50) & (count_words(w, starts_upper) > 0.55 * n) & (commas >= 2)) | ~text.rlike(r"\p{L}")
    )


#: What a full summary needs.
FULL_FACTS, FULL_THEMES, FULL_RATIO = 12, 3, 0.8


def summary_status(documents: DataFrame, facts: DataFrame, paragraphs: DataFrame, themes: DataFrame, key_lines: DataFrame) -> DataFrame:
    """doc_id, status, reasons, ratio for every document: full, or degraded with its reasons in order. The ratio is the
    share of key lines (doc_id, line_id, fact_id) whose known facts all come from narrative paragraphs."""
    n = facts.join(paragraphs.select("doc_id", "para_id", "narrative"), ["doc_id", "para_id"], "left").select("doc_id", "fact_id", F.coalesce("narrative", F.lit(False)).alias("narrative"))
    f = n.groupBy("doc_id").agg(F.count("*").alias("facts"), F.countDistinct(F.when(F.col("narrative"), F.col("fact_id"))).alias("narrative_facts"))
    lines = key_lines.join(n, ["doc_id", "fact_id"]).groupBy("doc_id", "line_id").agg(F.bool_and("narrative").alias("ok")).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if("ok").alias("ok_lines"))
    t = themes.groupBy("doc_id").agg(F.count("*").alias("themes"))
    d = documents.join(f, "doc_id", "left").join(t, "doc_id", "left").join(lines, "doc_id", "left").fillna(0)
    ratio = F.when(F.col("lines") > 0, F.round(F.col("ok_lines") / F.col("lines"), 6)).otherwise(0.0)
    tests = ((F.col("facts") == 0, "missing_facts"), (F.col("themes") == 0, "missing_themes"), (F.col("lines") == 0, "missing_synthesis"), (F.col("narrative_facts") < FULL_FACTS, "insufficient_narrative_facts"), (F.col("themes") < FULL_THEMES, "insufficient_themes"), (F.col("lines") == 0, "missing_key_evidence_fact_links"), (ratio < FULL_RATIO, "low_narrative_coverage"))
    reasons = F.concat_ws(",", *(F.when(t, name) for t, name in tests))
    return d.select("doc_id", F.when(reasons == "", "full").otherwise("degraded").alias("status"), reasons.alias("reasons"), ratio.alias("ratio"))
