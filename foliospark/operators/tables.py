"""Table text: likelihood scores, noise, artifact paragraphs and the spans they form, plausible assets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_line, let, words
from .roles import NUMBER, caption_kind, count_of, hits, is_compact_label, lower_share

#: Words of table cells and of table heads; fields, signs of front matter, heads of comparison tables.
DESCRIPTORS = ("high", "low", "poor", "limited", "excellent", "good", "mechanical", "biocompatibility", "conductivity", "surface area", "resistance", "stability")
HEADS = ("advantages", "disadvantages", "applications", "references", "coefficient", "type")
FRONT = r"\borcid\b|\bdoi\b|\bkeywords:\b|\bkey words:\b|\breceived:|\baccepted:|\brevised:|\bpublished online:|\bcopyright\b|\bthis article is protected\b|\bcorrespondence\b"
FIELDS = ("advantage:", "disadvantage:", "pros:", "cons:", "benefits:", "limitations:", "specifications:", "tolerances:")
UNITS = r"\b\d+\.?\d*\s+(mm|cm|kg|hz|khz|mhz|kv|ma|w|v|degrees?|°)\b"
WORD = r"[A-Za-z0-9]+(?:[''’\-/][A-Za-z0-9]+)?"
END = r"[.!?]\s*$"


def score(c: Column) -> Column:
    """How much a text looks like a table's: lists by semicolons, numbers beside descriptors, `d33 =`, column heads and
    continuations count for it, a long closed sentence against it. Null and wordless texts are 0."""
    t = clean_line(c)
    low, n, end = F.lower(t), count_of(t, r"[A-Za-z0-9]+(?:[\-/][A-Za-z0-9]+)?"), t.rlike(END)
    semicolons = count_of(t, ";")
    add = lambda test, v: F.when(test, F.lit(v)).otherwise(F.lit(0.0))
    parts = (
        add((semicolons >= 1) & (n <= 80), 1.6),
        add((count_of(t, NUMBER) >= 1) & (hits(low, DESCRIPTORS) >= 1), 1.2),
        add(low.rlike(r"\bd\d{1,2}\s*="), 1.2),
        add((hits(low, HEADS) >= 2) & (n <= 24) & ~end, 1.0),
        add(F.contains(low, F.lit("table")) & F.contains(low, F.lit("continued")), 0.8),
        add(end & (semicolons == 0) & (n >= 24), -1.5),
    )
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(reduce(lambda a, b: a + b, parts), 6))


def is_noise(c: Column) -> Column:
    """Rows, heads and front matter that don't belong to the main body; in doubt false."""
    t = clean_line(c)
    low, w = F.lower(t), words(t)
    has = lambda part: F.contains(low, F.lit(part))
    n, end, semicolons, breaks, numbers = F.size(w), t.rlike(END), count_of(t, ";"), count_of(t, "[.!?]"), count_of(t, r"\b\d+\.?\d*\b")
    capitals = F.size(F.filter(w, lambda x: x.rlike(r"^\p{Lu}") & (F.length(x) <= 12)))
    figures = F.size(F.filter(w, lambda x: x.rlike(r"^\d+\.?\d*$")))
    fields, prose = hits(low, FIELDS) > 0, lower_share(w)
    return (
        F.when(t.rlike(r"^\[[\d\s,]+\]$"), True).when(F.length(t) < 8, False).when(low.rlike(FRONT), True)
        .when(low.rlike(r"\btable\s*\d+\s*[.)]?\s*\(continued\)|^table\s+\d+(?:\.\d+)*\.\s+"), True).when(has("advantages") & has("disadvantages"), True)
        .when((n <= 12) & ((has("advantage") & has("disadvantage")) | (has("benefit") & has("limitation"))), True)
        .when(t.rlike(r"^\d+(?:\.\d+)*\.?\s+[A-Za-z]") & (n <= 20) & ~has("table") & ~has("figure"), False).when(n < 4, False)
        .when((n <= 32) & (semicolons >= 2) & ~end & ((prose <= 0.62) | (count_of(t, NUMBER) >= 2)), True)
        .when((n <= 24) & (semicolons >= 1) & t.rlike(r"\b\d+\s*[×x]\s*10\b|\b10\s*[−-]\s*\d+\b") & ~end, True)
        .when((n >= 18) & (breaks >= 1) & (prose >= 0.55) & ~fields, False)
        .when(n.between(5, 24) & (capitals >= 0.6 * n) & (capitals >= 4), True).when((n <= 24) & (count_of(low, UNITS) >= 2) & (breaks <= 1), True)
        .when((n <= 12) & (numbers >= 3), True).when(fields, True)
        .when(n.between(5, 28) & (count_of(t, r"\b[A-Z][a-z]{1,8}\b") >= 4) & t.rlike(r"[,;]\s+[A-Z][a-z]") & (breaks == 0), True)
        .otherwise((n <= 10) & (figures >= 0.6 * n) & (figures >= 3))
    )


def is_artifact(c: Column) -> Column:
    """A paragraph that is probably a piece of a table: bracketed numbers, lists, short capitalised items, dense numbers,
    heads, loose citations."""
    t = clean_line(c)
    n, closed = count_of(t, WORD), t.rlike("[.!?]$")
    bracketed = F.contains(t, F.lit("[")) & F.contains(t, F.lit("]"))
    upper = F.size(F.filter(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda x: x.rlike("^[A-Z]")))
    return (n > 0) & (
        t.rlike(r"^\[\s*\d+(?:\s*[,;]\s*\d+)*\s*\]$")
        | (F.contains(t, F.lit(";")) & (n <= 34) & ~closed)
        | ((n <= 6) & t.rlike(r"^[A-Z][A-Za-z0-9\-]*(?:\s+[A-Za-z][A-Za-z0-9\-]*){0,5}(?:\s*\([^)]+\))?$"))
        | ((count_of(t, NUMBER) >= 3) & (n <= 24))
        | ((n <= 10) & (upper >= F.greatest(F.lit(2), F.floor(n * 0.6))) & ~t.rlike("[.;]"))
        | (bracketed & (n <= 18) & ~closed)
    )


def artifact_spans(paragraphs: DataFrame, tables: DataFrame) -> DataFrame:
    """doc_id, first_ord, last_ord, n_paragraphs: spans of a document's paragraphs(doc_id, ord, text) that its tables,
    tables(doc_id, n_tables), left in the text. Documents without a table have none.

    Runs of artifacts come from one window. A run starts a span if it holds a semicolon or number and has two paragraphs
    or at most 14 words; neighbouring runs of two or more join across one paragraph at most; spans join across up to two
    bridging paragraphs. Only where spans outnumber tables are the closest joined (six paragraphs apart at most), then
    the longest kept. The last steps see short rows of one document's runs, never texts."""
    order = W.partitionBy("doc_id").orderBy("ord")
    t = clean_line(F.col("text"))
    n = count_of(t, WORD)
    bridge = ~t.rlike("[.!?]$") & ((n <= 6) | (F.contains(t, F.lit("[")) & F.contains(t, F.lit("]")) & (n <= 12)))
    p = paragraphs.join(tables.where("n_tables > 0"), "doc_id").select("doc_id", "ord", "n_tables", is_artifact(F.col("text")).alias("a"), bridge.alias("b"), n.alias("n"), (F.contains(t, F.lit(";")) | t.rlike(NUMBER)).alias("signal"), (t != "").alias("some")).where("some")
    p = p.select("*", F.row_number().over(order).alias("pos"), F.lag("b").over(order).alias("b1"), F.lag("b", 2).over(order).alias("b2"), F.sum((~F.col("a")).cast("int")).over(order).alias("run"))
    runs = p.where("a").groupBy("doc_id", "run").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"), F.bool_or("signal").alias("signal"), F.min_by("n", "pos").alias("words"), F.coalesce(F.min_by("b1", "pos"), F.lit(False)).alias("b1"), F.coalesce(F.min_by("b2", "pos"), F.lit(False)).alias("b2"), F.max("n_tables").alias("n_tables"))
    each = F.array_sort(F.collect_list(F.struct("lo", "hi", "first_ord", "last_ord", "signal", "words", "b1", "b2")))
    rows = runs.groupBy("doc_id").agg(each.alias("runs"), F.max("n_tables").alias("n_tables")).select(F.col("doc_id").cast("long").alias("doc_id"), "runs", "n_tables")

    def joined(batches):
        import pyarrow as pa

        for batch in batches:
            out = [(doc, s[2], s[3], s[1] - s[0] + 1) for doc, own, most in zip(*(c.to_pylist() for c in batch.columns), strict=True) for s in _spans(own, int(most))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "first_ord", "last_ord", "n_paragraphs"])

    return rows.mapInArrow(joined, "doc_id long, first_ord long, last_ord long, n_paragraphs long")


def _spans(runs: list[dict], most: int) -> list[list]:
    """[lo, hi, first_ord, last_ord] of one document's spans; its runs come in order."""
    seeds = [r["signal"] and (r["hi"] > r["lo"] or r["words"] <= 14) for r in runs]
    chosen = list(seeds)
    for steps, back in ((range(1, len(runs)), 1), (range(len(runs) - 2, -1, -1), -1)):
        reach = list(seeds)
        for i in steps:
            near = abs(runs[i]["lo"] - runs[i - 1]["hi"] if back == 1 else runs[i + 1]["lo"] - runs[i]["hi"]) <= 2
            reach[i] = reach[i] or (reach[i - back] and near and runs[i]["hi"] > runs[i]["lo"])
            chosen[i] = chosen[i] or reach[i]
    spans: list[list] = []
    for r in (r for r, c in zip(runs, chosen, strict=True) if c):
        gap = r["lo"] - spans[-1][1] - 1 if spans else None
        if gap is not None and (gap <= 0 or (gap == 1 and r["b1"]) or (gap == 2 and r["b1"] and r["b2"])):
            spans[-1][1::2] = [r["hi"], r["last_ord"]]
        else:
            spans.append([r["lo"], r["hi"], r["first_ord"], r["last_ord"]])
    while len(spans) > most:
        gap, i = min(((b[0] - a[1] - 1, i) for i, (a, b) in enumerate(zip(spans, spans[1:], strict=False))), default=(7, 0))
        if gap > 6:
            break
        spans[i][1::2] = spans.pop(i + 1)[1::2]
    if len(spans) > most:
        longest = sorted(range(len(spans)), key=lambda i: (spans[i][1] - spans[i][0], i))[-most:]
        spans = [spans[i] for i in sorted(longest)]
    return spans


def plausible_assets(assets: DataFrame, width: float = 595.0, height: float = 791.0) -> DataFrame:
    """Assets large enough for body content; those without caption must be larger and outside the margins."""
    w, h = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")), F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    area, y = w * h / (width * height), (F.col("y0") + F.col("y1")) / 2 / height
    return assets.where(F.when(F.col("caption_id").isNotNull(), (w >= 35) & (h >= 25) & (area >= 0.0006)).otherwise((w >= 70) & (h >= 55) & (area >= 0.004) & y.between(0.1, 0.92)))


#: Words of figures' labels; abbreviations of statistics beside their numbers.
CHART_TERMS = ("pathway", "pathways", "response", "signaling", "interaction", "contraction", "chemokine", "cytokine", "feature")
STATISTIC = r"\b(or|hr|auc)\b"


def is_chart_noise(c: Column) -> Column:
    """Labels and numbers out of figures: compact labels, captions inside, p-value axes, bare numbers, single words,
    statistics beside numbers, lists of chart terms, mostly numbers. Null and blank texts are none."""
    def judged(t: Column, w: Column) -> Column:
        low, n, open_end = F.lower(t), F.size(w), ~t.rlike(r"[.!?]\s*$")
        numbers = count_of(t, r"\b\d+(?:\.\d+)?\b")
        terms = sum((F.contains(low, F.lit(x)).cast("int") for x in CHART_TERMS), F.lit(0))
        return (t != "") & (
            F.coalesce(is_compact_label(t), F.lit(False)) | caption_kind(t).isNotNull() | low.rlike(r"-log10\s*\(p-?value\)") | ((numbers >= 2) & t.rlike(r"^[\d\s.+-]+$"))
            | ((n <= 2) & open_end & ((numbers >= 1) | t.rlike(r"^[A-Za-z][A-Za-z0-9_-]{0,11}$"))) | ((n <= 10) & (numbers >= 1) & open_end & low.rlike(STATISTIC))
            | ((n <= 24) & open_end & (terms >= 3)) | ((n <= 12) & open_end & (numbers >= F.greatest(F.lit(2), F.floor(n / 2))))
        )

    return let(clean_line(c), lambda t: let(F.array_remove(F.split(t, " "), ""), lambda w: judged(t, w)))
