"""Host-level quality rules, with DataFrame functions only.

Each document gets counts and rule verdicts; failures are summed by host; a beta prior fitted to all hosts shrinks each
host's failure rate; the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free, let, table

GAP = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host is bad if its rate lies so many standard deviations of the prior above the prior's mean,
PRIOR_DEVIATIONS = 3.0
#: and at this multiple of that mean at least, so that hosts that differ little are all kept;
LEAST_MULTIPLE = 2.0
#: however wide the prior is, no more than this part of the way from the mean to 1 is asked for.
MOST_PART = 0.5
#: Bounds of the prior's weight in documents: hosts that differ no more than chance says share one rate.
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1e6


def _repeat_words(words: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more (windows are compared by their 64-bit hash)."""
    hashes = F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.slice(F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW)))), F.lit(1), F.size(words) - WINDOW + 1))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = lambda s: F.transform(F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))), lambda x: x["i"])
        spans = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.get(p, k + 1) - x)), F.lit(0), lambda a, x: a + x)
        return let(F.sort_array(let(ranked, again)), spans)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def measures(text: Column) -> Column:
    """A struct of one text's counts; null counts as the empty text."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")
    return F.struct(by_words.alias("w"), by_lines.alias("l"), symbols.alias("n_symbols"))


def rules(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """One row per document: doc_id, host, the counts, base_failed, any_failed. Only the named columns of docs are read.

    Null texts have no words and fail the base rules; a null host is a host of its own; repeated rows stay repeated.
    """
    m = docs.select(F.col("doc_id"), F.col(host).alias("host"), measures(F.col(text)).alias("m"))
    m = m.select("doc_id", "host", "m.w.n_words", "m.w.word_chars", "m.n_symbols", "m.l.n_dup_lines", "m.w.n_repeat_words", "m.l.n_lines")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    soft = (10 * F.col("n_symbols") > F.col("n_words")) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")) | (F.col("word_chars") > 15 * F.col("n_words")) | (F.col("word_chars") < 2 * F.col("n_words"))
    return m.withColumn("base_failed", base).withColumn("any_failed", base | soft)


def host_verdicts(ruled: DataFrame) -> DataFrame:
    """host, n, failed, rate, host_ok. The prior is Beta(m*k, (1-m)*k): m the failure rate of all documents, k from the
    variance between hosts by moments, after what sampling alone gives (m * (1-m) * (hosts - 1)) is taken off.
    rate = (failed + m*k) / (n + k). A host is bad if its rate exceeds the prior's upper limit: m + 3 standard
    deviations of the prior, at least 2 * m, at most halfway from m to 1. No documents give no rows."""
    hosts = cut(ruled.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("any_failed").cast("long")).alias("failed")))
    total, failed, squares, count = hosts.agg(F.sum("n"), F.sum("failed"), F.sum(F.col("n").cast("double") * F.col("n")), F.count("*")).first()
    if not total:
        return hosts.withColumn("rate", F.lit(0.0)).withColumn("host_ok", F.lit(True))
    m = failed / total
    spread = hosts.agg(F.sum(F.col("n") * (F.col("failed") / F.col("n") - m) ** 2)).first()[0]
    free = total - squares / total
    between = (spread - m * (1 - m) * (count - 1)) / free if free > 0 else 0.0
    k = min(MAX_WEIGHT, max(MIN_WEIGHT, m * (1 - m) / between - 1)) if between > 0 else MAX_WEIGHT
    limit = min(max(m + PRIOR_DEVIATIONS * (m * (1 - m) / (k + 1)) ** 0.5, LEAST_MULTIPLE * m), m + MOST_PART * (1 - m))
    return hosts.withColumn("rate", (F.col("failed") + m * k) / (F.col("n") + k)).withColumn("host_ok", F.col("rate") <= limit)


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """rules() with kept: base rules passed and the host's verdict good. The counts are written once to the shared
    folder, so texts are read once; empty input gives no rows."""
    ruled = cut(rules(docs, host))
    verdicts = host_verdicts(ruled).select(F.col("host").alias("_host"), "host_ok")
    out = ruled.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_ok"), F.lit(True))).drop("_host")


def keep(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that judge() keeps, with the columns of docs. Texts aren't shuffled: the base rules are evaluated
    again beside them and only the hosts' verdicts are joined."""
    verdicts = host_verdicts(cut(rules(docs, host).select("host", "any_failed")))
    m, host_name = free(docs, "_m"), free(docs, "_bad_host")
    bad = verdicts.where("not host_ok").select(F.col("host").alias(host_name))
    sized = docs.withColumn(m, measures(F.col("text")))
    n = F.col(f"{m}.w.n_words")
    good = sized.where((n >= MIN_WORDS) & (100 * F.col(f"{m}.w.n_repeat_words") <= MAX_REPEAT_PERCENT * n)).drop(m)
    return good.join(bad, F.col(host).eqNullSafe(F.col(host_name)), "left_anti")


def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t)),
g AS (SELECT r, p, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS gram FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
d AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS c FROM g WHERE gram IS NOT NULL) WHERE c > 1),
rep AS (SELECT r, sum(s)::BIGINT AS n_repeat_words FROM (SELECT r, least({WINDOW}, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, {WINDOW})) AS s FROM d) GROUP BY r),
wc AS (SELECT r, count(*)::BIGINT AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY r),
ln AS (SELECT r, count(*) AS n_lines, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM t LEFT JOIN wc USING (r) LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
a AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars > 15 * n_words OR word_chars < 2 * n_words AS any_failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (any_failed) AS x FROM a GROUP BY source),
z AS (SELECT sum(x) / sum(n) AS m, sum(n) AS total, sum(n) - sum(n::DOUBLE * n) / sum(n) AS free, count(*) AS hosts FROM h),
s AS (SELECT any_value(m) AS m, CASE WHEN any_value(free) > 0 THEN (sum(n * (x / n - m) ** 2) - any_value(m * (1 - m) * (hosts - 1))) / any_value(free) ELSE 0 END AS v FROM h, z),
k AS (SELECT m, CASE WHEN v > 0 THEN least({MAX_WEIGHT}, greatest({MIN_WEIGHT}, m * (1 - m) / v - 1)) ELSE {MAX_WEIGHT} END AS k FROM s),
v AS (SELECT source, (x + m * k) / (n + k) <= least(greatest(m + {PRIOR_DEVIATIONS} * sqrt(m * (1 - m) / (k + 1)), {LEAST_MULTIPLE} * m), m + {MOST_PART} * (1 - m)) AS host_ok FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM a JOIN v ON a.source IS NOT DISTINCT FROM v.source
"""
