"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest
ancestor directory by path joins.

A notice may stand anywhere in a file, so its lines, its sentences and its blocks of lines without a blank one
between (wrapped notices) are each held against the short notices; a licence file is also held as a whole against
full licence texts. The best cosine counts.

Most lines can't reach the threshold, and those go before their terms are counted, without loss: by Cauchy-Schwarz a
unit's cosine to a template is at most the length of the part of the (normed) template whose terms the unit has. So
every template has key terms, the heaviest ones, without which the rest is too short; a unit with none of any
template's key terms is out, and of the others those whose part is too short for every template.
"""

from __future__ import annotations

import functools
import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

#: Notices as their licences word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
LEAST_COSINE = 0.6
LICENSE_NAMES = r"^(?i)(licen[cs]e|copying|notice)"
TERM = "[a-z0-9]+"
SENTENCE_END = r"[.!?]+[\x20\t\r\n]+"
BLANK = r"\n[\x20\t\r\n]*\n"


@functools.cache
def licence_texts() -> tuple[tuple[str, str], ...]:
    """(license, full text) of the files beside this module, as their authors publish them."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licence_texts")
    return tuple((n.removesuffix(".txt"), open(os.path.join(folder, n), encoding="utf-8").read()) for n in sorted(os.listdir(folder)) if n.endswith(".txt"))


def templates() -> list[tuple[int, str, bool, str]]:
    """template, license, full (a whole text, for whole files), text."""
    both = [(a, False, b) for a, b in TEMPLATES] + [(a, True, b) for a, b in licence_texts()]
    return [(i, *x) for i, x in enumerate(both)]


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), f"[^{TERM[1:-2]}]+"), "")


def _words(text: str) -> list[str]:
    import re

    return re.findall(TERM, text.lower())


def _named_license(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0).rlike(LICENSE_NAMES)


def _idf(files: DataFrame) -> tuple[dict[str, float], float]:
    """idf of every term of the templates, over all files: ln((1 + N) / (1 + df)) + 1; and that of a term in no file,
    which a term outside the templates, which only makes a unit longer, is taken for. The templates' terms are a
    constant list, so what comes to the driver is bounded by it."""
    own = sorted({w for *_, t in templates() for w in _words(t)})
    has = F.array_intersect(F.array_distinct(_terms(F.col("text"))), F.array(*map(F.lit, own)))
    n = files.count()
    df = {r.term: r.n for r in files.select(F.explode(has).alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((1.0 + n) / (1.0 + df.get(w, 0))) + 1.0 for w in own}, math.log(1.0 + n) + 1.0


def _weighted(text: str, idf: dict[str, float]) -> dict[str, float]:
    """Unit vector of (1 + ln tf) * idf."""
    words = _words(text)
    w = {t: (1.0 + math.log(words.count(t))) * idf[t] for t in set(words)}
    size = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / size for t, x in w.items()}


def key_terms(weights: dict[str, float], least: float) -> set[str]:
    """The heaviest terms of a template, without which what is left is shorter than `least`."""
    rest, light = 0.0, set()
    for t, w in sorted(weights.items(), key=lambda x: (x[1], x[0])):
        rest += w * w
        if rest >= (least - 1e-6) ** 2:
            break
        light.add(t)
    return set(weights) - light


def _reach(unit: Column, vectors: list[dict[str, float]]) -> Column:
    """The most that a unit's cosine to any of the vectors can be: the length of the part whose terms it has."""
    squares = F.create_map(*[x for t in sorted(set().union(*vectors)) for x in (F.lit(t), F.array(*[F.lit(v.get(t, 0.0) ** 2) for v in vectors]))])
    hits = F.array_intersect(_terms(unit), F.map_keys(squares))
    return F.sqrt(F.array_max(F.aggregate(hits, F.array(*[F.lit(0.0)] * len(vectors)), lambda sums, t: F.zip_with(sums, squares[t], lambda a, b: a + b))))


def own_licenses(files: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """path, license, score of files (path, text) of which a unit comes close enough to a template; the best one, ties
    by license. Rows of one path count together. Units of a file: lines, sentences of a line, blocks of lines; these
    are held against the notices. A file named like a licence file is also held as a whole against the full texts.
    Weights: (1 + ln tf) * idf. Files without a close unit, null and empty texts among them, are absent."""
    spark = files.sparkSession
    idf, unseen = _idf(files)
    vectors = [(i, name, full, _weighted(t, idf)) for i, name, full, t in templates()]
    keys = sorted(set().union(*(key_terms(v, least) for _, _, full, v in vectors if not full)))
    possible = rf"(?<![a-z0-9])(?:{'|'.join(keys)})(?![a-z0-9])"
    near = files.where(F.lower("text").rlike(possible))
    text = F.col("text")
    pieces = F.flatten(F.array(F.split(text, "\n"), F.split(text, SENTENCE_END), F.split(text, BLANK)))
    parts = near.select("path", F.explode(F.array_distinct(F.filter(pieces, lambda x: F.lower(x).rlike(possible)))).alias("unit"))
    parts = parts.where(_reach(F.col("unit"), [v for *_, full, v in vectors if not full]) >= least - 1e-6).withColumn("full", F.lit(False))
    whole = files.where(_named_license(F.col("path")) & text.isNotNull()).select("path", text.alias("unit"), F.lit(True).alias("full"))
    # an id is needed for each unit: the cut fixes it
    units = cut(parts.union(whole).withColumn("unit_id", F.monotonically_increasing_id()))
    counted = units.select("unit_id", "full", F.explode(_terms(F.col("unit"))).alias("term")).groupBy("unit_id", "full", "term").agg(F.count("*").alias("tf"))
    # constant tables: the templates' terms
    weights = spark.createDataFrame(list(idf.items()), "term string, idf double")
    wide = spark.createDataFrame([(i, name, full, t, w) for i, name, full, v in vectors for t, w in v.items()], "template int, license string, full boolean, term string, tw double")
    w = cut(counted.join(F.broadcast(weights), "term", "left").select("unit_id", "full", "term", ((1.0 + F.log("tf")) * F.coalesce("idf", F.lit(unseen))).alias("w")))
    size = w.groupBy("unit_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dot = w.join(F.broadcast(wide), ["term", "full"]).groupBy("unit_id", "license", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dot.join(size, "unit_id").select("unit_id", "license", F.round(F.col("dot") / F.col("size"), 6).alias("score")).where(F.col("score") >= least)
    best = scored.join(units.select("unit_id", "path"), "unit_id").groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b"))
    return best.select("path", "b.license", (-F.col("b.minus")).alias("score"))


def _dir(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """The columns of files (path, text and any others) but text, with license, score, origin, for every row: the file's
    own licence (origin: its path), or that of the licence file in the nearest directory above it (origin: that file),
    or nulls. Columns of files named license, score or origin give way to these; other names never clash.

    Licence files are those named LICENSE, COPYING or NOTICE; of several in a directory the best score counts, ties by
    licence and path. Ancestors are listed once for each different directory, never for each file. Null paths get
    nulls; rows that share a path share its licence; an empty table gives no rows.
    """
    known = files.where("path is not null").select("path", "text")
    own = cut(own_licenses(known, least))
    marked = own.where(_named_license(F.col("path"))).groupBy(_dir(F.col("path")).alias("above")).agg(F.min(F.struct((-F.col("score")).alias("minus"), "license", "path")).alias("m"))
    dirs = known.select(_dir(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("above")).distinct()
    nearest = above.join(marked, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "m")).alias("x")).select("dir", "x.m")
    kept = [c for c in files.columns if c not in ("text", "license", "score", "origin")]
    rows = files.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("path").alias("at"), _dir(F.col("path")).alias("in_dir"))
    mine = own.select(F.col("path").alias("own_path"), F.col("license").alias("own_license"), F.col("score").alias("own_score"))
    both = rows.join(mine, F.col("at") == F.col("own_path"), "left").join(nearest, F.col("in_dir") == F.col("dir"), "left")
    return both.select("row.*", F.coalesce("own_license", "m.license").alias("license"), F.coalesce("own_score", -F.col("m.minus")).alias("score"), F.when(F.col("own_license").isNotNull(), F.col("at")).otherwise(F.col("m.path")).alias("origin"))


def as_files(docs: DataFrame) -> DataFrame:
    """documents laid out as a tree under their source: doc_id, path, text. Ids divisible by 64 or 8 stand for the
    licence files of the two levels of directories, the others for files below them."""
    i = F.col("doc_id")
    top, sub = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.expr("doc_id div 64").cast("string")), F.expr("doc_id div 8 % 8").cast("string")
    path = F.when(i % 64 == 0, F.concat_ws("/", top, F.lit("LICENSE"))).when(i % 8 == 0, F.concat_ws("/", top, sub, F.lit("COPYING"))).otherwise(F.concat_ws("/", top, sub, F.concat(i.cast("string"), F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


def op6_license_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(as_files(table(spark, sf_dir, "documents"))).select("doc_id", "path", "license", "score", "origin")


_QUOTED = lambda x: "'" + x.replace("'", "''") + "'"
_ROWS = ", ".join(f"({i}, {_QUOTED(a)}, {full}, {_QUOTED(b)})" for i, a, full, b in templates())
SQL = rf"""
WITH f AS (SELECT doc_id, text, coalesce(source, 'none') || '/' || (doc_id // 64) || CASE WHEN doc_id % 64 = 0 THEN '/LICENSE' WHEN doc_id % 8 = 0 THEN '/' || (doc_id // 8 % 8) || '/COPYING' ELSE '/' || (doc_id // 8 % 8) || '/' || doc_id || '.txt' END AS path FROM documents),
tp(template, license, "full", body) AS (VALUES {_ROWS}),
tt AS (SELECT template, license, "full", unnest(regexp_extract_all(lower(body), '{TERM}')) AS term FROM tp),
tc AS (SELECT template, license, "full", term, 1.0 + ln(count(*)) AS tf FROM tt GROUP BY ALL),
n AS (SELECT count(*) AS n FROM f),
df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) AS term FROM f) GROUP BY term),
idf AS (SELECT term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0 AS idf FROM (SELECT DISTINCT term FROM tc) LEFT JOIN df USING (term), n),
u AS (SELECT row_number() OVER () AS u, path, "full", unit FROM (
  SELECT DISTINCT path, false AS "full", unnest(string_split(text, chr(10)) || regexp_split_to_array(text, '{SENTENCE_END}') || regexp_split_to_array(text, '{BLANK}')) AS unit FROM f
  UNION ALL SELECT path, true, text FROM f WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{LICENSE_NAMES}') AND text IS NOT NULL)),
ut AS (SELECT u, path, "full", unnest(regexp_extract_all(lower(unit), '{TERM}')) AS term FROM u),
w AS (SELECT u, path, "full", term, (1.0 + ln(count(*))) * coalesce(any_value(idf), (SELECT ln(1.0 + n) + 1.0 FROM n)) AS w FROM ut LEFT JOIN idf USING (term) GROUP BY ALL),
t AS (SELECT template, license, "full", term, tf * idf AS w FROM tc JOIN idf USING (term)),
un AS (SELECT u, sqrt(sum(w * w)) AS size FROM w GROUP BY u),
tn AS (SELECT template, sqrt(sum(w * w)) AS size FROM t GROUP BY template),
dot AS (SELECT u, path, license, template, sum(w.w * t.w) AS dot FROM w JOIN t USING (term, "full") GROUP BY ALL),
s AS (SELECT path, license, round(dot / un.size / tn.size, 6) AS score FROM dot JOIN un USING (u) JOIN tn USING (template)),
own AS (SELECT path, license, score FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, license) AS r FROM s WHERE score >= {LEAST_COSINE}) WHERE r = 1),
m AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS above, license, score, path FROM (SELECT *, row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY score DESC, license, path) AS r FROM own WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{LICENSE_NAMES}')) WHERE r = 1),
d AS (SELECT doc_id, f.path, m.license, m.score, m.path AS origin, row_number() OVER (PARTITION BY doc_id ORDER BY length(m.above) DESC NULLS LAST) AS r FROM f LEFT JOIN m ON starts_with(f.path, m.above || '/'))
SELECT d.doc_id, d.path, coalesce(own.license, d.license) AS license, coalesce(own.score, d.score) AS score, CASE WHEN own.path IS NOT NULL THEN own.path ELSE d.origin END AS origin
FROM d LEFT JOIN own ON own.path = d.path WHERE d.r = 1
"""
