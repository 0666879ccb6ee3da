"""Queries of lineage, paragraphs from blocks, bibliographies and validation, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import bibliography, lineage
from .base import query
from .derive import derived

_ROLE = "CASE ord % 6 WHEN 0 THEN 'body_text' WHEN 1 THEN 'section_heading' WHEN 2 THEN 'reference_entry' WHEN 3 THEN 'main_title' WHEN 4 THEN 'nuisance' END"
_SOURCES = "SELECT doc_id, para_id, page, role, section, ord, block_id FROM paragraphs UNION ALL SELECT doc_id, para_id, page, role, section, ord, 'p' || page || '_b' || (ord + 1) FROM paragraphs WHERE ord % 3 = 1"
_ROLES = f"cr AS (SELECT doc_id, block_id, {_ROLE} AS r FROM blocks WHERE {_ROLE} IS NOT NULL), so AS ({_SOURCES}), pr AS (SELECT doc_id, para_id, coalesce(list_sort(list(DISTINCT r) FILTER (r IS NOT NULL)), []) AS roles FROM so LEFT JOIN cr USING (doc_id, block_id) GROUP BY ALL)"


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = derived(spark, sf_dir, "paragraphs").select("doc_id", "para_id", "page", "role", "section", "ord", "block_id")
    return p.union(p.where("ord % 3 = 1").withColumn("block_id", F.expr("concat('p', page, '_b', ord + 1)")))


def _clean_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "blocks").select("doc_id", "block_id", F.expr(_ROLE).alias("role")).where("role is not null")


@query(f"WITH cr AS (SELECT doc_id, block_id, {_ROLE} AS r FROM blocks) SELECT doc_id, block_id, coalesce(r, 'Body') AS role FROM cr")
def block_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.block_roles(derived(spark, sf_dir, "blocks").select("doc_id", "block_id"), _clean_roles(spark, sf_dir))


@query(f"WITH {_ROLES} SELECT doc_id, para_id, array_to_string(roles, ',') AS roles FROM pr")
def paragraph_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.paragraph_roles(_sources(spark, sf_dir), _clean_roles(spark, sf_dir)).withColumn("roles", F.array_join("roles", ","))


@query(f"""WITH {_ROLES} SELECT p.doc_id, p.para_id, role = 'Body' AND NOT (ord % 5 = 0) AND NOT list_has_any(roles, ['nuisance', 'reference_entry', 'figure_caption', 'table_caption']) AND (len(roles) = 0 OR list_has_any(roles, ['body_text', 'section_heading', 'main_title'])) AS narrative
FROM paragraphs p JOIN pr ON p.doc_id = pr.doc_id AND p.para_id = pr.para_id""")
def narrative_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("ord") % 5 == 0, F.array(F.lit("Main"), F.lit(" Document  Metadata"))).when(F.col("ord") % 5 == 1, F.array(F.col("section")))
    p = derived(spark, sf_dir, "paragraphs").select("doc_id", "para_id", "role", path.alias("section_path"))
    return lineage.narrative_candidates(p, lineage.paragraph_roles(_sources(spark, sf_dir), _clean_roles(spark, sf_dir))).select("doc_id", "para_id", "narrative")


@query(f"""WITH so AS ({_SOURCES}) SELECT DISTINCT doc_id, para_id FROM so s WHERE role NOT LIKE '%Caption' AND EXISTS (SELECT 1 FROM so c WHERE c.doc_id = s.doc_id AND c.page = s.page AND c.block_id = s.block_id AND c.role LIKE '%Caption')""")
def caption_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.caption_overlaps(_sources(spark, sf_dir))


_LINE = "trim(regexp_replace(replace(raw, chr(173), ''), '[\\s ]+', ' ', 'g'))"


@query(f"""WITH ln AS (SELECT doc_id, (i - 1)::INT AS line_no, {_LINE.replace('raw', 'l')} AS line, whole FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i, trim(coalesce(text, '')) = '' AS whole FROM documents)),
k AS (SELECT *, row_number() OVER o AS n FROM ln WHERE line <> '' OR whole WINDOW o AS (PARTITION BY doc_id ORDER BY line_no)),
c AS (SELECT *, sum(CASE WHEN n > 1 AND regexp_matches(line, '^[A-Z].{{0,59}}[^.]$') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM k),
p AS (SELECT doc_id, k, min(line_no) AS first_line, max(line_no) AS last_line, string_agg(line, ' ' ORDER BY line_no) AS text FROM c GROUP BY ALL)
SELECT doc_id, CASE WHEN max(k) OVER (PARTITION BY doc_id) > 0 THEN 'b__s' || k::INT ELSE 'b' END AS block_id, 'b' AS source_block_id, first_line, last_line, text FROM p""")
def split_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.lit("b").alias("block_id"), "text")
    return lineage.split_lines(blocks, F.col("line").rlike("^[A-Z].{0,59}[^.]$"))


_LINEAGE = "lg AS (SELECT doc_id, block_id, 'p' || page || '_b' || (ord - ord % 2) AS source_block_id, (ord % 2)::INT AS k FROM blocks WHERE ord % 5 <> 0)"


@query(f"""WITH {_LINEAGE}, o AS (SELECT doc_id, block_id, row_number() OVER (PARTITION BY doc_id ORDER BY y0, x0, ord) AS pos FROM blocks),
f AS (SELECT doc_id, coalesce(source_block_id, block_id) AS block_id, min(struct_pack(pos, k := coalesce(k, 0))) AS place FROM o LEFT JOIN lg USING (doc_id, block_id) GROUP BY 1, 2)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place, block_id) AS pos, block_id FROM f""")
def expanded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    b = derived(spark, sf_dir, "blocks")
    order = b.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("y0", "x0", "ord")).alias("pos"), "block_id")
    return lineage.expand_order(order, b.where("ord % 5 <> 0").select("doc_id", "block_id", F.expr("concat('p', page, '_b', ord - ord % 2)").alias("source_block_id"), F.expr("cast(ord % 2 as int)").alias("k")))


@query("""WITH g AS (SELECT doc_id, 'group_' || page AS group_id, -ord AS pos, block_id FROM blocks WHERE ord % 4 <> 0),
u AS (SELECT doc_id, group_id AS para_id, pos, b.block_id, page, text, x0, y0, x1, y1 FROM g JOIN blocks b USING (doc_id, block_id) UNION ALL SELECT doc_id, 'para_' || block_id, 0, block_id, page, text, x0, y0, x1, y1 FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = b.doc_id AND g.block_id = b.block_id))
SELECT doc_id, para_id, min(page) AS page, string_agg(block_id, ',' ORDER BY pos, block_id) AS block_ids, coalesce(string_agg(trim(text), ' ' ORDER BY pos, block_id) FILTER (trim(text) <> ''), '') AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM u GROUP BY doc_id, para_id""")
def gathered_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived(spark, sf_dir, "blocks")
    groups = b.where("ord % 4 <> 0").select("doc_id", F.expr("concat('group_', page)").alias("group_id"), (-F.col("ord")).alias("pos"), "block_id")
    return lineage.gathered(b, groups)


@query("""WITH p AS (SELECT doc_id, 1 AS page, x0, x1, y0, y1 FROM paragraphs), e AS (SELECT doc_id, min(x0) AS l, max(x1) - min(x0) AS w, min(y0) AS t, greatest(1.0, max(y1) - min(y0)) AS h FROM p GROUP BY doc_id),
n AS (SELECT doc_id, ((x0 + x1) / 2 - l) / w AS c FROM p JOIN e USING (doc_id) WHERE x1 - x0 < 0.75 * w AND y0 - t >= 0.15 * h),
c AS (SELECT doc_id, count(*) AS n, count(*) FILTER (c < 0.4) AS a, count(*) FILTER (c > 0.6) AS b FROM n GROUP BY doc_id) SELECT doc_id, 1 AS page FROM c WHERE n >= 4 AND a >= 2 AND b >= 2 AND n - a - b <= 0.3 * n""")
def two_column_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.two_column_pages(derived(spark, sf_dir, "paragraphs").withColumn("page", F.lit(1)))


_HEADS = "[x FOR x IN [CASE WHEN contains(text, 'samples') THEN 'More follows' END, CASE WHEN contains(text, 'controls') THEN 'WE FOUND' END, CASE WHEN contains(text, 'Table') THEN 'Table' END] IF x IS NOT NULL]"


@query(f"""WITH b AS (SELECT *, {_HEADS} AS hs, {_LINE.replace('raw', 'text')} AS t, CASE WHEN is_heading THEN 'Heading' ELSE 'Body' END AS role FROM blocks),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY role = 'Body', greatest(0, strpos(lower(t), lower(hs[1])) - 1), len(hs) DESC, ord) AS rank FROM b WHERE NOT is_header_footer AND len(hs) > 0 AND (role = 'Body' OR (length(t) >= 80 AND len(string_split(t, ' ')) >= 8)))
SELECT doc_id, page, block_id, rank::INT AS rank FROM r WHERE rank <= 2""")
def review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lambda part, name: F.when(F.col("text").contains(part), name)
    heads = F.array_compact(F.array(found("samples", "More follows"), found("controls", "WE FOUND"), found("Table", "Table")))
    b = derived(spark, sf_dir, "blocks").withColumn("headings", heads).withColumn("role", F.when(F.col("is_heading"), "Heading").otherwise("Body")).withColumn("pos", F.col("ord"))
    return lineage.review_candidates(b, most=2)


@query("""WITH pg AS (SELECT doc_id, ord AS page, CASE WHEN ord % 4 = 0 THEN NULL ELSE confidence END AS confidence, CASE WHEN ord % 7 = 1 THEN true WHEN ord % 7 = 2 THEN false END AS verified FROM paragraphs)
SELECT doc_id, page FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page) AS n FROM pg WHERE coalesce(confidence, 0.5) < 0.7 AND NOT coalesce(verified, false)) WHERE n <= 10""")
def low_confidence_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derived(spark, sf_dir, "paragraphs").selectExpr("doc_id", "ord AS page", "CASE WHEN ord % 4 = 0 THEN NULL ELSE confidence END AS confidence", "CASE WHEN ord % 7 = 1 THEN true WHEN ord % 7 = 2 THEN false END AS verified")
    return lineage.low_confidence_pages(pages).select("doc_id", "page")


_ENTRY = """CASE ord % 6 WHEN 0 THEN '[' || ord || '] Smith J.A., Doe B., Roe C. and Poe D. ' || text || '. ' || coalesce(venue, 'Journal of Things') || '. ' || year || ';12(3). doi:10.1000/ABC.' || ord || '.'
WHEN 1 THEN ord || '. van Berg et al. ' || text || '. PMID: ' || (12345670 + ord) || '. ' || year WHEN 2 THEN text WHEN 3 THEN 'Short title. Doe J. 1999 and 2004' WHEN 4 THEN '  ' || ord || ') Kim Y, Lee Z & Park W. ' || title || '. ' || coalesce(venue, '') ELSE '' END"""
_ENTRIES = f"en AS (SELECT doc_id, ord, CASE WHEN ord % 7 = 6 THEN NULL ELSE 'bib:' || marker END AS ref_key, 'para_' || ord AS para_id, 1 + ord % 3 AS page, CASE WHEN ord % 2 = 0 THEN marker END AS marker, {_ENTRY} AS text FROM refs)"
_DOI = r"(?i)\b(10\.\d{4,}(?:\.\d+)*/[^\s\]>\"'']+)\b"
_STRIP = "regexp_replace({0}, '^[ .]+|[ .]+$', '', 'g')"
_NW = "len([w FOR w IN string_split({0}, ' ') IF w <> ''])"
_NAMES = "(contains(lower({0}), 'et al') OR len(regexp_extract_all({0}, '\\b[A-Z]\\.')) >= 2 OR (length({0}) - length(replace({0}, ',', '')) >= 2 AND " + _NW + " <= 20))"
_PARSED = rf"""{_ENTRIES}, fe AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, ref_key ORDER BY ord) AS n FROM en WHERE coalesce(ref_key, '') <> '') WHERE n = 1),
e1 AS (SELECT * EXCLUDE n, trim(regexp_replace(coalesce(text, ''), '^\s*(?:\[\d+\]|\d+[.)])\s*', '')) AS raw_text FROM fe),
e2 AS (SELECT *, nullif(regexp_replace(lower(regexp_extract(raw_text, '{_DOI}', 1)), '[.,;:)]+$', ''), '') AS doi, nullif(regexp_extract(raw_text, '(?i)\b(PMID[:\s]*)?(\d{{7,9}})\b', 2), '') AS pmid, regexp_extract_all(raw_text, '\b(19\d{{2}}|20\d{{2}})\b', 1)[-1]::INT AS year FROM e1),
e3 AS (SELECT *, CASE WHEN doi IS NULL THEN raw_text ELSE regexp_replace(raw_text, '(?i)\Q' || doi || '\E', '', 'g') END AS p0 FROM e2),
e4 AS (SELECT * EXCLUDE p0, trim(regexp_replace(CASE WHEN pmid IS NULL THEN p0 ELSE regexp_replace(p0, '(?i)\bPMID[:\s]*' || pmid || '\b', '', 'g') END, '\s+', ' ', 'g')) AS plain FROM e3),
e5 AS (SELECT *, [{_STRIP.format('c')} FOR c IN regexp_split_to_array(plain, '\.\s+') IF {_STRIP.format('c')} <> ''] AS ch FROM e4),
e6 AS (SELECT *, greatest(1, coalesce(list_position([NOT {_NAMES.format('c')} AND {_NW.format('c')} >= 4 FOR c IN ch], true), 0)) AS i FROM e5),
e7 AS (SELECT *, coalesce(ch[i], '') AS t, CASE WHEN len(ch) = 0 THEN plain WHEN i > 1 THEN array_to_string(ch[1:i - 1], '. ') ELSE ch[1] END AS aw FROM e6),
ct AS (SELECT doc_id, ref_key, para_id, page, marker, [a FOR a IN [regexp_replace(x, '^[ ,]+|[ ,]+$', '', 'g') FOR x IN string_split(regexp_replace(regexp_replace(aw, ',\s*([A-Z][a-z]|[A-Z]\.)', chr(1) || '\1', 'g'), '\s+and\s+|\s*&\s*', chr(1), 'g'), chr(1))] IF length(a) > 2 AND lower(a) NOT IN ('et al', 'et al.')][1:10] AS authors,
  CASE WHEN {_NW.format('t')} <= 2 THEN substring(plain, 1, 180) ELSE t END AS title, year, coalesce(ch[i + 1], '') AS venue, doi, pmid, raw_text, CASE WHEN marker IS NOT NULL THEN 0.65 ELSE 0.55 END::DOUBLE AS confidence FROM e7)"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = derived(spark, sf_dir, "refs")
    entries = refs.selectExpr("doc_id", "ord", "CASE WHEN ord % 7 = 6 THEN NULL ELSE 'bib:' || marker END AS ref_key", "'para_' || ord AS para_id", "1 + ord % 3 AS page", "CASE WHEN ord % 2 = 0 THEN marker END AS marker", f"{_ENTRY} AS text")
    return bibliography.catalog(entries)


@query(f"WITH {_PARSED} SELECT * EXCLUDE authors, array_to_string(authors, ';') AS authors FROM ct")
def reference_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).withColumn("authors", F.array_join("authors", ";")).withColumn("confidence", F.col("confidence").cast("double"))


@query(f"""WITH {_PARSED} SELECT doc_id, ref_key, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, lower(title), para_id, ref_key)::INT AS rank, array_to_string(authors[1:3], ', ') || CASE WHEN len(authors) > 3 THEN ' et al.' ELSE '' END AS authors FROM ct""")
def ordered_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = bibliography.ordered(_catalog(spark, sf_dir).withColumn("source", F.col("para_id")))
    return r.select("doc_id", "ref_key", "rank", bibliography.shown_authors(F.col("authors")).alias("authors"))


@query(f"""WITH {_PARSED}, r AS (SELECT doc_id, ref_key, row_number() OVER (PARTITION BY doc_id ORDER BY ref_key) AS ord, doi, nullif(venue, '') AS venue FROM ct),
a AS (SELECT *, coalesce(doi, '') = '' OR coalesce(venue, '') = '' AS inc, sum((coalesce(doi, '') = '' OR coalesce(venue, '') = '')::INT) OVER (PARTITION BY doc_id ORDER BY ord) AS turn FROM r),
p AS (SELECT 'bib:' || i AS ref_key, CASE WHEN i % 2 = 0 THEN '10.2000/x' || i END AS doi, 'Provider ' || i AS venue FROM range(1, 4) t(i)),
j AS (SELECT a.*, p.doi AS pd, p.venue AS pv, inc AND turn <= 2 AS asks FROM a LEFT JOIN p USING (ref_key))
SELECT doc_id, ref_key, ord::INT AS ord, CASE WHEN asks AND coalesce(doi, '') = '' AND pd IS NOT NULL THEN pd ELSE doi END AS doi, CASE WHEN asks AND coalesce(venue, '') = '' AND pv IS NOT NULL THEN pv ELSE venue END AS venue, (asks AND coalesce(doi, '') = '' AND pd IS NOT NULL)::INT + (asks AND coalesce(venue, '') = '' AND pv IS NOT NULL)::INT AS filled FROM j""")
def backfilled_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    r = _catalog(spark, sf_dir).select("doc_id", "ref_key", F.row_number().over(W.partitionBy("doc_id").orderBy("ref_key")).alias("ord"), "doi", F.nullif("venue", F.lit("")).alias("venue"))
    given = spark.range(1, 4).selectExpr("concat('bib:', id) AS ref_key", "CASE WHEN id % 2 = 0 THEN concat('10.2000/x', id) END AS doi", "concat('Provider ', id) AS venue", "id AS rank")
    later = given.selectExpr("ref_key", "'10.9/late' AS doi", "'Late' AS venue", "rank + 10 AS rank").where("rank = 12")
    return bibliography.backfill(r, given.union(later), ("doi", "venue"), most=2)


_OBSERVED = "ob AS (SELECT doc_id, 'manifest' AS artifact, unnest(['doc_id', 'title', 'pages']) AS key, unnest(['string', CASE WHEN doc_id % 5 = 0 THEN 'number' ELSE 'string' END, 'number']) AS type, unnest([CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE doc_id::VARCHAR END, 't', '3']) AS value FROM (SELECT DISTINCT doc_id FROM facts) UNION ALL SELECT doc_id, 'report', 'status', 'string', 'ok' FROM (SELECT DISTINCT doc_id FROM facts) WHERE doc_id % 3 = 0)"


@query(f"""WITH {_OBSERVED}, ru(artifact, key, type, required) AS (VALUES ('manifest', 'doc_id', 'string', true), ('manifest', 'title', 'string', false), ('manifest', 'created', 'string', true), ('report', 'status', 'string', true)),
d AS (SELECT DISTINCT doc_id FROM ob)
SELECT doc_id, artifact, key, 'missing_required' AS violation FROM d, ru WHERE required AND NOT EXISTS (SELECT 1 FROM ob WHERE ob.doc_id = d.doc_id AND ob.artifact = ru.artifact AND ob.key = ru.key)
UNION ALL SELECT doc_id, ob.artifact, ob.key, 'type_' || ob.type || '_not_' || ru.type FROM ob JOIN ru USING (artifact, key) WHERE ob.type <> ru.type
UNION ALL SELECT doc_id, artifact, key, 'doc_id_differs' FROM ob WHERE key = 'doc_id' AND value IS DISTINCT FROM doc_id::VARCHAR""")
def artifact_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, "facts").select("doc_id").distinct()
    rows = d.selectExpr("doc_id", "'manifest' AS artifact", "inline(array(struct('doc_id' AS key, 'string' AS type, if(doc_id % 7 = 0, 'other', cast(doc_id AS string)) AS value), struct('title' AS key, if(doc_id % 5 = 0, 'number', 'string') AS type, 't' AS value), struct('pages' AS key, 'number' AS type, '3' AS value)))")
    rows = rows.union(d.where("doc_id % 3 = 0").selectExpr("doc_id", "'report'", "'status'", "'string'", "'ok'"))
    rules = spark.createDataFrame([("manifest", "doc_id", "string", True), ("manifest", "title", "string", False), ("manifest", "created", "string", True), ("report", "status", "string", True)], "artifact string, key string, type string, required boolean")
    return lineage.violations(rows, rules)


@query("""SELECT attempt_id, stage, error_type, NULL::BOOLEAN AS fallback_used FROM faults WHERE page = 0 UNION ALL SELECT attempt_id, stage, NULL, fallback_used FROM faults WHERE page = 1""")
def log_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = derived(spark, sf_dir, "faults")
    return lineage.union_of_logs(f.where("page = 0").select("attempt_id", "stage", "error_type"), f.where("page = 1").select("attempt_id", "stage", "fallback_used"))


@query("""WITH r AS (SELECT doc_id, kind, list(DISTINCT coalesce(doi, pmid)) FILTER (coalesce(doi, pmid) IS NOT NULL) AS ids FROM refs GROUP BY doc_id, kind)
SELECT a.doc_id, coalesce(list_has_any(a.ids, p.ids), false) AS agree FROM r a JOIN r p ON a.doc_id = p.doc_id WHERE a.kind = 'api' AND p.kind = 'pdf'""")
def identifier_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = derived(spark, sf_dir, "refs").groupBy("doc_id", "kind").agg(F.collect_set(F.upper(F.coalesce("doi", "pmid"))).alias("ids"))
    a, p = r.where("kind = 'api'").select("doc_id", F.col("ids").alias("a")), r.where("kind = 'pdf'").select("doc_id", F.col("ids").alias("p"))
    return a.join(p, "doc_id").select("doc_id", bibliography.identifiers_agree(F.col("a"), F.col("p")).alias("agree"))


@query("""WITH c AS (SELECT doc_id, para_id, trim(regexp_replace(CASE ord % 3 WHEN 0 THEN replace(text, 'Fig. ', 'Figure  ') ELSE text END, '[\\s ]+', ' ', 'g')) AS t, CASE WHEN text LIKE 'Table %' THEN 'table' ELSE 'figure' END AS kind FROM paragraphs),
l AS (SELECT *, CASE WHEN kind = 'figure' THEN regexp_matches(t, '^(?i)(?:fig(?:ure)?s?\\.?)\\s*([0-9]+[a-z]?)\\b') ELSE regexp_matches(t, '^(?i)table\\s*([0-9]+[a-z]?)\\b') END AS is_label, regexp_extract(t, '^(?i)(?:fig(?:ure)?s?\\.?|table)\\s*([0-9]+[a-z]?)\\b\\s*(.*)$', 1) AS num, regexp_replace(regexp_extract(t, '^(?i)(?:fig(?:ure)?s?\\.?|table)\\s*([0-9]+[a-z]?)\\b\\s*(.*)$', 2), '^[|:\\-–—.;,\\s]+|[ |]+$', '', 'g') AS rest FROM c)
SELECT doc_id, para_id, nullif(CASE WHEN is_label THEN CASE kind WHEN 'figure' THEN 'Fig. ' ELSE 'Table ' END || num || CASE WHEN rest <> '' THEN ' | ' || rest ELSE '' END ELSE t END, '') AS caption FROM l""")
def canonical_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = derived(spark, sf_dir, "paragraphs")
    t = F.when(F.col("ord") % 3 == 0, F.replace("text", F.lit("Fig. "), F.lit("Figure  "))).otherwise(F.col("text"))
    return p.select("doc_id", "para_id", text.canonical_caption(t, F.when(F.col("text").startswith("Table "), "table").otherwise("figure")).alias("caption"))


@query("""WITH j AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '```json' || chr(10) || '{"a": ' || event_id || '}' || chr(10) || '```' WHEN 1 THEN 'Sure: [1, ' || event_id || ']' WHEN 2 THEN '{"broken": ' WHEN 3 THEN 'no json' ELSE '{"ok": true}' END AS t FROM events),
s AS (SELECT event_id, regexp_replace(regexp_extract(t, '[\\{\\[][^`]*'), '\\s+$', '') AS v FROM j) SELECT event_id, CASE WHEN v <> '' AND json_valid(v) THEN v END AS value FROM s""")
def repaired_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    said = F.expr("CASE event_id % 5 WHEN 0 THEN concat('```json\\n{\"a\": ', event_id, '}\\n```') WHEN 1 THEN concat('Sure: [1, ', event_id, ']') WHEN 2 THEN '{\"broken\": ' WHEN 3 THEN 'no json' ELSE '{\"ok\": true}' END")
    return e.select("event_id", text.json_value(said).alias("value"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.iso_time(F.col("ts")).alias("at"))


@query("SELECT doc_id, page, trim(text) AS text, x0, y0, font_size::DOUBLE AS font_size, is_bold, CASE WHEN is_bold THEN 'Helvetica-Bold' ELSE 'Helvetica' END AS font FROM blocks WHERE trim(text) <> ''")
def pdf_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as a PDF file and read again."""
    from ..sources import pdf

    line = F.struct("page", "ord", "text", "x0", "y0", F.col("font_size").cast("double").alias("font_size"), "is_bold")
    docs = derived(spark, sf_dir, "blocks").groupBy("doc_id").agg(F.sort_array(F.collect_list(line)).alias("lines"))

    def written(batches):
        import pyarrow as pa

        for batch in batches:
            lines, out, end = batch.column(1), [], 0
            flat = lines.flatten()
            names, columns = [f.name for f in flat.type], [c.to_pylist() for c in flat.flatten()]
            every = [dict(zip(names, row, strict=True)) for row in zip(*columns, strict=True)]
            for n in lines.value_lengths().to_pylist():
                pages: list[list[dict]] = []
                for x in every[end : end + n]:  # by page
                    while len(pages) < x["page"]:
                        pages.append([])
                    pages[-1].append(x)
                end += n
                out.append(pdf.write(pages))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(out, pa.binary())], ["path", "content"])

    files = docs.mapInArrow(written, "path string, content binary")
    return pdf.blocks(files).select(F.col("path").cast("long").alias("doc_id"), "page", "text", "x0", "y0", "font_size", "is_bold", "font")


_LABEL_WORDS = "regexp_extract_all(t, '[A-Za-z]+(?:[-''][A-Za-z]+)?|[0-9]+(?:\\.[0-9]+)?')"


@query(f"""WITH a AS (SELECT doc_id, ord, {_LINE.replace('raw', "CASE ord % 5 WHEN 0 THEN text WHEN 1 THEN regexp_replace(text, '^((\\S+\\s+){4}).*$', '\\1') WHEN 2 THEN (ord * 3) || ' ' || (ord + 0.5) || ' -7' WHEN 3 THEN 'OR 1.' || ord || ' for this group' ELSE 'signaling pathway response of ' || doc_id END")} AS t FROM blocks),
w AS (SELECT *, [x FOR x IN string_split(t, ' ') IF x <> ''] AS w, {_LABEL_WORDS} AS l, len(regexp_extract_all(t, '\\b[0-9]+(?:\\.[0-9]+)?\\b')) AS nums, NOT regexp_matches(t, '[.!?]\\s*$') AS open_end FROM a),
m AS (SELECT *, regexp_matches(lower(t), 'p-value|log10|log2|fold change') AS marked FROM w),
k AS (SELECT *, length(t) BETWEEN 1 AND 72 AND len(l) BETWEEN 1 AND 9 AND (marked OR len([x FOR x IN l IF regexp_matches(x, '^[a-z]')]) <= greatest(1, len(l) // 3)) AND len([x FOR x IN l IF length(x) <= 4]) >= greatest(2, len(l) // 2) AND (marked OR len([x FOR x IN l IF length(x) >= 2 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')]) >= 1) AS compact,
  regexp_matches(t, '(?i)^(fig(?:ure)?|table)\\s*\\.?\\s*[0-9]+[a-z]?\\b') AND length(t) >= 8 AND len([x FOR x IN w IF regexp_matches(x, '\\p{{L}}')]) >= 3 AS caption FROM m)
SELECT doc_id, ord, t <> '' AND (compact OR caption OR regexp_matches(lower(t), '-log10\\s*\\(p-?value\\)') OR (nums >= 2 AND regexp_matches(t, '^[0-9\\s.+-]+$')) OR (len(w) <= 2 AND open_end AND (nums >= 1 OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9_-]{{0,11}}$')))
OR (len(w) <= 10 AND nums >= 1 AND open_end AND regexp_matches(lower(t), '\\b(or|hr|auc)\\b')) OR (len(w) <= 24 AND open_end AND len([x FOR x IN ['pathway', 'pathways', 'response', 'signaling', 'interaction', 'contraction', 'chemokine', 'cytokine', 'feature'] IF contains(lower(t), x)]) >= 3) OR (len(w) <= 12 AND open_end AND nums >= greatest(2, len(w) // 2))) AS is_noise FROM k""")
def chart_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.tables import is_chart_noise

    said = F.expr(r"""CASE ord % 5 WHEN 0 THEN text WHEN 1 THEN regexp_replace(text, '^((\\S+\\s+){4}).*$', '$1') WHEN 2 THEN concat(ord * 3, ' ', cast(ord + 0.5 as string), ' -7') WHEN 3 THEN concat('OR 1.', ord, ' for this group') ELSE concat('signaling pathway response of ', doc_id) END""")
    return derived(spark, sf_dir, "blocks").select("doc_id", "ord", is_chart_noise(said).alias("is_noise"))
