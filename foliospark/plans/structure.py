"""Queries on roles, tables, orders and selections, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import repair_hyphens
from ..operators import citations, layout, paragraphs, roles, sequences, tables
from .base import query
from .derive import LINES_SQL, derived, lines

_CLEAN = "trim(regexp_replace(replace(text, chr(173), ''), '[\\s ]+', ' ', 'g'))"
_COUNT = "len(regexp_extract_all({0}, '{1}'))"
_NUMBERS = _COUNT.format("t", roles.NUMBER)
_TOKENS = f"regexp_extract_all({_CLEAN}, '{roles.TOKEN.replace(chr(39), chr(39) * 2)}')"
_WORD = tables.WORD.replace("'", "''")
_ROLED = "roled AS (SELECT *, CASE WHEN text LIKE 'Table %' THEN 'TableCaption' WHEN is_heading THEN 'Heading' WHEN is_header_footer THEN 'HeaderFooter' ELSE 'Body' END AS role, row_number() OVER (PARTITION BY doc_id, page ORDER BY column_guess, y0, x0, ord) AS reading_pos FROM blocks)"
_PAGE_BOUNDS = "min(x0) OVER pg AS bx0, max(x1) OVER pg AS bx1, min(y0) OVER pg AS by0, max(y1) OVER pg AS by1"


def _hits(parts) -> str:
    return "(" + " + ".join(f"contains(low, '{p}')::INT" for p in parts) + ")"


def _sql(spark: SparkSession, sf_dir: str, text: str, table: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {table}", f"FROM {{{table}}}"), **{table: derived(spark, sf_dir, table)})


def _roled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.fallback_roles(derived(spark, sf_dir, "blocks"))


@query(f"""WITH {LINES_SQL}, c AS (SELECT doc_id, line_no, {_CLEAN} AS t, lower({_CLEAN}) AS low FROM lines),
n AS (SELECT *, {_COUNT.format('t', '[A-Za-z0-9]+(?:[-/][A-Za-z0-9]+)?')} AS n, length(t) - length(replace(t, ';', '')) AS sc, regexp_matches(t, '[.!?]$') AS closed FROM c)
SELECT doc_id, line_no, CASE WHEN n = 0 THEN 0.0 ELSE round((CASE WHEN sc >= 1 AND n <= 80 THEN 1.6 ELSE 0 END)::DOUBLE + CASE WHEN {_NUMBERS} >= 1 AND {_hits(tables.DESCRIPTORS)} >= 1 THEN 1.2 ELSE 0 END + CASE WHEN regexp_matches(low, '\\bd[0-9]{{1,2}}\\s*=') THEN 1.2 ELSE 0 END
+ CASE WHEN {_hits(tables.HEADS)} >= 2 AND n <= 24 AND NOT closed THEN 1.0 ELSE 0 END + CASE WHEN contains(low, 'table') AND contains(low, 'continued') THEN 0.8 ELSE 0 END - CASE WHEN closed AND sc = 0 AND n >= 24 THEN 1.5 ELSE 0 END, 6) END::DOUBLE AS score FROM n""")
def table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("doc_id", "line_no", tables.score(F.col("text")).alias("score"))


@query(f"""WITH {LINES_SQL}, c AS (SELECT doc_id, line_no, {_CLEAN} AS t FROM lines), n AS (SELECT *, {_COUNT.format('t', _WORD)} AS n, regexp_matches(t, '[.!?]$') AS closed FROM c)
SELECT doc_id, line_no, n > 0 AND (regexp_matches(t, '^\\[\\s*[0-9]+(\\s*[,;]\\s*[0-9]+)*\\s*\\]$') OR contains(t, ';') AND n <= 34 AND NOT closed OR n <= 6 AND regexp_matches(t, '^[A-Z][A-Za-z0-9-]*(\\s+[A-Za-z][A-Za-z0-9-]*){{0,5}}(\\s*\\([^)]+\\))?$') OR {_NUMBERS} >= 3 AND n <= 24
OR n <= 10 AND len(list_filter(regexp_extract_all(t, '{_WORD}'), lambda x: x[1] BETWEEN 'A' AND 'Z')) >= greatest(2, floor(n * 0.6)) AND NOT regexp_matches(t, '[.;]') OR contains(t, '[') AND contains(t, ']') AND n <= 18 AND NOT closed) AS is_artifact FROM n""")
def table_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("doc_id", "line_no", tables.is_artifact(F.col("text")).alias("is_artifact"))


_HAS = lambda part: f"contains(low, '{part}')"
_N_OF = lambda pattern, c="t": f"len(regexp_extract_all({c}, '{pattern}'))"
_FIELD = " OR ".join(_HAS(x) for x in tables.FIELDS)


@query(rf"""WITH {LINES_SQL}, a AS (SELECT doc_id, line_no, trim(regexp_replace(replace(text, chr(173), ''), '[\s ]+', ' ', 'g')) AS t FROM lines),
b AS (SELECT *, lower(t) AS low, [x FOR x IN string_split(t, ' ') IF x <> ''] AS w FROM a),
c AS (SELECT *, len(w) AS n, regexp_matches(t, '[.!?]\s*$') AS closed, {_N_OF(';')} AS semis, {_N_OF('[.!?]')} AS breaks, {_N_OF(r'\b[0-9]+\.?[0-9]*\b')} AS nums, {_N_OF(r'\b[0-9]+(?:\.[0-9]+)?\b')} AS figures,
  len([x FOR x IN w IF regexp_matches(x, '^\p{{Lu}}') AND length(x) <= 12]) AS caps, len([x FOR x IN w IF regexp_matches(x, '^[0-9]+\.?[0-9]*$')]) AS bare, coalesce(len([x FOR x IN w IF regexp_matches(x, '^\p{{Ll}}')]) / nullif(len(w), 0), 0) AS prose FROM b)
SELECT doc_id, line_no, CASE WHEN regexp_matches(t, '^\[[0-9\s,]+\]$') THEN true WHEN length(t) < 8 THEN false WHEN regexp_matches(low, '{tables.FRONT}') THEN true
WHEN regexp_matches(low, '\btable\s*[0-9]+\s*[.)]?\s*\(continued\)|^table\s+[0-9]+(?:\.[0-9]+)*\.\s+') THEN true WHEN {_HAS('advantages')} AND {_HAS('disadvantages')} THEN true
WHEN n <= 12 AND (({_HAS('advantage')} AND {_HAS('disadvantage')}) OR ({_HAS('benefit')} AND {_HAS('limitation')})) THEN true
WHEN regexp_matches(t, '^[0-9]+(?:\.[0-9]+)*\.?\s+[A-Za-z]') AND n <= 20 AND NOT {_HAS('table')} AND NOT {_HAS('figure')} THEN false WHEN n < 4 THEN false
WHEN n <= 32 AND semis >= 2 AND NOT closed AND (prose <= 0.62 OR figures >= 2) THEN true WHEN n <= 24 AND semis >= 1 AND regexp_matches(t, '\b[0-9]+\s*[×x]\s*10\b|\b10\s*[−-]\s*[0-9]+\b') AND NOT closed THEN true
WHEN n >= 18 AND breaks >= 1 AND prose >= 0.55 AND NOT ({_FIELD}) THEN false WHEN n BETWEEN 5 AND 24 AND caps >= 0.6 * n AND caps >= 4 THEN true WHEN n <= 24 AND {_N_OF(tables.UNITS, 'low')} >= 2 AND breaks <= 1 THEN true
WHEN n <= 12 AND nums >= 3 THEN true WHEN {_FIELD} THEN true WHEN n BETWEEN 5 AND 28 AND {_N_OF(r'\b[A-Z][a-z]{1,8}\b')} >= 4 AND regexp_matches(t, '[,;]\s+[A-Z][a-z]') AND breaks = 0 THEN true ELSE n <= 10 AND bare >= 0.6 * n AND bare >= 3 END AS is_noise FROM c""")
def table_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("doc_id", "line_no", tables.is_noise(F.col("text")).alias("is_noise"))


_CELLS = "SELECT doc_id, CAST(ord AS BIGINT) AS ord, CASE WHEN ord % 4 = 3 THEN CONCAT(text, ' in every one of the cases of this study.') ELSE CONCAT('Low cost; ', CAST(ord AS STRING), ' mm') END AS text FROM blocks"


@query()
def artifact_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _sql(spark, sf_dir, _CELLS, "blocks")
    return tables.artifact_spans(cells, cells.select("doc_id", (F.col("doc_id") % 3).alias("n_tables")).distinct())


_TALL = "SELECT doc_id, ord, asset_id, caption_id, x0, x1, y0, y0 + 4 * (y1 - y0) AS y1 FROM assets"


@query(f"""WITH ta AS ({_TALL}) SELECT doc_id, ord, asset_id FROM ta WHERE CASE WHEN caption_id IS NOT NULL THEN x1 - x0 >= 35 AND y1 - y0 >= 25 AND (x1 - x0) * (y1 - y0) / (595.0 * 791.0) >= 0.0006
ELSE x1 - x0 >= 70 AND y1 - y0 >= 55 AND (x1 - x0) * (y1 - y0) / (595.0 * 791.0) >= 0.004 AND (y0 + y1) / 2 / 791.0 BETWEEN 0.1 AND 0.92 END""")
def plausible_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.plausible_assets(_sql(spark, sf_dir, _TALL, "assets")).select("doc_id", "ord", "asset_id")


@query()
def clean_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived(spark, sf_dir, "blocks")
    fonts = layout.font_profile(b)
    return roles.clean_roles(layout.fallback_roles(b), _profile(fonts))


def _profile(fonts: DataFrame) -> DataFrame:
    """One row a document of the font profiles of headings and body."""
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return fonts.groupBy("doc_id").agg(of("heading", "median_size").alias("heading_size"), of("heading", "bold_ratio").alias("heading_bold"), of("heading", "dominant_font").alias("heading_font"), of("body", "median_size").alias("body_size"))


@query()
def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived(spark, sf_dir, "blocks")
    return roles.titles(b.join(roles.clean_roles(layout.fallback_roles(b)), ["doc_id", "block_id"]))


_ENTRIES = """SELECT doc_id, CONCAT('ref_', CAST(ord AS STRING)) AS para_id, CASE WHEN ord % 7 = 0 THEN 'ReferenceList' ELSE 'Body' END AS role, CASE WHEN ord % 5 = 0 THEN 'References' ELSE 'Results' END AS section,
CONCAT(CASE WHEN ord % 2 = 0 THEN CONCAT('[', CAST(marker AS STRING), '] ') ELSE '' END, CASE WHEN ord % 3 = 0 THEN 'Smith, J. A. ' ELSE '' END, title, CASE WHEN marker % 2 = 0 THEN CONCAT(' Nature ', CAST(year AS STRING)) ELSE '' END, COALESCE(CONCAT(' doi ', doi), '')) AS text FROM refs"""


@query(f"""WITH e AS ({_ENTRIES}), s AS (SELECT *, regexp_matches(text, '^\\[[0-9]+\\] ') AS num, contains(text, 'Smith, J.')::INT + contains(text, ' Nature ')::INT + regexp_matches(text, ' (19|20)[0-9][0-9]( |$)')::INT + contains(text, ' 10.1000/')::INT >= 2 AS shown FROM e)
SELECT doc_id, para_id, role = 'ReferenceList' OR (section = 'References' AND (num OR shown)) OR (num AND shown) AS is_reference FROM s""")
def reference_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.reference_paragraphs(_sql(spark, sf_dir, _ENTRIES, "refs"))


_REGIONS = "SELECT DISTINCT doc_id, page, CAST(1 AS INT) AS region_ord, CASE WHEN doc_id % 2 = 0 THEN 'CaptionRegion' ELSE 'Heading' END AS role, 30.0 AS rx0, 10.0 + doc_id % 40 AS ry0, 300.0 AS rx1, 60.0 + doc_id % 40 AS ry1 FROM blocks UNION ALL SELECT DISTINCT doc_id, page, 2, 'Body', 250.0, 0.0, 560.0, 75.0 FROM blocks"


@query(f"""WITH rg AS ({_REGIONS}), s AS (SELECT b.doc_id, b.block_id, region_ord, CASE WHEN role <> 'CaptionRegion' THEN role WHEN text LIKE 'Table%' THEN 'TableCaption' ELSE 'FigureCaption' END AS region_role, greatest(0, least(x1, rx1) - greatest(x0, rx0)) * greatest(0, least(y1, ry1) - greatest(y0, ry0)) AS area,
(x0 + x1) / 2 BETWEEN rx0 AND rx1 AND (y0 + y1) / 2 BETWEEN ry0 AND ry1 AS hit FROM blocks b JOIN rg USING (doc_id, page))
SELECT doc_id, block_id, region_role FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, block_id ORDER BY area + CASE WHEN hit THEN 1e6 ELSE 0 END DESC, region_ord) AS n FROM s WHERE hit OR area > 0) WHERE n = 1""")
def region_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.region_roles(derived(spark, sf_dir, "blocks"), _sql(spark, sf_dir, _REGIONS, "blocks"))


@query(f"""WITH w AS (SELECT doc_id, page, {_CLEAN} AS t, {_TOKENS} AS w FROM blocks),
a AS (SELECT doc_id, page, sum((t <> '')::INT) AS ln, sum(len(w)) AS n, sum(len(list_filter(w, lambda x: length(x) <= 3))) AS sh, sum(len(list_filter(w, lambda x: x[1] BETWEEN '0' AND '9'))) AS nu, sum(len(list_filter(w, lambda x: lower(x) IN {sequences.STOPWORDS}))) AS st, sum(len(regexp_extract_all(t, '[.;:]'))) AS ma FROM w GROUP BY ALL)
SELECT doc_id, page, CASE WHEN n = 0 THEN 'uncertain' WHEN ln >= 5 AND sh >= 0.5 * n AND st <= 0.2 * n THEN 'non_narrative_graphic' WHEN nu >= 0.25 * n AND st <= 0.2 * n THEN 'non_narrative_graphic' WHEN n >= 10 AND st / n >= 0.12 AND (ma >= 1 OR ln <= 3) THEN 'narrative' ELSE 'uncertain' END AS label FROM a""")
def cluster_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.coherence(derived(spark, sf_dir, "blocks"), "doc_id", "page")


@query(f"""WITH w AS (SELECT *, {_CLEAN} AS t, {_TOKENS} AS w, floor((x0 + x1) / 2 / 200) AS cx, floor((y0 + y1) / 2 / 200) AS cy FROM blocks), al AS (SELECT *, len(list_filter(w, lambda x: NOT x[1] BETWEEN '0' AND '9')) AS al FROM w),
s AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page) AS total, row_number() OVER (PARTITION BY doc_id, page ORDER BY least(length(t), 160) + CASE WHEN regexp_matches(lower(t), '^(fig(ure)?\\.?|table)\\b') THEN 120 ELSE 0 END + CASE WHEN al >= 4 THEN 60 ELSE 0 END + is_heading::INT * 40 + is_header_footer::INT * 20 - CASE WHEN len(w) - al >= greatest(2, len(w) - 1) THEN 80 ELSE 0 END DESC, al DESC, length(t) DESC, y0, x0, ord) AS rk FROM al),
g AS (SELECT s.*, NOT EXISTS (SELECT 1 FROM s o WHERE o.doc_id = s.doc_id AND o.page = s.page AND o.cx = s.cx AND o.cy = s.cy AND o.rk < s.rk) AS best FROM s)
SELECT doc_id, page, block_id, row_number() OVER (PARTITION BY doc_id, page ORDER BY CASE WHEN total > 2 THEN (NOT best AND rk = 1)::INT ELSE 0 END, CASE WHEN total > 2 THEN rk ELSE ord END) AS seed_no FROM g QUALIFY seed_no <= 2""")
def coarse_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.coarse_seeds(derived(spark, sf_dir, "blocks"), most=2, cell=200)


@query()
def coarse_seeds_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.coarse_seeds(derived(spark, sf_dir, "blocks"), most=24)


@query("SELECT doc_id, page, block_id, substring(text, 1, 40) AS text, row_number() OVER (PARTITION BY doc_id, page ORDER BY column_guess, y0, x0, ord) AS pos, count(*) OVER (PARTITION BY doc_id, page) AS total_blocks FROM blocks QUALIFY pos <= 2")
def input_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.input_packages(derived(spark, sf_dir, "blocks"), most=2, chars=40)


@query()
def input_packages_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.input_packages(derived(spark, sf_dir, "blocks"))


@query(f"""WITH b AS (SELECT *, {_PAGE_BOUNDS} FROM paragraphs WINDOW pg AS (PARTITION BY doc_id, page)), r AS (SELECT *, ((x0 + x1) / 2 - bx0) / greatest(1e-6, bx1 - bx0) AS x, ((y0 + y1) / 2 - by0) / greatest(1e-6, by1 - by0) AS y, (x1 - x0) / greatest(1e-6, bx1 - bx0) AS w FROM b),
k AS (SELECT *, CASE WHEN page % 2 = 0 THEN 0 WHEN w >= 0.72 AND y <= 0.2 THEN 0 WHEN w >= 0.72 AND y >= 0.82 THEN 3 WHEN w >= 0.72 THEN 2 WHEN x < 0.5 THEN 1 ELSE 2 END AS bucket FROM r)
SELECT doc_id, para_id, bucket, row_number() OVER (PARTITION BY doc_id ORDER BY page, bucket, y0, x0, ord) AS pos FROM k""")
def column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = derived(spark, sf_dir, "paragraphs")
    return sequences.column_order(p, p.where("page % 2 = 1").select("doc_id", "page"))


@query(f"""WITH {_ROLED}, h AS (SELECT *, sum((role = 'Heading')::INT) OVER w AS heads, lag(role) OVER (PARTITION BY doc_id, page ORDER BY reading_pos) AS before FROM roled WINDOW w AS (PARTITION BY doc_id, page ORDER BY reading_pos))
SELECT doc_id, page, block_id, sum(CASE WHEN before IS NULL OR before = 'Heading' OR role = 'Heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY reading_pos)::BIGINT AS segment FROM h""")
def heading_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.heading_segments(_roled(spark, sf_dir))


_SECTIONS = "SELECT doc_id, CONCAT(CAST(page AS STRING), CASE WHEN ord % 3 = 1 THEN '' ELSE CONCAT('.', CAST(ord % 3 AS STRING)) END, CASE WHEN ord % 3 = 0 AND doc_id % 2 = 0 THEN '.1' ELSE '' END, ' Part ', font) AS section FROM blocks"


@query(f"""WITH s AS (SELECT DISTINCT doc_id, section, split_part(section, ' ', 1) AS number FROM ({_SECTIONS}))
SELECT doc_id, section FROM s WHERE EXISTS (SELECT 1 FROM s o WHERE o.doc_id = s.doc_id AND starts_with(o.number, s.number || '.'))""")
def parent_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.parents_of_sections(_sql(spark, sf_dir, _SECTIONS, "blocks"))


@query()
def regrouping_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    roled = _roled(spark, sf_dir)
    pairs = "SELECT doc_id, CAST(ord AS BIGINT) AS hint_ord, ARRAY(block_id, LEAD(block_id) OVER (PARTITION BY doc_id, page ORDER BY ord)) AS block_ids FROM blocks"
    return sequences.regrouping_hints(layout.merge_groups(roled), _sql(spark, sf_dir, pairs, "blocks"))


_HEADS = "SELECT doc_id, ord, page, x0, y0, x1, y1, CASE WHEN ord % 3 = 1 THEN 'with (Fig. 2) shown above.' WHEN ord = 2 AND doc_id % 4 = 0 THEN 'and later ones.' ELSE CONCAT('Then, as the second of two studies says, ', text, ' in every one of the cases') END AS text FROM paragraphs"


@query(f"""WITH p AS ({_HEADS}), b AS (SELECT *, {_PAGE_BOUNDS} FROM p WINDOW pg AS (PARTITION BY doc_id, page)), r AS (SELECT doc_id, ord, page, text, starts_with(text, 'Then') AS fresh, ((x0 + x1) / 2 - bx0) / greatest(1e-6, bx1 - bx0) AS x, ((y0 + y1) / 2 - by0) / greatest(1e-6, by1 - by0) AS y, (y0 - by0) / greatest(1e-6, by1 - by0) AS u FROM b),
n AS (SELECT *, lead(fresh) OVER d AS nf, lead(page) OVER d AS np, lead(x) OVER d AS nx, lead(y) OVER d AS ny, lead(u) OVER d AS nu, row_number() OVER d AS pos FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY ord)),
v AS (SELECT doc_id, ord, pos, coalesce(NOT fresh AND nf AND ((y <= 0.42 AND (x >= 0.52 OR np > page OR (np = page AND ny > y AND abs(x - nx) <= 0.22))) OR (np = page AND ny > y AND x >= 0.52 AND nx >= 0.45) OR (np = page AND x >= 0.62 AND nx <= 0.45 AND abs(u - nu) <= 0.06)), false) AS drop_it FROM n)
SELECT doc_id, ord FROM v WHERE pos <= 3 AND drop_it AND NOT EXISTS (SELECT 1 FROM v o WHERE o.doc_id = v.doc_id AND o.pos < v.pos AND NOT o.drop_it)""")
def leading_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.leading_fragments(_sql(spark, sf_dir, _HEADS, "paragraphs"))


@query()
def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.chunk_lines(derived(spark, sf_dir, "blocks"))


@query("SELECT provider, NULL AS kind, count(*) AS n FROM refs GROUP BY provider UNION ALL SELECT NULL, kind, count(*) FROM refs GROUP BY kind")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.source_mix(derived(spark, sf_dir, "refs"))


@query(f"WITH {_ROLED} SELECT doc_id, false AS reference_region_ambiguous, bool_or(doc_id % 4 = 0 AND role LIKE '%Caption') AS caption_linking_partial, count(*) FILTER (role = 'Heading') = 0 OR count(*) FILTER (role = 'Heading') - count(DISTINCT CASE WHEN role = 'Heading' THEN lower({_CLEAN}) END) > 0.2 * count(*) FILTER (role = 'Heading') AS section_boundary_unstable FROM roled GROUP BY doc_id")
def structure_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived(spark, sf_dir, "blocks")
    return sequences.structure_flags(layout.fallback_roles(b).withColumn("fallback_used", F.col("doc_id") % 4 == 0), paragraphs.document_metrics(layout.fallback_roles(b)))


_WRAPPED = "SELECT doc_id, ord, replace(replace(text, ' of ', '- of '), ' had', '- Had') AS text FROM blocks"


@query(f"WITH w AS ({_WRAPPED}) SELECT doc_id, ord, trim(regexp_replace(text, '\\b([A-Za-z]{{3,}})-\\s+([a-z][A-Za-z]+)\\b', '\\1-\\2', 'g')) AS text FROM w")
def hyphen_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, _WRAPPED, "blocks").select("doc_id", "ord", repair_hyphens(F.col("text")).alias("text"))


_TEXTS = "SELECT doc_id, para_id, page, CONCAT(text, CASE WHEN ord % 4 = 0 THEN CONCAT(' [', CAST(ord AS STRING), ', ', CAST(ord + 2 AS STRING), ']') WHEN ord % 4 = 1 THEN ' (3)' WHEN ord % 4 = 2 THEN CONCAT(' (', CAST(ord AS STRING), ';9)') ELSE ' see ref (4) too' END) AS text, doc_id % 13 = 0 AND ord = 2 AS is_reference FROM paragraphs"


@query(f"""WITH p AS ({_TEXTS}), o AS (SELECT doc_id, para_id, page, text, is_reference, split_part(para_id, '_', 3)::BIGINT AS ord FROM p WHERE NOT is_reference),
n AS (SELECT doc_id, para_id, page, unnest(CASE ord % 4 WHEN 0 THEN [ord, ord + 2] WHEN 1 THEN [] WHEN 2 THEN list_distinct([ord, 9]) ELSE [4] END) AS n FROM o) SELECT doc_id, para_id, page, '[' || n || ']' AS anchor_text FROM n""")
def inline_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.inline_anchors(_sql(spark, sf_dir, _TEXTS, "paragraphs"))


_LINKS = "SELECT doc_id, anchor_id, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id % 7 AS STRING) ELSE anchor_text END AS anchor_text, link_type, CASE WHEN doc_id % 6 = 0 THEN CONCAT('x-bib-000', CAST(doc_id % 5 AS STRING)) WHEN doc_id % 6 = 3 THEN 'sec-2' ELSE NULL END AS dest_name, CASE WHEN anchor_text LIKE 'http%' THEN 'resource_link' ELSE 'citation_marker' END AS anchor_type, CAST(NULL AS STRING) AS nearest_para_id FROM anchors"
_KEYED = "SELECT doc_id, marker, ord, CONCAT('bib:', CAST(ord AS STRING)) AS ref_key FROM refs"


@query(f"""WITH l AS ({_LINKS}), k AS ({_KEYED}) SELECT doc_id, anchor_id, CASE WHEN anchor_type = 'citation_marker' AND (regexp_matches(anchor_text, '^[1-9]$') AND NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = l.doc_id AND k.marker = try_cast(l.anchor_text AS INT)) OR (link_type = 'internal' AND dest_name IS NOT NULL AND (dest_name = 'sec-2' OR dest_name LIKE '%-0000'))) THEN 'structural_link' ELSE anchor_type END AS anchor_type FROM l""")
def demoted_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.demote(_sql(spark, sf_dir, _LINKS, "anchors"), _sql(spark, sf_dir, _KEYED, "refs")).select("doc_id", "anchor_id", "anchor_type")


@query()
def citation_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = roles.reference_paragraphs(_sql(spark, sf_dir, _ENTRIES, "refs")).where("is_reference").join(_sql(spark, sf_dir, _ENTRIES, "refs"), ["doc_id", "para_id"])
    return citations.map_citations(_sql(spark, sf_dir, _LINKS, "anchors"), _sql(spark, sf_dir, _KEYED, "refs"), entries)


_POINTS = "SELECT doc_id, CONCAT('a', CAST(ord AS STRING)) AS anchor_id, CONCAT('bib:', CAST(ord AS STRING)) AS ref_key, 'internal_dest' AS strategy, confidence FROM refs"
_PDF = "SELECT doc_id, CONCAT('bib:', CAST(ord AS STRING)) AS ref_key, title, venue AS author, year FROM refs"
_API = "SELECT doc_id, CONCAT('doi:', COALESCE(doi, 'none'), CAST(ord AS STRING)) AS ref_key, title, venue AS author, year, doi, confidence FROM refs WHERE kind = 'api'"


@query(f"""WITH p AS ({_POINTS}), e AS ({_PDF}), m AS ({_API}), t AS (SELECT doc_id, lower(title) AS title, year, min(ref_key) AS k, arg_min(confidence, ref_key) AS sure FROM m WHERE title <> '' GROUP BY ALL), s AS (SELECT doc_id, lower(author) AS author, year, arg_min(doi, ref_key) AS doi FROM m WHERE author <> '' AND doi <> '' GROUP BY ALL)
SELECT p.doc_id, anchor_id, CASE WHEN t.k IS NOT NULL THEN t.k WHEN s.doi IS NOT NULL THEN 'doi:' || lower(s.doi) ELSE ref_key END AS ref_key, CASE WHEN t.k IS NULL AND s.doi IS NOT NULL THEN 'author_year_match' ELSE strategy END AS strategy, CASE WHEN t.k IS NOT NULL THEN greatest(confidence, sure) WHEN s.doi IS NOT NULL THEN 0.75 ELSE confidence END AS confidence
FROM p JOIN e USING (doc_id, ref_key) LEFT JOIN t ON t.doc_id = p.doc_id AND t.title = lower(e.title) AND t.year = e.year LEFT JOIN s ON s.doc_id = p.doc_id AND s.author = lower(e.author) AND s.year = e.year""")
def resolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.resolve_keys(_sql(spark, sf_dir, _POINTS, "refs"), _sql(spark, sf_dir, _PDF, "refs"), _sql(spark, sf_dir, _API, "refs"))
