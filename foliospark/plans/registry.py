"""Queries of the library, each over its whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assets, citations, gates, layout, paragraphs, reading, render, telemetry
from ..sources import html
from . import lineage, structure  # noqa: F401  register their queries
from .base import ORACLE_SQL, QUERIES, query
from .derive import LINES_SQL, derived, lines

_TEMPLATE = "substring(trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(text, '[\\s ]+', ' ', 'g'))), '[0-9]+', '#', 'g'), '[^a-z# ]', ' ', 'g'), ' +', ' ', 'g')), 1, 180)"
_CAPTION = "(text LIKE 'Fig. %' OR text LIKE 'Table %')"
_CLEAN = "trim(regexp_replace(text, '[\\s ]+', ' ', 'g'))"
_RULE = f"CASE WHEN regexp_matches({_CLEAN}, '^[0-9]{{1,3}}$') THEN 'page_number_only' WHEN regexp_matches(lower({_CLEAN}), '^check\\s+for\\s+updates\\b') THEN 'check_for_updates_banner' WHEN regexp_matches(lower(text), '{'|'.join(paragraphs.AFFILIATION)}') AND (regexp_matches({_CLEAN}, '^[0-9]+[\\s).,-]') OR contains(text, '@') OR regexp_matches(text, '\\b[0-9]{{5}}(-[0-9]{{4}})?\\b') OR length(text) - length(replace(text, ',', '')) >= 2) THEN 'affiliation_address_line' END"
_WORDS = "list_filter(string_split({0}, ' '), lambda x: x <> '')"


@query(f"WITH {LINES_SQL}, t AS (SELECT doc_id, {_TEMPLATE} AS template FROM lines) SELECT template, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs FROM t WHERE template <> '' GROUP BY template HAVING count(DISTINCT doc_id) >= 2")
def line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.template_documents(lines(spark, sf_dir))


@query(f"""WITH bd AS (SELECT doc_id, page, min(x0) AS bx0, min(y0) AS by0, max(x1) AS bx1, max(y1) AS by1 FROM blocks GROUP BY ALL),
h AS (SELECT b.*, {_TEMPLATE} AS template, ((y0 + y1) / 2 - by0) / greatest(1e-6, by1 - by0) AS y, ((x0 + x1) / 2 - bx0) / greatest(1e-6, bx1 - bx0) AS x FROM blocks b JOIN bd USING (doc_id, page)),
t AS (SELECT doc_id, template, count(*) AS n, count(DISTINCT page) AS n_pages, count(*) FILTER (y <= 0.12 OR y >= 0.88) AS edge_hits, count(*) FILTER (x <= 0.05 OR x >= 0.95 OR x0 <= 12) AS side_hits FROM h WHERE template <> '' GROUP BY ALL)
SELECT h.doc_id, h.block_id, template, n, n_pages, edge_hits, side_hits FROM h JOIN t USING (doc_id, template)""")
def template_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.template_hits(derived(spark, sf_dir, "blocks"))


@query(f"SELECT doc_id, ord, {_CLEAN} AS text, {_RULE} AS rule_id FROM blocks WHERE {_CLEAN} <> ''")
def suppressed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.suppress_lines(derived(spark, sf_dir, "blocks").select("doc_id", "ord", "text"))


@query(f"""WITH r AS (SELECT doc_id, {_RULE} AS r, CASE WHEN is_heading THEN lower({_CLEAN}) END AS h FROM blocks),
m AS (SELECT doc_id, count(*) FILTER (r = 'page_number_only') AS page_numbers, count(*) FILTER (r = 'check_for_updates_banner') AS banners, count(*) FILTER (r = 'affiliation_address_line') AS affiliations, count(h) AS headings, count(DISTINCT h) AS distinct_headings FROM r GROUP BY doc_id)
SELECT *, headings = 0 OR headings - distinct_headings > 0.2 * headings AS section_boundary_unstable FROM m""")
def document_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived(spark, sf_dir, "blocks").withColumn("role", F.when(F.col("is_heading"), "Heading").otherwise("Body"))
    return paragraphs.document_metrics(b)


@query(f"WITH {LINES_SQL}, t AS (SELECT doc_id, line_no, replace({_CLEAN}, chr(173), '') AS text FROM lines) SELECT doc_id, line_no, text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(text) ORDER BY line_no) AS n FROM t WHERE text <> '') WHERE n = 1")
def unique_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.unique_texts(lines(spark, sf_dir))


@query(f"""WITH {LINES_SQL}, w AS (SELECT doc_id, line_no, {_WORDS.format(_CLEAN)} AS w FROM lines)
SELECT doc_id, line_no, len(w)::INT AS n_words, coalesce(round(len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) / nullif(len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))), 0), 6), 0.0) AS title_ratio,
len(list_filter(w, lambda x: regexp_matches(x, '[0-9]')))::INT AS digit_words, coalesce(round(len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{Ll}}'))) / nullif(len(w), 0), 6), 0.0) AS lower_ratio FROM w""")
def word_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.word_statistics(lines(spark, sf_dir))


@query("""SELECT doc_id, block_id, font_size > 1.1 * coalesce(avg(CASE WHEN font_size > 0 THEN font_size END) OVER (PARTITION BY doc_id), 12.0) AND length(text) < 150 AND is_bold AS is_heading,
(y0 < 79.1 OR y1 > 0.9 * 791.0) AND length(text) < 100 AS is_header_footer, CASE WHEN (x0 + x1) / 2 < 297.5 THEN 1 ELSE 2 END AS "column" FROM blocks""")
def block_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.flags(derived(spark, sf_dir, "blocks"))


@query("""SELECT doc_id, block_id, CASE WHEN t = '' OR regexp_matches(t, '^[0-9]+$') THEN 'noise' WHEN regexp_matches(t, '^Table [0-9]+') THEN 'table' WHEN regexp_matches(t, '^Fig. [0-9]+') THEN 'figure'
WHEN (y1 / 791.0 < 0.1 OR y0 / 791.0 > 0.9) AND length(t) < 50 THEN 'header_footer' WHEN (x1 / 595.0 < 0.2 OR x0 / 595.0 > 0.8) AND length(t) < 100 THEN 'sidebar' ELSE 'content' END AS category,
CASE WHEN t = '' THEN 0.9 WHEN regexp_matches(t, '^[0-9]+$') THEN 0.85 WHEN regexp_matches(t, '^(Table|Fig.) [0-9]+') THEN 0.8 WHEN (y1 / 791.0 < 0.1 OR y0 / 791.0 > 0.9) AND length(t) < 50 THEN 0.7 WHEN (x1 / 595.0 < 0.2 OR x0 / 595.0 > 0.8) AND length(t) < 100 THEN 0.6 ELSE 0.7 END::DOUBLE AS confidence
FROM (SELECT *, trim(text) AS t FROM blocks)""")
def block_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.classify(derived(spark, sf_dir, "blocks"), noise=layout.NOISE_OF_YEARS)


_ROLED = "roled AS (SELECT *, CASE WHEN text LIKE 'Table %' THEN 'TableCaption' WHEN is_heading THEN 'Heading' WHEN is_header_footer THEN 'HeaderFooter' ELSE 'Body' END AS role, row_number() OVER (PARTITION BY doc_id, page ORDER BY column_guess, y0, x0, ord) AS reading_pos FROM blocks)"


@query(f"WITH {_ROLED} SELECT doc_id, block_id, role, reading_pos FROM roled")
def fallback_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.fallback_roles(derived(spark, sf_dir, "blocks")).select("doc_id", "block_id", "role", "reading_pos")


@query(f"""WITH {_ROLED}, j AS (SELECT *, lag(role) OVER w = 'Body' AND role = 'Body' AND lag(column_guess) OVER w = column_guess AND y0 - lag(y1) OVER w BETWEEN 0 AND 20 AS j FROM roled WINDOW w AS (PARTITION BY doc_id, page ORDER BY column_guess, y0, ord)),
r AS (SELECT *, sum(CASE WHEN j THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page ORDER BY column_guess, y0, ord ROWS UNBOUNDED PRECEDING) AS run FROM j),
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, run) AS n FROM r)
SELECT doc_id, page, (dense_rank() OVER (PARTITION BY doc_id, page ORDER BY run) - 1)::INT AS group_no, block_id FROM n WHERE n > 1""")
def merge_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.merge_groups(layout.fallback_roles(derived(spark, sf_dir, "blocks")))


@query(f"""WITH o AS (SELECT *, trim(text) = '' OR {_CAPTION} AS out FROM blocks),
j AS (SELECT *, NOT out AND NOT lag(out) OVER w AND lag(column_guess) OVER w = column_guess AND abs(lag(x0) OVER w - x0) <= 3 AND y0 - lag(y1) OVER w BETWEEN 0 AND 15 AND abs(lag(font_size) OVER w - font_size) <= 0.6 AND lag(font) OVER w = font AS j FROM o WINDOW w AS (PARTITION BY doc_id, page ORDER BY y0, x0, ord)),
r AS (SELECT *, sum(CASE WHEN j THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page ORDER BY y0, x0, ord ROWS UNBOUNDED PRECEDING) AS run FROM j),
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, run) AS n FROM r WHERE NOT out)
SELECT doc_id, page, dense_rank() OVER (PARTITION BY doc_id, page ORDER BY run)::INT AS island, block_id FROM n WHERE n > 1""")
def paragraph_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.paragraph_islands(derived(spark, sf_dir, "blocks"))


@query(f"""WITH k AS (SELECT *, CASE WHEN {_CAPTION} THEN 'caption' WHEN is_bold AND length(text) <= 180 THEN 'heading' ELSE 'body' END AS kind FROM blocks WHERE trim(text) <> ''),
f AS (SELECT doc_id, kind, font FROM (SELECT doc_id, kind, font, row_number() OVER (PARTITION BY doc_id, kind ORDER BY count(*) DESC, min(ord)) AS r FROM k GROUP BY doc_id, kind, font) WHERE r = 1)
SELECT doc_id, kind, count(*) AS n_blocks, median(font_size::DOUBLE) AS median_size, round(avg(is_bold::INT), 3) AS bold_ratio, any_value(f.font) AS dominant_font FROM k JOIN f USING (doc_id, kind) GROUP BY doc_id, kind""")
def font_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.font_profile(derived(spark, sf_dir, "blocks"))


@query("""WITH x AS (SELECT doc_id, page, (x0 + x1) / 2 / 595.0 AS x FROM blocks),
s AS (SELECT doc_id, page, avg((x < 0.35)::INT) AS l, avg((x BETWEEN 0.35 AND 0.65)::INT) AS m, avg((x > 0.65)::INT) AS r FROM x GROUP BY ALL),
p AS (SELECT doc_id, page, CASE WHEN m > 0.6 THEN 1 WHEN l > 0.2 AND r > 0.2 AND m < 0.3 THEN 2 WHEN l > 0.15 AND m > 0.15 AND r > 0.15 THEN 3 WHEN l > 0 AND r > 0 THEN 2 ELSE 1 END AS columns, CASE WHEN m > 0.6 THEN 0.8 WHEN l > 0.2 AND r > 0.2 AND m < 0.3 THEN 0.85 WHEN l > 0.15 AND m > 0.15 AND r > 0.15 THEN 0.7 WHEN l > 0 AND r > 0 THEN 0.6 ELSE 0.5 END::DOUBLE AS confidence FROM s),
v AS (SELECT doc_id, columns AS column_mode FROM (SELECT doc_id, columns, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(page)) AS n FROM p GROUP BY doc_id, columns) WHERE n = 1)
SELECT * FROM p JOIN v USING (doc_id)""")
def page_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.columns_of_pages(derived(spark, sf_dir, "blocks"))


@query("SELECT doc_id, page, min(x0) AS bx0, min(y0) AS by0, max(x1) AS bx1, max(y1) AS by1 FROM blocks GROUP BY ALL")
def page_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.page_bounds(derived(spark, sf_dir, "blocks"))


@query("""WITH s AS (SELECT doc_id, page, count(*) AS n, avg(length(trim(text))) AS a, avg((length(trim(text)) <= 24)::INT) AS sh, avg(((x1 - x0) * (y1 - y0) <= 3500)::INT) AS sm FROM blocks GROUP BY ALL)
SELECT doc_id, page, n, CASE WHEN (n >= 3 AND a <= 40 AND sh >= 0.6) OR (n >= 2 AND a <= 45 AND (sh >= 0.55 OR sm >= 0.45)) THEN 'hierarchical' ELSE 'direct' END AS mode FROM s""")
def layout_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.layout_mode(derived(spark, sf_dir, "blocks"), dense=3, denser=2)


_REGIONS = "SELECT DISTINCT doc_id, page, CONCAT('region_', CAST(doc_id % 3 AS STRING)) AS region_id, CAST(doc_id % 3 AS INT) AS class_rank, 30.0 AS rx0, 10.0 + doc_id % 40 AS ry0, 300.0 AS rx1, 60.0 + doc_id % 40 AS ry1 FROM {0} UNION ALL SELECT DISTINCT doc_id, page, 'side', 3, 250.0, 0.0, 560.0, 75.0 FROM {0}"


@query(f"""WITH rg AS ({_REGIONS.format('blocks')}),
c AS (SELECT b.doc_id, block_id, region_id, class_rank, (x0 + x1) / 2 BETWEEN rx0 AND rx1 AND (y0 + y1) / 2 BETWEEN ry0 AND ry1 AS hit,
greatest(0, least(x1, rx1) - greatest(x0, rx0)) * greatest(0, least(y1, ry1) - greatest(y0, ry0)) / greatest(1, (x1 - x0) * (y1 - y0)) AS share FROM blocks b JOIN rg USING (doc_id, page))
SELECT doc_id, block_id, region_id, class_rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, block_id ORDER BY CASE WHEN hit THEN 0 ELSE 1 END, CASE WHEN hit THEN 0 ELSE -share END, class_rank, region_id) AS n FROM c WHERE hit OR share >= 0.05) WHERE n = 1""")
def region_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = derived(spark, sf_dir, "blocks")
    return layout.project_regions(b, spark.sql(_REGIONS.format("{blocks}"), blocks=b))


@query("""WITH bd AS (SELECT doc_id, page, min(x0) AS bx0, max(x1) AS bx1 FROM blocks GROUP BY ALL),
s AS (SELECT doc_id, page, ord, text, ((x0 + x1) / 2 - bx0) / greatest(1e-6, bx1 - bx0) >= 0.5 AS rt FROM blocks JOIN bd USING (doc_id, page) WHERE trim(text) <> ''),
f AS (SELECT doc_id, text, coalesce(lag(page) OVER w = page AND lag(rt) OVER w <> rt, false)::INT AS flip FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY page, ord))
SELECT doc_id, sum(flip)::BIGINT AS flips, sum(len(list_filter(string_split(trim(text), ' '), lambda x: x <> '')))::BIGINT AS tokens, round(sum(flip) * 1000.0 / sum(len(list_filter(string_split(trim(text), ' '), lambda x: x <> ''))), 6) AS flips_per_1000 FROM f GROUP BY doc_id""")
def column_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.column_flips(derived(spark, sf_dir, "blocks"))


@query("SELECT doc_id, ord, y0, round(avg(y0) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving_average FROM blocks")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.moving_average(derived(spark, sf_dir, "blocks").select("doc_id", "ord", "y0"), "doc_id", "ord", "y0", 3)


@query(f"""WITH {_ROLED} SELECT doc_id, page, block_id, last_value(CASE WHEN role = 'Heading' THEN block_id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page, reading_pos ROWS UNBOUNDED PRECEDING) AS heading_id,
lag(block_id) OVER (PARTITION BY doc_id ORDER BY page, reading_pos) AS prev_id, lead(block_id) OVER (PARTITION BY doc_id ORDER BY page, reading_pos) AS next_id FROM roled""")
def section_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.sections(layout.fallback_roles(derived(spark, sf_dir, "blocks")))


@query()
def boundary_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repair_boundaries(derived(spark, sf_dir, "paragraphs"))


_MARKER = "regexp_matches(trim(lower(anchor_text)), '^[\\[(]?[0-9]+(\\s*[-,;]\\s*[0-9]+)*[\\])]?$')"


@query(f"SELECT doc_id, anchor_id, CASE WHEN {_MARKER} OR anchor_text LIKE '10.1000/%' THEN 'citation_marker' WHEN anchor_text LIKE 'http%' THEN 'resource_link' WHEN link_type = 'internal' THEN 'citation_marker' WHEN link_type = 'external' THEN 'resource_link' ELSE 'structural_link' END AS anchor_type FROM anchors")
def anchor_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.anchor_types(derived(spark, sf_dir, "anchors")).select("doc_id", "anchor_id", "anchor_type")


@query("""WITH u AS (SELECT doc_id % 500 AS doc_id, page, anchor_text, link_type, source_rank, anchor_id FROM anchors)
SELECT doc_id, page, anchor_text, link_type, anchor_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, anchor_text, link_type ORDER BY source_rank, anchor_id) AS n FROM u) WHERE n = 1""")
def distinct_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = derived(spark, sf_dir, "anchors").withColumn("doc_id", F.col("doc_id") % 500)
    return citations.distinct_anchors(a).select("doc_id", "page", "anchor_text", "link_type", "anchor_id")


@query("""WITH pg AS (SELECT DISTINCT doc_id, page AS pp FROM paragraphs),
n AS (SELECT a.doc_id, anchor_id, ax, ay, pp FROM (SELECT a.doc_id, anchor_id, ax, ay, pp, row_number() OVER (PARTITION BY a.doc_id, anchor_id ORDER BY abs(pp - page), pp) AS r FROM anchors a JOIN pg ON a.doc_id = pg.doc_id) a WHERE r = 1)
SELECT doc_id, anchor_id, para_id FROM (SELECT n.doc_id, anchor_id, para_id, row_number() OVER (PARTITION BY n.doc_id, anchor_id ORDER BY abs(y0 - ay), abs((x0 + x1) / 2 - ax), para_id) AS r FROM n JOIN paragraphs p ON p.doc_id = n.doc_id AND p.page = pp) WHERE r = 1""")
def nearest_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.nearest_paragraphs(derived(spark, sf_dir, "anchors"), derived(spark, sf_dir, "paragraphs"))


_EXPAND = """ex AS (SELECT doc_id, anchor_id, unnest(string_split(regexp_replace(replace(anchor_text, ' ', ''), '[\\[\\]()]', '', 'g').replace(';', ','), ',')) AS part FROM anchors),
rg AS (SELECT doc_id, anchor_id, CASE WHEN regexp_matches(part, '^[0-9]{1,9}-[0-9]{1,9}$') THEN split_part(part, '-', 1)::INT WHEN regexp_matches(part, '^[0-9]{1,9}$') THEN part::INT END AS lo, CASE WHEN regexp_matches(part, '^[0-9]{1,9}-[0-9]{1,9}$') THEN split_part(part, '-', 2)::INT WHEN regexp_matches(part, '^[0-9]{1,9}$') THEN part::INT END AS hi FROM ex),
mk AS (SELECT DISTINCT doc_id, anchor_id, marker FROM (SELECT doc_id, anchor_id, unnest(range(lo, hi + 1))::INT AS marker FROM rg WHERE lo <= hi AND hi - lo <= 30) WHERE marker > 0)"""
_KEY = "CASE WHEN coalesce(doi, '') <> '' THEN 'doi:' || lower(doi) WHEN coalesce(pmid, '') <> '' THEN 'pmid:' || pmid ELSE 'title:' || trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) || '|year:' || coalesce(year::VARCHAR, '') END"
_MAPPED = f"fr AS (SELECT doc_id, marker, arg_min({_KEY}, ord) AS ref_key FROM refs GROUP BY ALL), mp AS (SELECT mk.doc_id, anchor_id, mk.marker, ref_key, CASE WHEN ref_key IS NULL THEN 'none' ELSE 'regex' END AS strategy FROM mk LEFT JOIN fr ON mk.doc_id = fr.doc_id AND mk.marker = fr.marker)"


def _keyed(spark, sf_dir):
    from ..functions.text import reference_key

    return derived(spark, sf_dir, "refs").withColumn("ref_key", reference_key(F.col("doi"), F.col("pmid"), F.col("title"), F.col("year")))


@query(f"WITH {_EXPAND}, {_MAPPED} SELECT * FROM mp")
def marker_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.map_markers(derived(spark, sf_dir, "anchors"), _keyed(spark, sf_dir))


@query(f"""WITH a AS (SELECT doc_id, anchor_id, unnest(list_distinct(list_filter(regexp_extract_all(lower(anchor_text), '[a-z0-9]{{4,}}'), lambda x: x NOT IN ('http', 'https', 'www', 'doi', 'pmid')))) AS token, len(list_distinct(list_filter(regexp_extract_all(lower(anchor_text), '[a-z0-9]{{4,}}'), lambda x: x NOT IN ('http', 'https', 'www', 'doi', 'pmid')))) AS n FROM anchors WHERE NOT {_MARKER}),
r AS (SELECT doc_id, {_KEY} AS ref_key, ord, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{{4,}}'))) AS token FROM refs),
h AS (SELECT a.doc_id, anchor_id, n, ref_key, ord, count(*) AS k FROM a JOIN r ON a.doc_id = r.doc_id AND a.token = r.token GROUP BY ALL HAVING count(*) / n >= 0.35),
u AS (SELECT doc_id, anchor_id, ref_key, ord, k / n AS part, least(0.84, 0.55 + k / n * 0.35) AS score FROM h UNION ALL SELECT x.doc_id, x.anchor_id, {_KEY}, ord, 2, 0.88 FROM anchors x JOIN refs y ON x.doc_id = y.doc_id AND contains(lower(y.text), trim(lower(x.anchor_text))) WHERE length(trim(x.anchor_text)) >= 8 AND EXISTS (SELECT 1 FROM a WHERE a.doc_id = x.doc_id AND a.anchor_id = x.anchor_id))
SELECT doc_id, anchor_id, ref_key, round(score, 6) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, anchor_id ORDER BY part DESC, ord) AS rn FROM u) WHERE rn = 1""")
def fuzzy_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return citations.fuzzy_references(derived(spark, sf_dir, "anchors"), _keyed(spark, sf_dir))


_FIRST = "(SELECT {0} FROM refs x WHERE x.doc_id = g.doc_id AND x.ref_key = g.ref_key)"
_MERGE = f"""kr AS (SELECT *, {_KEY} AS ref_key, CASE WHEN kind = 'api' THEN 0 ELSE 1 END * 1000000 + ord AS rk FROM refs),
mr AS (SELECT doc_id, ref_key, arg_min(title, rk) FILTER (coalesce(title, '') <> '') AS title, arg_min(doi, rk) FILTER (doi IS NOT NULL) AS doi, arg_min(pmid, rk) FILTER (pmid IS NOT NULL) AS pmid, arg_min(year, rk) FILTER (year IS NOT NULL) AS year, arg_min(venue, rk) FILTER (venue IS NOT NULL) AS venue,
max(confidence)::DOUBLE AS confidence, array_to_string(list_sort(list_distinct(list(provider))), '+') AS source_chain, count(*) AS n_records FROM kr GROUP BY doc_id, ref_key)"""


@query(f"WITH {_MERGE} SELECT * FROM mr")
def reference_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = citations.merge_references(derived(spark, sf_dir, "refs"))
    return m.withColumn("confidence", F.col("confidence").cast("double"))


_STRONG = "(caption_id IS NOT NULL) DESC, (coalesce(caption_text, '') <> '') DESC, confidence DESC"
_DEDUPED = f"""d1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, asset_id ORDER BY {_STRONG}, ord DESC) AS n FROM assets) WHERE n = 1),
da AS (SELECT * FROM (SELECT * EXCLUDE n, row_number() OVER (PARTITION BY doc_id, asset_type, page, coalesce(lower(trim(caption_id)), lower(trim(substring(coalesce(caption_text, ''), 1, 160)))) ORDER BY {_STRONG}, asset_id) AS n FROM d1) WHERE n = 1)"""


@query(f"WITH {_DEDUPED} SELECT doc_id, asset_id, asset_type, page, caption_id FROM da")
def asset_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.dedupe_assets(derived(spark, sf_dir, "assets")).select("doc_id", "asset_id", "asset_type", "page", "caption_id")


@query("""WITH c AS (SELECT doc_id, page, para_id AS caption_id, ord AS c_ord, x0 AS cx0, y0 AS cy0, x1 AS cx1 FROM paragraphs WHERE role LIKE '%Caption'),
n AS (SELECT i.doc_id, i.block_id AS image_id, caption_id, row_number() OVER (PARTITION BY i.doc_id, i.block_id ORDER BY abs(cy0 - i.y1), c_ord) AS r FROM blocks i JOIN c ON i.doc_id = c.doc_id AND i.page = c.page
WHERE cy0 - i.y1 >= -50 AND cy0 - i.y1 < 220 AND greatest(0, least(i.x1, cx1) - greatest(i.x0, cx0)) / greatest(1, i.x1 - i.x0) >= 0.15) SELECT doc_id, image_id, caption_id FROM n WHERE r = 1""")
def image_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = derived(spark, sf_dir, "blocks").select("doc_id", "page", F.col("block_id").alias("image_id"), F.col("x0").alias("ix0"), F.col("x1").alias("ix1"), F.col("y1").alias("iy1"))
    captions = derived(spark, sf_dir, "paragraphs").where("role like '%Caption'").select("doc_id", "page", F.col("para_id").alias("caption_id"), F.col("ord").alias("c_ord"), F.col("x0").alias("cx0"), F.col("y0").alias("cy0"), F.col("x1").alias("cx1"))
    return assets.image_captions(images, captions)


@query("SELECT doc_id, para_id AS caption_id, page FROM paragraphs p WHERE role LIKE '%Caption' AND NOT EXISTS (SELECT 1 FROM assets a WHERE a.doc_id = p.doc_id AND a.caption_id = p.para_id)")
def captions_without_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    captions = derived(spark, sf_dir, "paragraphs").where("role like '%Caption'").select("doc_id", F.col("para_id").alias("caption_id"), "page")
    return assets.missing_assets(captions, derived(spark, sf_dir, "assets"))


def _cat(c: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower({c}), '{p}')" for p in parts) + f" THEN '{name}'" for name, parts in reading.CATEGORIES) + " ELSE 'background' END"


_NOISE_ST = "(len(w) < 5 OR contains(lower(st), 'department of') OR contains(lower(st), 'check for updates') OR contains(lower(st), 'orcid') OR (len(w) <= 45 AND len(list_filter(w, lambda x: regexp_matches(x, '[0-9]'))) >= 3 AND length(st) - length(replace(st, ',', '')) >= 2) OR (len(w) <= 50 AND len(list_filter(w, lambda x: regexp_matches(x, '^\\p{Lu}'))) > 0.6 * len(w) AND length(st) - length(replace(st, ',', '')) >= 2))"


@query(f"""WITH s0 AS (SELECT *, array_to_string(list_slice({_WORDS.format("replace(text, '. More follows.', '.')")}, 1, 30), ' ') AS st FROM paragraphs), s AS (SELECT *, {_WORDS.format('st')} AS w FROM s0),
c AS (SELECT *, least(40, len(w)) + confidence * 10 + CASE role WHEN 'Heading' THEN -8 WHEN 'Body' THEN 8 ELSE -10 END + CASE WHEN regexp_matches(st, '[0-9]') THEN 6 ELSE 0 END + CASE WHEN regexp_matches(lower(st), 'significant|increase|decrease|risk|associated') THEN 6 ELSE 0 END + CASE WHEN narrative THEN 18 ELSE -22 END AS score FROM s WHERE st <> '' AND NOT {_NOISE_ST}),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, narrative ORDER BY score DESC, ord) AS r, least(3, count(*) FILTER (narrative) OVER (PARTITION BY doc_id)) AS n FROM c)
SELECT doc_id, para_id, page, ord, narrative, st AS statement, {_cat('st')} AS category, st AS quote, false AS quote_truncated, round(score, 6)::DOUBLE AS score FROM r WHERE CASE WHEN narrative THEN r <= 3 ELSE r <= 3 - n END""")
def fact_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reading.fact_candidates(derived(spark, sf_dir, "paragraphs"), most=3)
    return out.withColumn("score", F.col("score").cast("double"))


@query()
def fact_candidates_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.fact_candidates(derived(spark, sf_dir, "paragraphs")).withColumn("score", F.col("score").cast("double"))


@query(f"""WITH c AS (SELECT *, len(w) AS n, least(70, len(w)) + confidence * 10 + CASE role WHEN 'Heading' THEN 12 WHEN 'Body' THEN 4 ELSE 0 END + CASE WHEN len(w) BETWEEN 18 AND 180 THEN 6 ELSE 0 END AS score, coalesce(section, printf('page_%03d', page)) AS sec FROM (SELECT *, {_WORDS.format('trim(text)')} AS w FROM paragraphs) WHERE len(w) >= 5 OR role = 'Heading'),
k AS (SELECT doc_id, greatest(3, least(12, 4 // count(DISTINCT sec))) AS per FROM c GROUP BY doc_id),
r AS (SELECT c.*, row_number() OVER (PARTITION BY c.doc_id, sec ORDER BY score DESC, page, para_id) <= per AS own FROM c JOIN k ON c.doc_id = k.doc_id),
g AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY own DESC, CASE WHEN own THEN 0 ELSE -score END, ord) AS g FROM r)
SELECT doc_id, para_id, sec AS section, round(score, 6)::DOUBLE AS score FROM g WHERE g <= 4""")
def balanced_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.balanced_selection(derived(spark, sf_dir, "paragraphs"), most=4).withColumn("score", F.col("score").cast("double"))


@query()
def balanced_selection_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.balanced_selection(derived(spark, sf_dir, "paragraphs")).withColumn("score", F.col("score").cast("double"))


@query("""WITH g AS (SELECT doc_id, category, count(*) AS n, list_slice(list(fact_id ORDER BY ord, fact_id), 1, 20) AS ids FROM facts GROUP BY ALL)
SELECT doc_id, printf('theme_%03d', row_number() OVER (PARTITION BY doc_id ORDER BY category)) AS theme_id, category, array_to_string(ids, ',') AS fact_ids, CASE WHEN n >= 3 THEN 'moderate' ELSE 'weak' END AS strength FROM g""")
def themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.themes(derived(spark, sf_dir, "facts"))


@query(f"""WITH s AS (SELECT *, statement AS st, {_WORDS.format('trim(statement)')} AS w FROM facts),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY least(60, len(w)) + 12 + CASE WHEN regexp_matches(lower(st), 'risk|increase|decrease|outcome|associated|repair|tear') THEN 10 ELSE 0 END DESC, ord) AS rank FROM s WHERE NOT {_NOISE_ST})
SELECT doc_id, 'line_' || fact_id AS line_id, substring(st, 1, 200) AS statement, rank FROM r WHERE rank <= 8""")
def key_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.key_lines(derived(spark, sf_dir, "facts"))


@query("""SELECT doc_id, fact_id AS source, para_id AS target, 'derived_from' AS relation FROM facts UNION ALL SELECT doc_id, para_id, 'page_' || page, 'located_near' FROM paragraphs p WHERE EXISTS (SELECT 1 FROM facts f WHERE f.doc_id = p.doc_id AND f.para_id = p.para_id)""")
def evidence_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.evidence_edges(derived(spark, sf_dir, "facts"), derived(spark, sf_dir, "paragraphs"))


_ANCHORED = """ot AS (SELECT f.doc_id, f.fact_id, count(DISTINCT p.para_id) AS c FROM facts f JOIN paragraphs p ON f.doc_id = p.doc_id AND f.block_id = p.block_id AND f.page = p.page WHERE trim(p.text) <> '' GROUP BY ALL),
af AS (SELECT f.*, CASE WHEN coalesce(nullif(trim(quote), ''), nullif(trim(statement), '')) IS NULL THEN 'missing_text_evidence' WHEN p.para_id IS NOT NULL AND trim(p.text) = '' THEN 'empty_paragraph_text' WHEN p.para_id IS NOT NULL THEN CASE WHEN f.page = p.page THEN 'ok' ELSE 'fact_page_not_in_paragraph_span' END WHEN c = 1 THEN 'ok' WHEN c > 1 THEN 'ambiguous_paragraph_mapping' ELSE 'missing_paragraph_mapping' END AS reason
FROM facts f LEFT JOIN paragraphs p ON f.doc_id = p.doc_id AND f.para_id = p.para_id LEFT JOIN ot ON f.doc_id = ot.doc_id AND f.fact_id = ot.fact_id)"""


@query(f"WITH {_ANCHORED} SELECT doc_id, fact_id, reason FROM af")
def anchored_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.anchored_facts(derived(spark, sf_dir, "facts"), derived(spark, sf_dir, "paragraphs")).select("doc_id", "fact_id", "reason")


_GATES = f"""{_ANCHORED}, {_EXPAND}, {_MAPPED}, {_MERGE},
g1 AS (SELECT doc_id, round(avg((reason = 'ok')::INT), 6) AS value, count(*) FILTER (reason <> 'ok' AND (category IN ('result', 'statistics', 'comparison', 'limitation') OR regexp_matches(lower(statement), '[0-9]|\\b(better|worse|superior|inferior|more effective|less effective|causes|leads to|results in|associated with|should|must|recommended|guideline)\\b'))) AS bad FROM af GROUP BY doc_id),
g2 AS (SELECT * FROM (SELECT a.doc_id, round(avg((CASE WHEN a.doc_id % 50 = 0 THEN a.ord < b.ord ELSE a.ord > b.ord END)::INT), 6) AS value FROM paragraphs a JOIN paragraphs b ON a.doc_id = b.doc_id AND b.ord = a.ord + 1 GROUP BY a.doc_id) LEFT JOIN (SELECT doc_id, count(DISTINCT page) FILTER (doc_id % 37 = page) / count(DISTINCT page) AS mixed FROM paragraphs WHERE page % 2 = 1 GROUP BY doc_id) USING (doc_id)),
mg AS (SELECT doc_id, anchor_id, list(ref_key) FILTER (ref_key IS NOT NULL) AS keys FROM mp GROUP BY ALL),
tr AS (SELECT a.doc_id, a.anchor_id, CASE WHEN a.doc_id % 53 = 0 THEN 'doi:10.1000/none' ELSE coalesce(fr.ref_key, 'bib:none') END AS expected FROM (SELECT *, regexp_extract(anchor_text, '[0-9]+')::INT AS m FROM anchors WHERE {_MARKER}) a LEFT JOIN fr ON a.doc_id = fr.doc_id AND fr.marker = a.m),
g3 AS (SELECT tr.doc_id, round(avg((coalesce(len(keys), 0) > 0)::INT), 6) AS value, coalesce(avg(coalesce(list_contains(keys, expected), false)::INT) FILTER (regexp_matches(expected, '^(doi|pmid):')), 0) AS precision FROM tr LEFT JOIN mg ON tr.doc_id = mg.doc_id AND tr.anchor_id = mg.anchor_id GROUP BY tr.doc_id),
g4 AS (SELECT doc_id, round(avg((coalesce(caption_id, '') = 'para_' || doc_id || '_1')::INT), 6) AS value, round(count(caption_id) / count(*), 6) AS kept FROM assets WHERE asset_type = 'figure' GROUP BY doc_id),
g5 AS (SELECT doc_id, count(*) FILTER (ends_with(quote, ' ...') AND NOT quote_truncated)::DOUBLE AS value FROM facts GROUP BY doc_id),
rw AS (SELECT doc_id, count(*) FILTER (kind = 'api') AS a, count(*) FILTER (kind = 'pdf') AS p, count(*) FILTER (kind = 'api' AND (doi IS NOT NULL OR pmid IS NOT NULL)) AS ai, count(*) FILTER (kind = 'pdf' AND (doi IS NOT NULL OR pmid IS NOT NULL)) AS pi FROM refs GROUP BY doc_id),
mm AS (SELECT doc_id, count(*) AS m, count(*) FILTER (doi IS NOT NULL OR pmid IS NOT NULL) AS mi FROM mr GROUP BY doc_id),
g6 AS (SELECT rw.doc_id, round(mi / m, 6) AS value, CASE WHEN least(ai, pi) > 0 THEN least(1.0, greatest(0, ai + pi - mi) / least(ai, pi)) WHEN least(a, p) > 0 THEN least(1.0, greatest(0, a + p - m) / least(a, p)) ELSE greatest(0.0, 1 - m / (a + p)) END AS rate FROM rw JOIN mm ON rw.doc_id = mm.doc_id),
gs AS (SELECT doc_id, 'provenance_coverage' AS gate, value, CASE WHEN value >= 0.95 AND bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM g1
UNION ALL SELECT doc_id, 'paragraph_inversion_rate', value, CASE WHEN value <= 0.02 AND coalesce(mixed, 0) <= 0.01 THEN 'PASS' ELSE 'FAIL' END FROM g2
UNION ALL SELECT doc_id, 'citation_mapping_coverage', value, CASE WHEN value >= 0.98 AND precision >= 0.99 THEN 'PASS' ELSE 'FAIL' END FROM g3
UNION ALL SELECT doc_id, 'figure_caption_precision', value, CASE WHEN value >= 0.9 AND kept >= 0.95 THEN 'PASS' ELSE 'DEGRADED' END FROM g4
UNION ALL SELECT doc_id, 'silent_truncation_count', value, CASE WHEN value = 0 THEN 'PASS' ELSE 'DEGRADED' END FROM g5
UNION ALL SELECT doc_id, 'reference_pipeline_quality', value, CASE WHEN value >= 0.5 AND rate >= 0.05 THEN 'PASS' ELSE 'DEGRADED' END FROM g6)"""


def _gate_rows(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    p, f, a = (derived(spark, sf_dir, n) for n in ("paragraphs", "facts", "assets"))
    anchors, refs = derived(spark, sf_dir, "anchors"), _keyed(spark, sf_dir)
    anchored = gates.anchored_facts(f, p)
    claims = f.select("doc_id", F.col("fact_id").alias("line_id"), "statement", "fact_id")
    nxt = p.select("doc_id", F.col("para_id").alias("right_id"), (F.col("ord") - 1).alias("ord"))
    pairs = p.join(nxt, ["doc_id", "ord"]).select("doc_id", F.col("para_id").alias("left_id"), "right_id", (F.col("doc_id") % 50 != 0).alias("left_first"))
    mapped = citations.map_markers(anchors, refs)
    # the true key comes from the first number of the marker and the references, not from the mapping that is judged
    first = refs.groupBy("doc_id", F.col("marker").alias("m")).agg(F.min_by("ref_key", "ord").alias("expected"))
    marked = anchors.where(F.lower(F.trim("anchor_text")).rlike(citations.MARKER)).select("doc_id", "anchor_id", F.regexp_extract("anchor_text", "[0-9]+", 0).cast("int").alias("m"))
    truth = marked.join(first, ["doc_id", "m"], "left").select("doc_id", "anchor_id", F.when(F.col("doc_id") % 53 == 0, "doi:10.1000/none").otherwise(F.coalesce("expected", F.lit("bib:none"))).alias("expected"))
    columns = p.where("page % 2 = 1").select("doc_id", "page", (F.col("doc_id") % 37 == F.col("page")).alias("interleaved")).distinct()
    captions = a.select("doc_id", "asset_id", F.concat(F.lit("para_"), F.col("doc_id").cast("string"), F.lit("_1")).alias("expected_caption")).distinct()
    return [gates.provenance(claims, anchored), gates.reading_order(p, pairs, columns), gates.citation_coverage(truth, mapped), gates.figure_captions(a, captions), gates.silent_truncation(f), gates.reference_quality(refs, citations.merge_references(derived(spark, sf_dir, "refs")))]


@query(f"WITH {_GATES} SELECT doc_id, gate, value, status FROM gs")
def gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import reduce

    return reduce(DataFrame.union, _gate_rows(spark, sf_dir))


@query(f"""WITH {_GATES}, c AS (SELECT doc_id, count(*) AS gates, count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'DEGRADED' AND gate <> 'reference_pipeline_quality') AS degraded, count(*) FILTER (gate IN ('provenance_coverage', 'paragraph_inversion_rate', 'citation_mapping_coverage')) AS hard FROM gs GROUP BY doc_id)
SELECT doc_id, gates, failed, degraded, CASE WHEN failed > 0 THEN 'FAIL' WHEN degraded > 0 OR hard < 3 THEN 'DEGRADED' ELSE 'PASS' END AS status FROM c""")
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.report(*_gate_rows(spark, sf_dir))


@query("""WITH e AS (SELECT DISTINCT doc_id, a AS artifact, k AS key FROM facts, (VALUES ('facts', 'quote'), ('facts', 'page'), ('themes', 'name')) v(a, k)), o AS (SELECT DISTINCT doc_id, 'facts' AS artifact, 'quote' AS key FROM facts WHERE quote <> '' UNION SELECT DISTINCT doc_id, 'facts', 'page' FROM facts)
SELECT * FROM e EXCEPT SELECT * FROM o""")
def missing_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = derived(spark, sf_dir, "facts")
    wanted = F.explode(F.array(*(F.struct(F.lit(a).alias("artifact"), F.lit(k).alias("key")) for a, k in (("facts", "quote"), ("facts", "page"), ("themes", "name")))))
    expected = f.select("doc_id").distinct().select("doc_id", wanted.alias("x")).select("doc_id", "x.*")
    observed = f.where("quote <> ''").select("doc_id", F.lit("facts").alias("artifact"), F.lit("quote").alias("key")).union(f.select("doc_id", F.lit("facts"), F.lit("page"))).distinct()
    return gates.missing_artifacts(expected, observed)


_ENRICHED = """en AS (SELECT *, CASE WHEN success AND error_type = 'none' THEN 'none' WHEN error_type = 'auth_failed' OR fault = 'missing-api-key' THEN 'config/auth' WHEN http_status = 400 THEN 'request-contract' WHEN http_status = 503 OR error_type = 'timeout' THEN 'timeout/retry' ELSE 'parse/validation' END AS category,
CASE WHEN success AND error_type = 'none' THEN 'none' WHEN error_type = 'auth_failed' OR fault = 'missing-api-key' THEN 'missing_credentials' WHEN http_status = 400 THEN 'request_contract' WHEN http_status = 503 OR error_type = 'timeout' THEN 'transient_timeout_or_network' WHEN contains(error_type, 'schema') OR contains(fault, 'parse') THEN 'parse_or_validation' ELSE 'unknown' END AS root_cause_class FROM faults),
er AS (SELECT *, CASE category WHEN 'none' THEN 'not_applicable' WHEN 'timeout/retry' THEN 'retryable' WHEN 'parse/validation' THEN CASE WHEN root_cause_class = 'unknown' THEN 'unknown' ELSE 'non_retryable' END ELSE 'non_retryable' END AS retryability FROM en),
fl AS (SELECT * FROM er WHERE status = 'degraded' OR NOT success OR error_type NOT IN ('', 'none'))"""


@query(f"WITH {_ENRICHED} SELECT attempt_id, stage, fault, error_type, http_status, category, root_cause_class, retryability, fallback_used OR status = 'degraded' AS degraded_output_used FROM er")
def fault_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.enrich(derived(spark, sf_dir, "faults")).select("attempt_id", "stage", "fault", "error_type", "http_status", "category", "root_cause_class", "retryability", "degraded_output_used")


@query(f"""WITH {_ENRICHED}, dd AS (SELECT attempt_id, stage, fault, page, error_type, http_status, category, root_cause_class, retryability, count(*) AS n, min(observed_at) AS a, max(observed_at) AS b FROM fl GROUP BY ALL),
u AS (SELECT attempt_id, 'category' AS dimension, category AS value, n, a, b FROM dd UNION ALL SELECT attempt_id, 'root_cause_class', root_cause_class, n, a, b FROM dd UNION ALL SELECT attempt_id, 'retryability', retryability, n, a, b FROM dd)
SELECT attempt_id, dimension, value, sum(n)::BIGINT AS n_raw, count(*) AS n_deduped, min(a) AS first_at, max(b) AS last_at FROM u GROUP BY ALL""")
def fault_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.fault_summary(telemetry.enrich(derived(spark, sf_dir, "faults")))


_KPI = f"{_ENRICHED}, kp AS (SELECT e.run, count(DISTINCT e.attempt_id) AS n_attempts, any_value(f.failures) AS failures, round(any_value(f.t) / any_value(f.failures), 6) AS timeout_rate, round(any_value(f.bad) / count(DISTINCT e.attempt_id), 6) AS degraded_rate FROM er e JOIN (SELECT run, count(*) AS failures, count(*) FILTER (category = 'timeout/retry') AS t, count(DISTINCT attempt_id) AS bad FROM fl GROUP BY run) f ON e.run = f.run GROUP BY e.run)"


@query(f"WITH {_KPI} SELECT * FROM kp")
def kpi_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.kpis(telemetry.enrich(derived(spark, sf_dir, "faults")))


@query(f"""WITH {_KPI}, u AS (SELECT run, 'failures' AS kpi, failures::DOUBLE AS v FROM kp UNION ALL SELECT run, 'timeout_rate', timeout_rate FROM kp UNION ALL SELECT run, 'degraded_rate', degraded_rate FROM kp)
SELECT kpi, round(sum(v) FILTER (run = 'optimized') - sum(v) FILTER (run = 'baseline'), 6) AS delta FROM u GROUP BY kpi""")
def kpi_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.kpi_delta(telemetry.kpis(telemetry.enrich(derived(spark, sf_dir, "faults"))), "baseline", "optimized")


@query("""SELECT page_id, trim(regexp_replace(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's'), '<[^>]+>', '', 'g')) AS title, len(regexp_extract_all(html, '<h[1-6]'))::INT AS n_headings, len(regexp_extract_all(html, '<p[ >]'))::INT AS n_paragraphs FROM pages""")
def html_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.outline(spark.read.parquet(f"{sf_dir}/pages.parquet"))


_TAILS = "cp AS (SELECT doc_id, page, para_id AS caption_id, ord AS c_ord, x0 AS cx0, y0 AS cy0, x1 AS cx1, y1 AS cy1 FROM paragraphs WHERE role LIKE '%Caption'), tl AS (SELECT b.doc_id, b.page, b.para_id, b.ord, b.x0, b.y0, caption_id, c_ord, cx1, cy0, greatest(0, b.y0 - cy1) AS gap, greatest(0, least(b.x1, cx1) - greatest(b.x0, cx0)) / greatest(1, least(b.x1 - b.x0, cx1 - cx0)) AS share FROM paragraphs b JOIN cp ON b.doc_id = cp.doc_id AND b.page = cp.page WHERE b.role = 'Body' AND b.text <> '')"


def _bodies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = derived(spark, sf_dir, "paragraphs")
    captions = p.where("role like '%Caption'").select("doc_id", "page", F.col("para_id").alias("caption_id"), F.col("ord").alias("c_ord"), *(F.col(c).alias(f"c{c}") for c in ("x0", "y0", "x1", "y1")))
    return p.where("role = 'Body' and text <> ''").select("doc_id", "page", "para_id", "ord", "x0", "y0", "x1", "y1"), captions


@query(f"WITH {_TAILS} SELECT doc_id, para_id, caption_id, round(gap - share * 40, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, para_id ORDER BY gap - share * 40, c_ord) AS n FROM tl WHERE y0 >= cy0 - 20 AND gap <= 120 AND (share >= 0.1 OR x0 >= cx1 - 20 OR gap <= 40)) WHERE n = 1")
def caption_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.caption_tails(*_bodies(spark, sf_dir))


@query(f"""WITH {_TAILS}, bs AS (SELECT *, row_number() OVER (PARTITION BY doc_id, para_id ORDER BY gap - share * 80, c_ord) AS n FROM tl WHERE gap <= 260 AND (share >= 0.05 OR x0 >= cx1 - 24)),
rk AS (SELECT doc_id, page, para_id, caption_id, round(gap - share * 80, 6) AS score, row_number() OVER (PARTITION BY doc_id, page ORDER BY round(gap - share * 80, 6), ord) AS rank FROM bs WHERE n = 1) SELECT * FROM rk WHERE rank <= 1""")
def caption_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.caption_reviews(*_bodies(spark, sf_dir), most=1)


@query()
def caption_reviews_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.caption_reviews(*_bodies(spark, sf_dir), most=2)


@query(f"""WITH s AS (SELECT *, {_WORDS.format('trim(text)')} AS w, length(text) - length(replace(text, ',', '')) AS c FROM paragraphs)
SELECT doc_id, para_id, trim(text) = '' OR contains(lower(text), 'check for updates') OR (contains(lower(text), 'department of') AND contains(lower(text), 'university')) OR (len(w) < 20 AND len(list_filter(w, lambda x: length(regexp_replace(x, '^[.,;:()\\[\\]]+|[.,;:()\\[\\]]+$', '', 'g')) <= 2)) > 0.55 * len(w))
OR (page <= 2 AND len(list_filter(w, lambda x: regexp_matches(x, '[0-9]'))) >= 3 AND c >= 3 AND len(w) <= 45) OR (page <= 2 AND len(w) <= 50 AND len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) > 0.55 * len(w) AND c >= 2) OR NOT regexp_matches(text, '\\p{{L}}') AS is_noise FROM s""")
def noise_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = derived(spark, sf_dir, "paragraphs")
    return p.select("doc_id", "para_id", reading.is_noise_paragraph(F.col("text"), F.col("role"), F.col("page")).alias("is_noise"))


@query(f"""WITH n AS (SELECT f.doc_id, f.fact_id, coalesce(p.narrative, false) AS narrative FROM facts f LEFT JOIN paragraphs p ON f.doc_id = p.doc_id AND f.para_id = p.para_id),
d AS (SELECT doc_id, count(*) AS facts_n, count(*) FILTER (narrative) AS nar, round(avg(narrative::INT), 6) AS ratio FROM n GROUP BY doc_id), t AS (SELECT doc_id, count(DISTINCT category) AS themes_n FROM facts GROUP BY doc_id),
o AS (SELECT DISTINCT doc_id FROM paragraphs)
SELECT o.doc_id, CASE WHEN coalesce(nar, 0) >= 12 AND coalesce(themes_n, 0) >= 3 AND coalesce(ratio, 0) >= 0.8 THEN 'full' ELSE 'degraded' END AS status,
concat_ws(',', CASE WHEN d.doc_id IS NULL THEN 'missing_facts' END, CASE WHEN d.doc_id IS NULL THEN 'missing_themes' END, CASE WHEN d.doc_id IS NULL THEN 'missing_synthesis' END, CASE WHEN coalesce(nar, 0) < 12 THEN 'insufficient_narrative_facts' END, CASE WHEN coalesce(themes_n, 0) < 3 THEN 'insufficient_themes' END, CASE WHEN d.doc_id IS NULL THEN 'missing_key_evidence_fact_links' END, CASE WHEN coalesce(ratio, 0) < 0.8 THEN 'low_narrative_coverage' END) AS reasons, coalesce(ratio, 0.0) AS ratio
FROM o LEFT JOIN d ON o.doc_id = d.doc_id LEFT JOIN t ON o.doc_id = t.doc_id""")
def summary_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, f = derived(spark, sf_dir, "paragraphs"), derived(spark, sf_dir, "facts")
    lines_ = f.select("doc_id", F.col("fact_id").alias("line_id"), "fact_id")
    return reading.summary_status(p.select("doc_id").distinct(), f, p, reading.themes(f), lines_)


@query(f"""WITH {_ROLED}, {_MERGE}, ln AS (SELECT doc_id, page, reading_pos, CASE WHEN role = 'Heading' THEN '## ' || trim(text) WHEN role LIKE '%Caption' THEN '> ' || trim(text) ELSE trim(text) END AS x FROM roled WHERE trim(text) <> '' AND role <> 'HeaderFooter'),
bd AS (SELECT doc_id, string_agg(x, chr(10) || chr(10) ORDER BY page, reading_pos) AS body FROM ln GROUP BY doc_id),
rf AS (SELECT doc_id, string_agg(CASE WHEN n_records > 1 THEN '- [mapped] ' ELSE '- [catalog] ' END || ref_key || ' ' || coalesce(title, ''), chr(10) || chr(10) ORDER BY ref_key) AS refs_ FROM mr GROUP BY doc_id)
SELECT bd.doc_id, body || coalesce(chr(10) || chr(10) || '## References' || chr(10) || chr(10) || refs_, '') AS text FROM bd LEFT JOIN rf ON bd.doc_id = rf.doc_id""")
def rendered_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = citations.merge_references(derived(spark, sf_dir, "refs")).select("doc_id", "ref_key", "title", (F.col("n_records") > 1).alias("mapped"))
    return render.notes(layout.fallback_roles(derived(spark, sf_dir, "blocks")), merged)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_report(spark, sf_dir)
