"""Document tables derived from the relational test tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BLOCKS = """
SELECT doc_id, ord, CONCAT('p', CAST(page AS STRING), '_b', CAST(ord AS STRING)) AS block_id, page, x0, y0, x0 + 240.0 AS x1, y0 + ht AS y1, font_size, is_bold, font, column_guess, text,
  font_size > 8.9 AND is_bold AS is_heading, y0 > 700 AS is_header_footer
FROM (
  SELECT doc_id, rn AS ord, CAST(1 + FLOOR((rn - 1) / 3) AS INT) AS page, CAST(40 + 260 * (pk % 2) AS DOUBLE) AS x0,
    CAST(20 + 30 * ((rn - 1) % 3) + sk % 6 + CASE WHEN sk % 10 = 0 THEN 700 ELSE 0 END AS DOUBLE) AS y0, CAST(14 + qt % 10 AS DOUBLE) AS ht,
    8.0 + 0.5 * (pk % 3) AS font_size, sk % 4 = 0 AS is_bold, CONCAT('F', CAST(sk % 3 AS STRING)) AS font, CAST(1 + pk % 2 AS INT) AS column_guess,
    CASE WHEN pk % 11 = 0 THEN CONCAT('Table ', CAST(rn AS STRING), ' | ', p_name)
      WHEN pk % 13 = 0 THEN CONCAT('Fig. ', CAST(rn AS STRING), ' ', p_type)
      WHEN sk % 17 = 0 THEN ''
      WHEN sk % 19 = 0 THEN CAST(sk AS STRING)
      WHEN sk % 23 = 0 THEN CONCAT(CAST(sk AS STRING), ' Department of ', p_name, ', Example University, Springfield, NY 10016')
      WHEN sk % 7 = 0 THEN 'Check for updates on this page'
      WHEN pk % 5 = 0 THEN CONCAT('The ', p_name, ' of ', p_brand, ' showed no clear effect on the tested ', p_type, ' samples in our cohort. More follows.')
      ELSE CONCAT('we found that ', p_name, ' had a ', CAST(qt AS STRING), '% increase compared with ', p_type, ' controls') END AS text
  FROM (
    SELECT l_orderkey AS doc_id, CAST(l_partkey AS BIGINT) AS pk, CAST(l_suppkey AS BIGINT) AS sk, CAST(l_quantity AS BIGINT) AS qt, p_name, p_type, p_brand,
      ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
    FROM {lineitem} JOIN {part} ON l_partkey = p_partkey) AS a) AS c
"""
PARAGRAPHS = f"""
SELECT doc_id, CONCAT('para_', CAST(doc_id AS STRING), '_', CAST(ord AS STRING)) AS para_id, block_id, page, ord, x0, y0, x1, y1, text,
  CASE WHEN text LIKE 'Table %' THEN 'TableCaption' WHEN text LIKE 'Fig. %' THEN 'FigureCaption' WHEN is_heading THEN 'Heading' ELSE 'Body' END AS role,
  text LIKE 'we found%' OR text LIKE 'The %' AS narrative, 0.5 + (ord % 5) / 10.0 AS confidence,
  CASE WHEN ord % 4 = 0 THEN NULL ELSE CONCAT('section ', CAST(ord % 2 AS STRING)) END AS section
FROM ({BLOCKS}) AS b
"""
FACTS = f"""
SELECT doc_id, CONCAT('fact_', para_id, '_001') AS fact_id, ord, CASE WHEN ord % 5 = 4 THEN 'para_unknown' ELSE para_id END AS para_id, CASE WHEN doc_id % 9 = 0 AND ord % 3 = 0 THEN page + 1 ELSE page END AS page,
  block_id, CASE WHEN ord % 2 = 0 THEN '' ELSE text END AS quote, text AS statement, CASE WHEN doc_id % 31 = 0 THEN 'limitation' WHEN ord % 3 = 0 THEN 'result' WHEN ord % 3 = 1 THEN 'background' ELSE 'comparison' END AS category,
  doc_id % 40 <> 0 AS quote_truncated
FROM ({PARAGRAPHS}) AS p WHERE text <> ''
"""
ANCHORS = """
SELECT o_orderkey AS doc_id, CONCAT('anchor_', CAST(o_orderkey AS STRING)) AS anchor_id, CAST(1 + o_custkey % 4 AS INT) AS page, CAST(o_custkey % 300 AS DOUBLE) AS ax, CAST(o_custkey % 90 AS DOUBLE) AS ay,
  CASE WHEN o_custkey % 5 = 0 THEN CONCAT('[', CAST(o_custkey % 7 AS STRING), '-', CAST(o_custkey % 7 + o_orderkey % 40 AS STRING), ']')
    WHEN o_custkey % 5 = 1 THEN CONCAT('(', CAST(o_custkey % 9 AS STRING), ', ', CAST(o_orderkey % 9 AS STRING), ';0)')
    WHEN o_custkey % 5 = 2 THEN CONCAT('10.1000/', CAST(o_custkey AS STRING))
    WHEN o_custkey % 5 = 3 AND o_orderkey % 4 = 0 THEN 'Widget results'
    WHEN o_custkey % 5 = 3 THEN CONCAT('study of ', LOWER(o_orderpriority), ' widget results')
    ELSE 'http://example.org/paper' END AS anchor_text,
  CASE WHEN o_orderkey % 3 = 0 THEN 'internal' WHEN o_orderkey % 3 = 1 THEN 'external' ELSE 'inline' END AS link_type, CAST(o_orderkey % 2 AS INT) AS source_rank
FROM {orders}
"""
REFERENCES = """
SELECT l_orderkey AS doc_id, CAST(1 + (rn - 1) % 5 AS INT) AS marker, rn AS ord, CASE WHEN rn % 2 = 0 THEN 'api' ELSE 'pdf' END AS kind, CASE WHEN rn % 4 = 0 THEN 'crossref' WHEN rn % 2 = 0 THEN 'pubmed' ELSE 'pdf' END AS provider,
  CASE WHEN sk % 3 = 0 THEN CONCAT('10.1000/', CAST(sk % 4 AS STRING)) ELSE NULL END AS doi, CASE WHEN sk % 3 = 1 THEN CAST(1000000 + sk % 5 AS STRING) ELSE NULL END AS pmid,
  CASE WHEN pk % 6 = 0 THEN '' ELSE CONCAT('Study of ', p_name, ' results') END AS title, CAST(1990 + pk % 3 AS INT) AS year, CASE WHEN pk % 2 = 0 THEN NULL ELSE p_brand END AS venue, 0.5 + (rn % 4) / 10.0 AS confidence,
  CONCAT('study of ', p_name, ' widget results in ', p_type) AS text
FROM (SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS pk, CAST(l_suppkey AS BIGINT) AS sk, p_name, p_brand, p_type, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey) AS a
"""
ASSETS = f"""
SELECT doc_id, CASE WHEN ord % 4 = 3 THEN CONCAT('fig_00', CAST(ord - 1 AS STRING)) ELSE CONCAT('fig_00', CAST(ord AS STRING)) END AS asset_id, ord, CASE WHEN doc_id % 3 = 0 THEN 'table' ELSE 'figure' END AS asset_type, page,
  CASE WHEN ord % 3 = 0 THEN NULL ELSE CONCAT('para_', CAST(doc_id AS STRING), '_', CAST(ord % 2 AS STRING)) END AS caption_id, CASE WHEN ord % 2 = 0 THEN text ELSE '' END AS caption_text, (ord % 4) / 10.0 AS confidence, x0, y0, x1, y1
FROM ({BLOCKS}) AS b
"""
EVENTS = """
SELECT CONCAT('attempt-', CAST(user_id % 50 AS STRING)) AS attempt_id, CASE WHEN user_id % 2 = 0 THEN 'baseline' ELSE 'optimized' END AS run, CASE WHEN event_type = 'error' THEN 'vision' ELSE event_type END AS stage,
  CASE WHEN value < 10 THEN 'missing-api-key' WHEN value < 30 THEN 'none' ELSE 'vision-parse-failure' END AS fault, CAST(event_id % 3 AS INT) AS page,
  CASE WHEN event_id % 7 = 0 THEN 'timeout' WHEN event_id % 7 = 1 THEN 'schema_mismatch' WHEN event_id % 7 = 2 THEN 'auth_failed' ELSE 'none' END AS error_type,
  CASE WHEN event_id % 11 = 0 THEN 400 WHEN event_id % 11 = 1 THEN 503 ELSE NULL END AS http_status, event_id % 7 > 2 AS success, CASE WHEN event_id % 13 = 0 THEN 'degraded' ELSE 'ok' END AS status, event_id % 17 = 0 AS fallback_used, ts AS observed_at
FROM {events}
"""
TABLES = {"blocks": BLOCKS, "paragraphs": PARAGRAPHS, "facts": FACTS, "anchors": ANCHORS, "refs": REFERENCES, "assets": ASSETS, "faults": EVENTS}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = TABLES[name]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))})


def with_tables(query: str) -> str:
    """query for DuckDB, the derived tables it names put before it."""
    names = [n for n in TABLES if re.search(rf"\b{n}\b", query)]
    ctes = ", ".join(f"{n} AS ({TABLES[n].replace('{', '').replace('}', '')})" for n in names)
    body = query.strip()
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))


LINES_SQL = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)"
