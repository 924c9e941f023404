"""The SQL each query is compared with, for DuckDB over the same tables."""

from __future__ import annotations

# The folder the comparison runs on; only file listings need to know it.
SF_DIR = "/root/testdata/sf0.01"

_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_SCRIPT = """
script AS (
  SELECT '/Shared/' || lang || '/' || source || '/doc_' || doc_id AS path, text FROM documents
)"""
_LINE = """
line AS (
  SELECT path, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS line
  FROM (
    SELECT path, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS a
    FROM (SELECT path, string_split_regex(text, '\\r\\n|\\r|\\n') AS p FROM script)
  )
)"""
_ASSET_TABLE = """
asset_table AS (
  SELECT DISTINCT name, 'cat://test/t/' || name AS qualified_name
  FROM (SELECT string_split(split_part(url, '/', 3), '.')[-3] AS name FROM pages)
  WHERE name IS NOT NULL
)"""
_ASSET_FILE = """
asset_file AS (
  SELECT DISTINCT name, 'cat://test/f/' || name AS qualified_name
  FROM (SELECT unnest(regexp_extract_all(lower(html), 'href="/([^"/]+)"', 1)) AS name FROM pages)
)"""
_WRITING = """
writing AS (
  SELECT DISTINCT path FROM line
  WHERE contains(lower(line), 'the ') OR contains(lower(line), 'license')
)"""
_SOURCE = """
first_source AS (
  SELECT path, 'cat://test/f/' || min(name) AS source
  FROM line JOIN asset_file ON contains(lower(line), name) GROUP BY path
)"""
_TARGET = """
first_target AS (
  SELECT path, 'cat://test/t/' || min(name) AS target
  FROM line JOIN asset_table ON contains(lower(line), name || ' ') GROUP BY path
)"""
_MAP = """
lineage AS (
  SELECT path, source, target
  FROM writing LEFT JOIN first_source USING (path) LEFT JOIN first_target USING (path)
)"""
_RESOLVED = """
resolved AS (
  SELECT path, source, target, 'cat://test/notebooks' || path AS job,
         sha256('file|' || source) AS input_guid, sha256('table|' || target) AS output_guid
  FROM lineage JOIN asset_table ON target = asset_table.qualified_name
  WHERE source IS NOT NULL AND length(asset_table.name) <> 7
)"""
_CUSTOMER = """
customer_entity AS (
  SELECT 'customer' AS type_name, 'cat://test/c/' || c_custkey AS qualified_name, c_name AS name,
         sha256('customer|cat://test/c/' || c_custkey) AS guid, c_mktsegment AS segment, c_acctbal
  FROM customer
)"""
_NATION = """
nation_entity AS (
  SELECT 'nation' AS type_name, 'cat://test/n/' || n_nationkey AS qualified_name, n_name AS name FROM nation
)"""
_ODD = "['', ' ', ',', chr(34), chr(92), chr(92) || 'N', chr(9), chr(10), chr(39), 'a ', '#']"
_COLUMNS = f"""
columns AS (
  SELECT table_name, column_name,
         CASE WHEN column_name = 'n_name' THEN 'varchar(25)' ELSE CASE data_type WHEN 'VARCHAR' THEN 'string'
              WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
              ELSE lower(data_type) END END AS data_type
  FROM information_schema.columns
  WHERE table_name IN ({", ".join(f"'{t}'" for t in _TABLES)})
)"""
_SOLVENT_TABLE = """
solvent AS (
  SELECT 'cat://test/crm/' || c_name AS qualified_name, * FROM customer WHERE c_acctbal > 0
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_WANTED = "(SELECT o_orderkey, 'cat://test/c/' || o_custkey AS key FROM orders)"
_FOLDERS = """
doc AS (SELECT doc_id, '/Shared/' || lang AS lang, '/Shared/' || lang || '/' || source AS folder, source FROM documents),
listing AS (
  SELECT DISTINCT lang AS path, '/Shared' AS parent, 'DIRECTORY' AS object_type, '' AS object_id FROM doc
  UNION ALL
  SELECT DISTINCT folder, lang, CASE WHEN source = 'src7' THEN 'REPO' ELSE 'DIRECTORY' END, '' FROM doc
  UNION ALL
  SELECT folder || '/doc_' || doc_id, folder,
         CASE WHEN doc_id % 10 = 0 THEN 'LIBRARY' ELSE 'NOTEBOOK' END, doc_id::VARCHAR
  FROM doc
)"""

_WALK = """
walk AS (
  SELECT path, object_type, object_id, 1 AS depth FROM listing WHERE parent = '/Shared'
  UNION ALL
  SELECT l.path, l.object_type, l.object_id, w.depth + 1
  FROM walk w JOIN listing l ON l.parent = w.path WHERE w.object_type = 'DIRECTORY'
)"""

_LINEAGE = (_SCRIPT, _LINE, _ASSET_TABLE, _ASSET_FILE, _WRITING, _SOURCE, _TARGET, _MAP)

_SALES_GONE = """
sales_line AS (
  SELECT DISTINCT l_orderkey, 'cat://test/o/' || l_orderkey || '#' || l_linenumber || '/' || l_partkey AS key FROM lineitem
), gone_customer AS (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
), gone_order AS (
  SELECT o_orderkey, o_custkey, 'cat://test/o/' || o_orderkey AS key,
         CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 2 ELSE 1 END AS step
  FROM orders WHERE o_orderstatus = 'F' OR o_custkey IN (SELECT c_custkey FROM gone_customer)
), gone_line AS (
  SELECT key FROM sales_line WHERE l_orderkey IN (SELECT o_orderkey FROM gone_order)
)"""

ORACLE = {
    "inventory_tables": f"""
SELECT DISTINCT 'testdata' AS database, regexp_extract(filename, '([^/]+)\\.parquet$', 1) AS "tableName"
FROM read_blob('{SF_DIR}/*.parquet')""",
    "inventory_columns": f"""
SELECT 'testdata' AS "databaseName", table_name AS "tableName", column_name AS "colName",
       CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
            ELSE lower(data_type) END AS "dataType"
FROM information_schema.columns
WHERE table_name IN ({", ".join(f"'{t}'" for t in _TABLES)})""",
    "table_detail": f"""
SELECT regexp_extract(filename, '([^/]+)\\.parquet$', 1) AS "table",
       count(*) AS num_files, sum(size)::BIGINT AS size_bytes
FROM read_blob('{SF_DIR}/*.parquet') GROUP BY 1""",
    "catalog_tables": _with(
        _COLUMNS, select="""SELECT DISTINCT 'testdata' AS database, table_name AS "tableName" FROM columns"""
    ),
    "catalog_columns": _with(
        _COLUMNS,
        select="""
SELECT 'testdata' AS "databaseName", table_name AS "tableName", column_name AS "colName", data_type AS "dataType"
FROM columns""",
    ),
    "catalog_detail": f"""
SELECT 'testdata' AS database, regexp_extract(filename, '([^/]+)\\.parquet$', 1) AS "tableName", 'parquet' AS format,
       count(*) AS "numFiles", sum(size)::BIGINT AS "sizeInBytes", 0::INT AS partitions
FROM read_blob('{SF_DIR}/*.parquet') GROUP BY 2""",
    "catalog_entities": _with(
        _COLUMNS,
        select="""
SELECT DISTINCT 'table' AS type_name, 'cat://test/testdata/' || table_name AS qualified_name, table_name AS name,
       NULL::VARCHAR AS data_type, '1' AS num_files, NULL::VARCHAR AS parent
FROM columns
UNION ALL
SELECT 'column', 'cat://test/testdata/' || table_name || '#' || column_name, column_name, data_type, NULL,
       'cat://test/testdata/' || table_name
FROM columns""",
    ),
    "table_names_split": """
SELECT DISTINCT split_part(c_name, '#', 1) AS "databaseName", nullif(split_part(c_name, '#', 2), '') AS "tableName",
       c_mktsegment AS segment
FROM customer WHERE split_part(c_name, '#', 1) = 'Customer'""",
    "nonempty_filter": """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'A' THEN '' ELSE nullif(l_returnflag, 'R') END AS flag
  FROM lineitem
) WHERE flag <> ''""",
    "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "qualified_names": """
SELECT c_custkey, 'cat://test/' || n_name || '/' || c_name AS table_key,
       'cat://test/' || n_name || '/' || c_name || '#' || c_mktsegment AS column_key
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "asset_names": "SELECT page_id, lower(string_split(url, '/')[-1]) AS name FROM pages",
    "csv_assets": """
SELECT page_id, url AS qualified_name FROM pages WHERE instr(string_split(url, '/')[-1], 'page') > 1""",
    "script_lines": _with(_SCRIPT, _LINE, select="SELECT path, pos::INT AS pos, line FROM line"),
    "path_like": _with(_SCRIPT, select="SELECT path FROM script WHERE path LIKE '%src1%'"),
    "writing_scripts": _with(_SCRIPT, _LINE, _WRITING, select="SELECT path FROM writing"),
    "writing_counts": _with(
        _SCRIPT,
        _LINE,
        select="""
SELECT path, count(*) AS writing_lines FROM line
WHERE contains(lower(line), 'the ') OR contains(lower(line), 'license') GROUP BY path""",
    ),
    "json_listing": """
SELECT doc_id::VARCHAR AS object_id, 'NOTEBOOK' AS object_type,
       '/Shared/' || source || '/' || doc_id AS path, lang AS language
FROM documents
UNION ALL
SELECT 'd' || doc_id, 'DIRECTORY', '/Shared/' || source, NULL FROM documents""",
    "path_tree": "WITH RECURSIVE "
    + ",".join((_FOLDERS, _WALK))
    + """
SELECT path, object_type, object_id, depth FROM walk WHERE object_type IN ('DIRECTORY', 'NOTEBOOK')""",
    "path_tree_kinds": "WITH RECURSIVE "
    + ",".join((_FOLDERS, _WALK))
    + """
SELECT object_type, count(*) AS objects FROM walk WHERE object_type IN ('DIRECTORY', 'NOTEBOOK') GROUP BY object_type""",
    "lineage_scan": "WITH RECURSIVE "
    + ",".join((_FOLDERS, _WALK, *_LINEAGE))
    + """
SELECT path, source, target FROM lineage
WHERE path LIKE '%src1%' AND path IN (SELECT path FROM walk WHERE object_type = 'NOTEBOOK')""",
    "match_source": _with(_SCRIPT, _LINE, _ASSET_FILE, _SOURCE, select="SELECT path, source FROM first_source"),
    "match_target": _with(_SCRIPT, _LINE, _ASSET_TABLE, _TARGET, select="SELECT path, target FROM first_target"),
    "match_wildcards": _with(
        _SCRIPT,
        _LINE,
        _ASSET_TABLE,
        """
masked AS (SELECT name[1] || '_' || name[3:] AS name, qualified_name FROM asset_table),
ranked AS (
  SELECT path, qualified_name, row_number() OVER (PARTITION BY path ORDER BY name, qualified_name) AS n
  FROM line JOIN masked ON lower(line) LIKE '%' || name || ' %'
)""",
        select="SELECT path, qualified_name AS target FROM ranked WHERE n = 1",
    ),
    "match_counts": _with(
        _SCRIPT,
        _LINE,
        _ASSET_TABLE,
        select="""
SELECT path, name, count(*) AS matching_lines
FROM line JOIN asset_table ON contains(lower(line), name || ' ') GROUP BY path, name""",
    ),
    "lineage_map": _with(*_LINEAGE, select="SELECT path, source, target FROM lineage"),
    "lineage_all_matches": _with(
        _SCRIPT,
        _LINE,
        _ASSET_TABLE,
        _ASSET_FILE,
        _WRITING,
        select="""
SELECT DISTINCT path, 'source' AS kind, qualified_name
FROM line JOIN writing USING (path) JOIN asset_file ON contains(lower(line), name)
UNION ALL
SELECT DISTINCT path, 'target', qualified_name
FROM line JOIN writing USING (path) JOIN asset_table ON contains(lower(line), name || ' ')""",
    ),
    "lineage_evidence": _with(
        _SCRIPT,
        _LINE,
        _ASSET_TABLE,
        _ASSET_FILE,
        _WRITING,
        select="""
SELECT path, kind, qualified_name, min(pos)::INT AS line, arg_min(instr(lower(line), pattern), pos)::INT AS column, arg_min(line, pos) AS excerpt
FROM line JOIN writing USING (path) JOIN (
  SELECT 'source' AS kind, qualified_name, name AS pattern FROM asset_file
  UNION ALL
  SELECT 'target', qualified_name, name || ' ' FROM asset_table
) ON contains(lower(line), pattern)
GROUP BY path, kind, qualified_name""",
    ),
    "lineage_edges": _with(
        *_LINEAGE,
        _RESOLVED,
        select="""
SELECT source AS src, job AS dst, 'input' AS kind FROM resolved
UNION ALL
SELECT job, target, 'output' FROM resolved""",
    ),
    "lineage_jobs": _with(
        *_LINEAGE,
        _RESOLVED,
        select="""
SELECT sha256('job|' || job) AS guid, job AS qualified_name, string_split(path, '/')[-1] AS name,
       path AS notebook_path, input_guid, output_guid
FROM resolved""",
    ),
    "lineage_unresolved": _with(
        *_LINEAGE,
        select="""
SELECT path, source, target, true AS source_known, false AS target_known
FROM lineage JOIN asset_table ON target = qualified_name WHERE source IS NOT NULL AND length(name) = 7""",
    ),
    "lineage_files": "WITH RECURSIVE "
    + ",".join((_FOLDERS, _WALK, *_LINEAGE))
    + """
SELECT path, source, target FROM lineage
WHERE path LIKE '%src1%' AND path IN (SELECT path FROM walk WHERE object_type = 'NOTEBOOK')""",
    "csv_odd_roundtrip": _with(
        _SCRIPT,
        _LINE,
        select=f"""
SELECT path || '#' || pos AS path, {_ODD}[pos % 11 + 1] || line || {_ODD}[pos % 11 + 1] AS source,
       CASE pos % 3 WHEN 1 THEN {_ODD}[pos % 11 + 1] WHEN 2 THEN '' END AS target
FROM line""",
    ),
    "text_odd_roundtrip": f"""
SELECT CASE o_orderkey % 3 WHEN 1 THEN {_ODD}[o_orderkey % 11 + 1] WHEN 2 THEN '' END AS first,
       o_orderpriority || {_ODD}[o_orderkey % 11 + 1] AS second, o_orderkey::VARCHAR AS order_id
FROM orders""",
    "csv_roundtrip": _with(*_LINEAGE, select="SELECT path, source, target FROM lineage"),
    "text_roundtrip": _with(
        _CUSTOMER, select="SELECT guid AS term_guid, sha256(name) AS relationship_guid FROM customer_entity"
    ),
    "entity_build": _with(
        _SOLVENT_TABLE.replace(" WHERE c_acctbal > 0", ""),
        select="""
SELECT sha256('table|' || qualified_name) AS guid, 'table' AS type_name, qualified_name, c_name AS name,
       lower(c_mktsegment) AS format, '/data/' || c_name AS location,
       c_nationkey::VARCHAR AS num_files, c_custkey::VARCHAR AS size
FROM solvent""",
    ),
    "entity_columns": _with(
        _SOLVENT_TABLE,
        select="""
SELECT sha256('column|' || qualified_name || '#' || o_orderkey) AS guid,
       qualified_name || '#' || o_orderkey AS qualified_name, o_orderstatus AS data_type,
       qualified_name AS parent, sha256('table|' || qualified_name) AS parent_guid
FROM orders JOIN solvent ON o_custkey = c_custkey""",
    ),
    "entity_guid": "SELECT o_orderkey, sha256('order|cat://test/o/' || o_orderkey) AS guid FROM orders",
    "entity_json": """
SELECT json_object('name', c_name, 'segment', nullif(c_mktsegment, 'BUILDING'), 'nation', c_nationkey)::VARCHAR AS json
FROM customer""",
    "entity_search": _with(
        _CUSTOMER,
        select="SELECT guid, qualified_name, name FROM customer_entity WHERE contains(lower(name), 'er#00000001')",
    ),
    "entity_lookup": f"""
SELECT o_orderkey, key, c_name AS name, sha256('customer|' || key) AS guid
FROM {_WANTED} JOIN customer ON key = 'cat://test/c/' || c_custkey WHERE c_acctbal > 0""",
    "entity_misses": f"""
SELECT o_orderkey, key FROM {_WANTED}
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal > 0 AND key = 'cat://test/c/' || c_custkey)""",
    "entity_upsert": """
SELECT user_id, ts, event_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
WHERE n = 1""",
    "entity_store": _with(
        *_LINEAGE,
        _RESOLVED,
        select="""
SELECT 'customer' AS type_name, 'cat://test/c/' || c_custkey AS qualified_name,
       CASE WHEN c_acctbal < 0 THEN lower(c_name) ELSE c_name END AS name,
       CASE WHEN c_acctbal < 0 THEN 'IN DEBT' ELSE c_mktsegment END AS segment,
       NULL::VARCHAR AS input, NULL::VARCHAR AS output
FROM customer
UNION ALL
SELECT 'nation', 'cat://test/n/' || n_nationkey, n_name, NULL, NULL, NULL FROM nation
UNION ALL
SELECT 'table', 'cat://test/crm/' || c_name, c_name, NULL, NULL, NULL FROM customer
UNION ALL
SELECT 'job', job, string_split(path, '/')[-1], NULL, source, target FROM resolved""",
    ),
    "entity_delete": """
SELECT o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""",
    "entity_delete_by_search": _with(
        _CUSTOMER,
        _NATION,
        select="""
SELECT type_name, qualified_name FROM customer_entity WHERE NOT contains(qualified_name, 'cat://test/c/1')
UNION ALL
SELECT type_name, qualified_name FROM nation_entity""",
    ),
    "column_parent": """
WITH claim AS (
  SELECT o_orderkey, o_custkey AS parent FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey + 1 FROM orders WHERE o_orderkey % 7 = 0
)
SELECT o_orderkey, count(c_custkey) AS parents
FROM claim LEFT JOIN customer ON parent = c_custkey AND c_nationkey <> 3
GROUP BY o_orderkey HAVING count(c_custkey) <> 1""",
    "type_check": """
SELECT 'cat://test/j/' || c_custkey AS qualified_name, nullif(c_mktsegment, 'BUILDING') AS job_type,
       c_name AS notebook_path, CASE WHEN c_nationkey > 10 THEN 'daily' ELSE 'adHoc' END AS schedule,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'job_type' ELSE '' END AS missing, true AS known
FROM customer
UNION ALL
SELECT 'cat://test/n/' || n_nationkey, NULL, NULL, NULL, '', false FROM nation""",
    "type_replace": """
SELECT 'cat://test/j/' || c_custkey AS qualified_name, coalesce(nullif(c_mktsegment, 'BUILDING'), 'script') AS job_type,
       CASE WHEN c_nationkey > 10 THEN 'daily' END AS schedule,
       CASE WHEN c_nationkey > 10 THEN '' ELSE 'schedule' END AS missing
FROM customer""",
    "relation_broken": """
SELECT c_name AS name, n_name AS parent_type, true AS parent_container, false AS child_container
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_3' OR c_custkey = 1""",
    "type_inherited": """
WITH typed AS (
  SELECT 'cat://test/p/' || c_custkey AS qualified_name, 'Supplier#' || lpad((c_custkey % 150)::VARCHAR, 9, '0') AS type_name,
         CASE WHEN c_acctbal > 0 THEN c_custkey::VARCHAR END AS population
  FROM customer
)
SELECT qualified_name, type_name, population,
       CASE WHEN s_suppkey IS NULL THEN NULL WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'none' END AS comment,
       s_suppkey::VARCHAR AS rank, n_regionkey::VARCHAR AS region_code,
       CASE WHEN s_suppkey IS NOT NULL AND population IS NULL THEN 'population' ELSE '' END AS missing, s_suppkey IS NOT NULL AS known
FROM typed LEFT JOIN supplier ON s_name = type_name LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "entity_cascade": _with(
        _SALES_GONE,
        select="""
SELECT 'line' AS type_name, key AS qualified_name, 1 AS step, false AS ring FROM gone_line
UNION ALL
SELECT 'order', key, step, false FROM gone_order
UNION ALL
SELECT 'customer', 'cat://test/c/' || c_custkey, coalesce(max(step) + 1, 1), false
FROM gone_customer LEFT JOIN gone_order ON o_custkey = c_custkey GROUP BY c_custkey""",
    ),
    "entity_cascade_left": _with(
        _SALES_GONE,
        select="""
SELECT 'line' AS type_name, key AS qualified_name FROM sales_line WHERE key NOT IN (SELECT key FROM gone_line)
UNION ALL
SELECT 'order', 'cat://test/o/' || o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone_order)
UNION ALL
SELECT 'customer', 'cat://test/c/' || c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone_customer)""",
    ),
    "entity_index_search": _with(
        _CUSTOMER,
        select="""
SELECT guid, qualified_name, name, CASE WHEN lower(name) = 'er#00000001' THEN 0 WHEN starts_with(lower(name), 'er#00000001') THEN 1 ELSE 2 END AS score
FROM customer_entity WHERE contains(lower(name), 'er#00000001')""",
    ),
    "entity_index_page": _with(
        _CUSTOMER,
        select="""
SELECT guid, qualified_name, name, 3 AS score FROM customer_entity
WHERE contains(qualified_name, 'st/c/1') ORDER BY qualified_name, guid LIMIT 20 OFFSET 20""",
    ),
    "lineage_incremental": _with(*_LINEAGE, select="SELECT path, source, target FROM lineage"),
    "entity_store_partial": """
SELECT 'customer' AS type_name, 'cat://test/c/' || c_custkey AS qualified_name,
       CASE WHEN c_acctbal < 0 THEN lower(c_name) ELSE c_name END AS name,
       CASE WHEN c_acctbal < 0 THEN 'IN DEBT' ELSE c_mktsegment END AS segment
FROM customer
UNION ALL
SELECT 'nation', 'cat://test/n/' || n_nationkey, n_name, NULL FROM nation WHERE NOT starts_with(n_name, 'F')
UNION ALL
SELECT 'table', 'cat://test/crm/' || c_name, c_name, NULL FROM customer""",
    "json_listing_all": """
SELECT 'd' || doc_id AS object_id, source AS path, 'DIRECTORY' AS object_type, NULL::BIGINT AS created_at, NULL::BIGINT AS size, NULL::VARCHAR AS language
FROM documents
UNION ALL
SELECT doc_id::VARCHAR, source, NULL, doc_id, n_chars, lang FROM documents""",
    "csv_plain": _with(
        _SCRIPT,
        _LINE,
        select="""
SELECT path || '#' || pos AS path, 'C:\\new\\raw ' || line || '"' AS source,
       CASE WHEN pos % 3 > 0 THEN 'a' || chr(10) || 'b\\\\' || line END AS target
FROM line""",
    ),
    "relation_faults": """
SELECT o_orderkey, 0::BIGINT AS parents FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey <> 3)""",
    "type_delete": _with(_CUSTOMER, select="SELECT type_name, qualified_name FROM customer_entity"),
    "type_orphans": _with(_CUSTOMER, select="SELECT type_name, qualified_name FROM customer_entity"),
    "term_assign": _with(
        _CUSTOMER,
        """
pair AS (
  SELECT guid AS table_guid, sha256('glossary_term|' || r_name || '@Glossary') AS term_guid
  FROM customer_entity CROSS JOIN region
)""",
        select="SELECT table_guid, term_guid, sha256(table_guid || '|' || term_guid) AS relationship_guid FROM pair",
    ),
    "term_unassign": """
WITH held AS (
  SELECT c_custkey::VARCHAR AS table_guid, unnest(['nation-' || c_nationkey, c_mktsegment]) AS term_guid, c_acctbal
  FROM customer
)
SELECT table_guid, term_guid, 'rel-' || term_guid AS relationship_guid
FROM held WHERE NOT (term_guid = 'BUILDING' AND c_acctbal < 0)""",
}
