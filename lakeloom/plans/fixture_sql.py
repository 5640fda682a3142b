"""The fixture derivations of ``lakeloom.fixtures`` as SQL text (DuckDB dialect).

Used only by the oracle queries: an independent second implementation of the
same inputs, so a mismatch shows up in the correctness check.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-06-01 00:00:00'"
OLD_SQL = "TIMESTAMP '2024-01-01 00:00:00'"

FIXTURE_SQL = {
    "control_header": f"""
SELECT c_custkey AS id, 'S' || CAST(c_custkey AS VARCHAR) AS sourceid, c_name AS sourcename,
       'PostgreSQL' AS sourcetype,
       CASE WHEN c_custkey % 3 = 0 THEN 'Fact' ELSE 'Dimension' END AS objecttype,
       c_nationkey % 5 + 1 AS sourcecallingseq,
       CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1 END AS isapplicable,
       'ENV' || CAST(c_nationkey AS VARCHAR) AS envsourcecode, c_mktsegment AS datasourcecode,
       1 AS rawstorageflag,
       CASE WHEN c_custkey % 4 = 0 THEN 'Completed' ELSE 'Started' END AS status,
       {OLD_SQL} AS lastupdateddate,
       CASE WHEN c_custkey % 6 = 0 THEN 'S' || CAST(c_custkey - 1 AS VARCHAR) END AS depsource,
       'conn_' || CAST(c_nationkey AS VARCHAR) AS connectionstr,
       CASE WHEN c_custkey % 2 = 0 THEN ',' ELSE ';' END AS sourcedelimiter,
       CASE WHEN c_custkey % 10 = 0 THEN 'apiurl_' || c_name END AS apiurl,
       CASE WHEN c_custkey % 10 = 1 THEN 'apimethod_' || c_name END AS apimethod,
       CASE WHEN c_custkey % 10 = 2 THEN 'apiaccesstoken_' || c_name END AS apiaccesstoken,
       CASE WHEN c_custkey % 10 = 3 THEN 'apiqueryparameters_' || c_name END AS apiqueryparameters,
       CASE WHEN c_custkey % 10 = 4 THEN 'apirequestbody_' || c_name END AS apirequestbody,
       'raw-' || lower(c_mktsegment) AS adlscontainername,
       '/raw/' || c_mktsegment || '/' || c_name AS dldirstructure
FROM customer""",
    "control_detail": """
SELECT c_custkey * 3 + f.k AS id, 'S' || CAST(c_custkey AS VARCHAR) AS sourceid, c_name AS sourcename,
       'PostgreSQL' AS sourcetype, c_mktsegment AS sourcedescription, f.flow AS dataflowflag,
       'stg' AS sourceschema, 'stg_' || c_mktsegment AS sourceobject, 'dwh' AS targetname,
       'dwh' AS targetschemaname,
       'd_' || lower(c_mktsegment) || '_' || CAST(c_custkey AS VARCHAR) AS targetobject,
       'usp_d_' || lower(c_mktsegment) || '_' || CAST(c_custkey AS VARCHAR) AS targetprocedurename,
       'job_' || CAST(c_custkey % 7 AS VARCHAR) AS jobname, 'Full' AS loadtype,
       CASE WHEN c_custkey % 2 = f.k THEN 1 ELSE 0 END AS isreadyforexecution,
       CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 1 END AS isapplicable,
       CASE WHEN c_custkey % 5 = 0 THEN 'Weekly' ELSE 'Daily' END AS loadfrequency,
       CASE WHEN c_custkey % 7 = 0 THEN 'Failed' ELSE 'Completed' END AS flowstatus,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 17 END AS latestbatchid,
       CAST(NULL AS TIMESTAMP) AS etllastrundate,
       CASE WHEN c_custkey % 3 = 0 THEN 'SELECT * FROM stg_' || c_mktsegment END AS sourcequery,
       CASE WHEN c_custkey % 4 = 0 THEN 7 ELSE 1 END AS intervaldays
FROM customer CROSS JOIN (VALUES (0, 'raw_to_bronze'), (1, 'bronze_to_silver'),
                            (2, 'silver_to_gold')) AS f(k, flow)""",
    "source_groups": """
SELECT 'S' || CAST(c_custkey AS VARCHAR) AS sourceid,
       CASE WHEN c_custkey % 3 = 0 THEN 'stg' ELSE 'dwh' END AS schemaname,
       c_mktsegment AS sourcegroup, 1 AS isapplicable, 'Completed' AS status,
       CAST(NULL AS TIMESTAMP) AS lastrundatetime, CAST(NULL AS TIMESTAMP) AS loadstartdatetime,
       CAST(NULL AS TIMESTAMP) AS loadenddatetime
FROM customer""",
    "silver_before": f"""
SELECT o_orderkey AS orderskey, o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
       o_orderdate, o_orderpriority, 1 AS etlactiveind, 'old' AS etljobname, 'E0' AS envsourcecd,
       'D0' AS datasourcecd, {OLD_SQL} AS etlcreateddatetime, {OLD_SQL} AS etlupdateddatetime
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT -o_orderkey - 1, -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, 1, 'old', 'E0', 'D0', {OLD_SQL}, {OLD_SQL}
FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'""",
    "source_lookup": """
SELECT p_partkey AS source_id,
       CASE WHEN p_partkey % 2 = 0 THEN 'SQL Server' ELSE 'PostgreSQL' END AS source_type,
       'stg' AS source_schema,
       't_' || lower(replace(p_brand, '#', '')) AS source_table,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey END AS column_id,
       'c_' || CAST(p_partkey AS VARCHAR) AS column_name,
       CASE p_partkey % 6 WHEN 0 THEN 'int' WHEN 1 THEN 'integer' WHEN 2 THEN 'varchar'
            WHEN 3 THEN 'numeric' WHEN 4 THEN 'timestamp' ELSE 'no_such_type' END AS source_data_type,
       CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE p_size END AS length,
       CASE WHEN p_partkey % 6 = 3 THEN 18 END AS precisions,
       CASE WHEN p_partkey % 6 = 3 THEN 2 END AS scale,
       p_partkey % 3 <> 0 AS nullable,
       CASE WHEN p_partkey % 8 = 0 THEN 'PRIMARY KEY' END AS key_constraint,
       'd_' || lower(replace(p_brand, '#', '')) || '_silver' AS target_table
FROM part""",
    "column_catalog": """
SELECT 'stg' AS table_schema,
       'tbl_' || CAST(CAST(floor(p_partkey / 16) AS BIGINT) AS VARCHAR) AS table_name,
       replace(lower(p_name), ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) AS column_name,
       CAST(p_partkey % 16 + 1 AS INTEGER) AS ordinal_position,
       CASE p_partkey % 7 WHEN 0 THEN 'integer' WHEN 1 THEN 'bigint' WHEN 2 THEN 'character varying'
            WHEN 3 THEN 'numeric' WHEN 4 THEN 'timestamp without time zone' WHEN 5 THEN 'text'
            ELSE 'boolean' END AS data_type,
       CASE WHEN p_partkey % 7 = 2 THEN p_size * 10 END AS character_maximum_length,
       CASE WHEN p_partkey % 7 = 3 THEN 12 WHEN p_partkey % 7 = 0 THEN 32
            WHEN p_partkey % 7 = 1 THEN 64 END AS numeric_precision,
       CASE WHEN p_partkey % 7 = 3 THEN 3 WHEN p_partkey % 7 <= 1 THEN 0 END AS numeric_scale,
       CASE WHEN p_partkey % 5 = 0 THEN 'NO' ELSE 'YES' END AS is_nullable,
       CASE WHEN p_partkey % 16 = 0 THEN 'YES' ELSE 'NO' END AS is_identity
FROM part""",
    "constraint_usage": """
SELECT table_schema, table_name, column_name, constraint_type,
       table_name || '_' || lower(replace(constraint_type, ' ', '')) || '_' || column_name AS constraint_name
FROM (SELECT table_schema, table_name, column_name, 'PRIMARY KEY' AS constraint_type
      FROM column_catalog WHERE ordinal_position = 1
      UNION ALL
      SELECT table_schema, table_name, column_name, 'UNIQUE' FROM column_catalog WHERE ordinal_position % 5 = 0
      UNION ALL
      SELECT table_schema, table_name, column_name, 'FOREIGN KEY' FROM column_catalog
      WHERE ordinal_position % 3 = 0) x""",
    "table_constraints": """
SELECT constraint_name, table_schema, table_name, constraint_type FROM constraint_usage""",
    "key_column_usage": """
SELECT constraint_name, table_schema, table_name, column_name FROM constraint_usage""",
    "vector_collection": """
SELECT 'row_' || CAST(vec_id AS VARCHAR) AS id, vec_id,
       'table_' || CAST(label AS VARCHAR) AS source_tablename,
       'col_' || CAST(vec_id AS VARCHAR) AS source_columnname, embedding
FROM embeddings""",
    "label_queries": """
SELECT label AS query_id, list(x ORDER BY pos) AS query_vec
FROM (SELECT label, pos, round(avg(CAST(x AS DOUBLE)), 6) AS x
      FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) e
      GROUP BY label, pos) m
GROUP BY label""",
    "document_input": """
SELECT p_partkey, p_brand AS source_tablename, p_name AS source_columnname, p_type AS datatype,
       CASE WHEN p_partkey % 2 = 1 THEN NULL ELSE 'size ' || CAST(p_size AS VARCHAR) END AS description
FROM part""",
}

FIXTURE_SQL["run_requests"] = """
SELECT r.*, d.targetobject
FROM (SELECT 'S' || CAST(o_custkey AS VARCHAR) AS sourceid,
             CASE WHEN o_orderkey % 7 = 0 THEN 'silver_to_gold' WHEN o_orderkey % 2 = 0 THEN 'raw_to_bronze'
                  ELSE 'bronze_to_silver' END AS dataflowflag,
             o_orderdate AS loadstarttime, o_orderkey AS runid,
             CAST(floor(o_totalprice) AS BIGINT) AS srccnt,
             'B' || CAST(o_orderkey AS VARCHAR) AS etlbatchid,
             CAST(floor(CAST(floor(o_totalprice) AS BIGINT) / 2) AS BIGINT) AS inscnt,
             CAST(floor(o_totalprice) AS BIGINT)
               - CAST(floor(CAST(floor(o_totalprice) AS BIGINT) / 2) AS BIGINT) AS updcnt
      FROM orders) r
JOIN control_detail d ON r.sourceid = d.sourceid AND r.dataflowflag = d.dataflowflag"""

FIXTURE_SQL["main_lookup_before"] = f"""
SELECT 'stg' AS sourcename, table_name AS sourceid, table_name AS source_tablename,
       'stg_' || table_name AS bronzedwh_tablename, 'd_' || table_name AS silverdwh_tablename,
       ordinal_position AS column_id, column_name AS source_columnname, column_name AS silverdwh_columnname,
       'text' AS datatype, CAST(NULL AS INTEGER) AS length, CAST(NULL AS INTEGER) AS precisions,
       CAST(NULL AS INTEGER) AS scale, CAST(NULL AS BOOLEAN) AS nullable, CAST(NULL AS VARCHAR) AS keyconstraint,
       CAST(NULL AS VARCHAR) AS silver_default_value, {OLD_SQL} AS createdatetime, CAST(NULL AS VARCHAR) AS document
FROM column_catalog WHERE data_type IN ('integer', 'bigint', 'numeric')"""

FIXTURE_SQL["catalog_tables"] = "SELECT DISTINCT table_schema, table_name FROM column_catalog"

FIXTURE_SQL["existing_tables"] = """
SELECT 'dwh' AS table_schema, 'd_' || lower(c_mktsegment) || '_' || CAST(c_custkey AS VARCHAR) AS table_name
FROM customer WHERE c_acctbal > 0"""

# which fixtures another fixture reads
_DEPENDS = {"constraint_usage": ["column_catalog"], "run_requests": ["control_detail"],
            "table_constraints": ["constraint_usage"], "key_column_usage": ["constraint_usage"],
            "main_lookup_before": ["column_catalog"], "catalog_tables": ["column_catalog"]}


def with_fixtures(names: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs of the named fixtures (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
