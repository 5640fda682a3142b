"""Control-plane and catalog inputs derived from the driver's tables.

The loader's own tables (control header/detail, groups, runs, errors, silver
target, column catalog, vector collection) are derived here from the TPC-H-ish
tables, so every job that reads them grows with the data.  ``plans/fixture_sql.py``
holds the same derivations as SQL text for the DuckDB check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sources.tables import Tables

# fixed test clock (``as_of``): no now() in compared columns
AS_OF = _dt.datetime(2024, 6, 1, 0, 0, 0)
OLD_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)


def as_of_col() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def grown(df: DataFrame) -> DataFrame:
    """``df`` with the hint to join by sorting.  Spark takes the bytes of compressed files for the size of what is derived from
    them, and would broadcast millions of control rows (hundreds of megabytes in the driver) of a file of a few megabytes."""
    return df.hint("merge")


def _sid(c: str) -> F.Column:
    return F.concat(F.lit("S"), F.col(c).cast("string"))


def control_header(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    return grown(t.customer.select(
        c.alias("id"),
        _sid("c_custkey").alias("sourceid"),
        F.col("c_name").alias("sourcename"),
        F.lit("PostgreSQL").alias("sourcetype"),
        F.when(c % 3 == 0, "Fact").otherwise("Dimension").alias("objecttype"),
        (F.col("c_nationkey") % 5 + 1).alias("sourcecallingseq"),
        F.when(c % 11 == 0, 0).otherwise(1).alias("isapplicable"),
        F.concat(F.lit("ENV"), F.col("c_nationkey").cast("string")).alias("envsourcecode"),
        F.col("c_mktsegment").alias("datasourcecode"),
        F.lit(1).alias("rawstorageflag"),
        F.when(c % 4 == 0, "Completed").otherwise("Started").alias("status"),
        F.lit(OLD_TS).cast("timestamp_ntz").alias("lastupdateddate"),
        F.when(c % 6 == 0, F.concat(F.lit("S"), (c - 1).cast("string"))).alias("depsource"),
        F.concat(F.lit("conn_"), F.col("c_nationkey").cast("string")).alias("connectionstr"),
        F.when(c % 2 == 0, ",").otherwise(";").alias("sourcedelimiter"),
        *[F.when(c % 10 == i, F.concat(F.lit(f"{name}_"), F.col("c_name"))).alias(name) for i, name in enumerate(API_COLUMNS)],
        F.concat(F.lit("raw-"), F.lower("c_mktsegment")).alias("adlscontainername"),
        F.concat(F.lit("/raw/"), F.col("c_mktsegment"), F.lit("/"), F.col("c_name")).alias("dldirstructure"),
    ))


API_COLUMNS = ("apiurl", "apimethod", "apiaccesstoken", "apiqueryparameters", "apirequestbody")
FLOWS = (("raw_to_bronze", 0), ("bronze_to_silver", 1), ("silver_to_gold", 2))


def control_detail(t: Tables) -> DataFrame:
    """Three flows per source: an explode of a three-element array, not a cross join."""
    c = F.col("c_custkey")
    flows = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f).alias("flow")) for f, k in FLOWS])
    base = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.inline(flows))
    target = F.concat(F.lit("d_"), F.lower("c_mktsegment"), F.lit("_"), c.cast("string"))
    return grown(base.select(
        (c * 3 + F.col("k")).alias("id"),
        _sid("c_custkey").alias("sourceid"),
        F.col("c_name").alias("sourcename"),
        F.lit("PostgreSQL").alias("sourcetype"),
        F.col("c_mktsegment").alias("sourcedescription"),
        F.col("flow").alias("dataflowflag"),
        F.lit("stg").alias("sourceschema"),
        F.concat(F.lit("stg_"), F.col("c_mktsegment")).alias("sourceobject"),
        F.lit("dwh").alias("targetname"),
        F.lit("dwh").alias("targetschemaname"),
        target.alias("targetobject"),
        F.concat(F.lit("usp_"), target).alias("targetprocedurename"),
        F.concat(F.lit("job_"), (c % 7).cast("string")).alias("jobname"),
        F.lit("Full").alias("loadtype"),
        F.when(c % 2 == F.col("k"), 1).otherwise(0).alias("isreadyforexecution"),
        F.when(c % 13 == 0, 0).otherwise(1).alias("isapplicable"),
        F.when(c % 5 == 0, "Weekly").otherwise("Daily").alias("loadfrequency"),
        F.when(c % 7 == 0, "Failed").otherwise("Completed").alias("flowstatus"),
        F.when(c % 9 == 0, F.lit(None)).otherwise(c % 17).alias("latestbatchid"),
        F.lit(None).cast("timestamp_ntz").alias("etllastrundate"),
        F.when(c % 3 == 0, F.concat(F.lit("SELECT * FROM stg_"), F.col("c_mktsegment"))).alias("sourcequery"),
        F.when(c % 4 == 0, 7).otherwise(1).alias("intervaldays"),
    ))


def source_groups(t: Tables, with_null: bool = False) -> DataFrame:
    """Group membership; only rows of schema 'dwh' count for the group filters."""
    c = F.col("c_custkey")
    g = t.customer.select(
        _sid("c_custkey").alias("sourceid"),
        F.when(c % 3 == 0, "stg").otherwise("dwh").alias("schemaname"),
        F.col("c_mktsegment").alias("sourcegroup"),
        F.lit(1).alias("isapplicable"),
        F.lit("Completed").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("lastrundatetime"),
        F.lit(None).cast("timestamp_ntz").alias("loadstartdatetime"),
        F.lit(None).cast("timestamp_ntz").alias("loadenddatetime"),
    )
    if with_null:
        extra = g.sparkSession.createDataFrame(
            [(None, "dwh", "BUILDING", 1, "Completed", None, None, None)], g.schema)
        g = g.unionByName(extra)
    return grown(g)


ORDERS_KEYS = ["o_orderkey"]
ORDERS_META = {"etljobname": "job_orders", "envsourcecd": "ENV1", "datasourcecd": "BUILDING"}


def bronze_orders(t: Tables) -> DataFrame:
    return t.orders


def silver_before(t: Tables) -> DataFrame:
    """Silver target before the load: the 'F' orders at a doubled price (to be
    updated) plus silver-only rows with negated keys (must stay untouched)."""
    o = t.orders
    old = F.lit(OLD_TS).cast("timestamp_ntz")
    audit = [F.lit(1).alias("etlactiveind"), F.lit("old").alias("etljobname"),
             F.lit("E0").alias("envsourcecd"), F.lit("D0").alias("datasourcecd"),
             old.alias("etlcreateddatetime"), old.alias("etlupdateddatetime")]
    matched = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("orderskey"), "o_orderkey", "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderdate", "o_orderpriority", *audit)
    only = o.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")).select(
        (-F.col("o_orderkey") - 1).alias("orderskey"), (-F.col("o_orderkey") - 1).alias("o_orderkey"),
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", *audit)
    return matched.unionByName(only)


def source_lookup(t: Tables) -> DataFrame:
    """One catalog row per part: types cycle over mapped and unmapped names."""
    k = F.col("p_partkey")
    dtype = (F.when(k % 6 == 0, "int").when(k % 6 == 1, "integer").when(k % 6 == 2, "varchar")
             .when(k % 6 == 3, "numeric").when(k % 6 == 4, "timestamp").otherwise("no_such_type"))
    return t.part.select(
        k.alias("source_id"),
        F.when(k % 2 == 0, "SQL Server").otherwise("PostgreSQL").alias("source_type"),
        F.lit("stg").alias("source_schema"),
        F.concat(F.lit("t_"), F.lower(F.regexp_replace("p_brand", "#", ""))).alias("source_table"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(k).alias("column_id"),
        F.concat(F.lit("c_"), k.cast("string")).alias("column_name"),
        dtype.alias("source_data_type"),
        F.when(k % 4 == 0, -1).otherwise(F.col("p_size")).alias("length"),
        F.when(k % 6 == 3, F.lit(18)).alias("precisions"),
        F.when(k % 6 == 3, F.lit(2)).alias("scale"),
        (k % 3 != 0).alias("nullable"),
        F.when(k % 8 == 0, "PRIMARY KEY").alias("key_constraint"),
        F.concat(F.lit("d_"), F.lower(F.regexp_replace("p_brand", "#", "")), F.lit("_silver")).alias("target_table"),
    )


def column_catalog(t: Tables) -> DataFrame:
    """information_schema.columns-like catalog of many source tables.

    Tables are groups of 16 consecutive parts (their count grows with the data,
    columns per table stay bounded like in a real database)."""
    k = F.col("p_partkey")
    dtype = (F.when(k % 7 == 0, "integer").when(k % 7 == 1, "bigint").when(k % 7 == 2, "character varying")
             .when(k % 7 == 3, "numeric").when(k % 7 == 4, "timestamp without time zone")
             .when(k % 7 == 5, "text").otherwise("boolean"))
    return t.part.select(
        F.lit("stg").alias("table_schema"),
        F.concat(F.lit("tbl_"), F.floor(k / 16).cast("string")).alias("table_name"),
        F.concat(F.regexp_replace(F.lower("p_name"), " ", "_"), F.lit("_"), k.cast("string")).alias("column_name"),
        ((k % 16) + 1).cast("int").alias("ordinal_position"),
        dtype.alias("data_type"),
        F.when(k % 7 == 2, F.col("p_size") * 10).alias("character_maximum_length"),
        F.when(k % 7 == 3, F.lit(12)).when(k % 7 == 0, F.lit(32)).when(k % 7 == 1, F.lit(64)).alias("numeric_precision"),
        F.when(k % 7 == 3, F.lit(3)).when(k % 7 <= 1, F.lit(0)).alias("numeric_scale"),
        F.when(k % 5 == 0, "NO").otherwise("YES").alias("is_nullable"),
        F.when(k % 16 == 0, "YES").otherwise("NO").alias("is_identity"),
    )


def constraint_usage(t: Tables) -> DataFrame:
    """Declared key constraints of the catalog tables (S5), one row per
    (column, constraint): the first column is the primary key, every 5th column
    is UNIQUE and every 3rd has a FOREIGN KEY (never a business key); column 15
    holds two constraints."""
    cat = column_catalog(t)
    k = F.col("ordinal_position")
    kinds = F.filter(F.array(F.when(k == 1, "PRIMARY KEY"), F.when(k % 5 == 0, "UNIQUE"),
                             F.when(k % 3 == 0, "FOREIGN KEY")), lambda x: x.isNotNull())
    out = cat.select("table_schema", "table_name", "column_name", F.explode(kinds).alias("constraint_type"))
    return out.select("table_schema", "table_name", "column_name", "constraint_type",
                      F.concat(F.col("table_name"), F.lit("_"), F.lower(F.regexp_replace("constraint_type", " ", "")),
                               F.lit("_"), F.col("column_name")).alias("constraint_name"))


def table_constraints(t: Tables) -> DataFrame:
    """information_schema.table_constraints of the catalog tables."""
    return constraint_usage(t).select("constraint_name", "table_schema", "table_name", "constraint_type")


def key_column_usage(t: Tables) -> DataFrame:
    """information_schema.key_column_usage of the catalog tables."""
    return constraint_usage(t).select("constraint_name", "table_schema", "table_name", "column_name")


def vector_collection(t: Tables) -> DataFrame:
    """Search collection: id, table (label), column, document, vector."""
    e = t.embeddings
    return e.select(
        F.concat(F.lit("row_"), F.col("vec_id").cast("string")).alias("id"),
        F.col("vec_id"),
        F.concat(F.lit("table_"), F.col("label").cast("string")).alias("source_tablename"),
        F.concat(F.lit("col_"), F.col("vec_id").cast("string")).alias("source_columnname"),
        F.col("embedding"),
    )


def label_queries(t: Tables) -> DataFrame:
    """Search queries: one per label, the mean vector of that label's embeddings.

    The number of labels is checked before the queries are broadcast."""
    from .functions.vectors import mean_vector
    return mean_vector(t.embeddings, "label", "embedding").select(
        F.col("label").alias("query_id"), F.col("embedding").alias("query_vec"))


def document_input(t: Tables) -> DataFrame:
    """Catalog rows that the document builder turns into text (V1)."""
    k = F.col("p_partkey")
    return t.part.select(
        k.alias("p_partkey"),
        F.col("p_brand").alias("source_tablename"),
        F.col("p_name").alias("source_columnname"),
        F.col("p_type").alias("datatype"),
        F.when(k % 2 == 1, F.lit(None)).otherwise(F.concat(F.lit("size "), F.col("p_size").cast("string"))).alias("description"),
    )


def run_requests(t: Tables) -> DataFrame:
    """One run request per order, for the source's flow (order key parity) and
    the target of that flow's control-detail row; finished counts attached."""
    o = t.orders.select(
        _sid("o_custkey").alias("sourceid"),
        F.when(F.col("o_orderkey") % 7 == 0, "silver_to_gold").when(F.col("o_orderkey") % 2 == 0, "raw_to_bronze")
        .otherwise("bronze_to_silver").alias("dataflowflag"),
        F.col("o_orderdate").alias("loadstarttime"),
        F.col("o_orderkey").alias("runid"),
        F.floor(F.col("o_totalprice")).cast("long").alias("srccnt"),
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("etlbatchid"),
    )
    o = o.withColumn("inscnt", F.floor(F.col("srccnt") / 2).cast("long")).withColumn(
        "updcnt", F.col("srccnt") - F.floor(F.col("srccnt") / 2).cast("long"))
    d = control_detail(t).select(F.col("sourceid").alias("_d_s"), F.col("dataflowflag").alias("_d_f"),
                                 "targetobject")
    return o.join(d, (F.col("sourceid") == F.col("_d_s")) & (F.col("dataflowflag") == F.col("_d_f")),
                  "inner").drop("_d_s", "_d_f")


def main_lookup_before(t: Tables) -> DataFrame:
    """Lookup rows already captured: the numeric columns of every catalog table,
    with stale type information."""
    c = column_catalog(t).where(F.col("data_type").isin("integer", "bigint", "numeric"))
    return c.select(
        F.lit("stg").alias("sourcename"), F.col("table_name").alias("sourceid"),
        F.col("table_name").alias("source_tablename"),
        F.concat(F.lit("stg_"), F.col("table_name")).alias("bronzedwh_tablename"),
        F.concat(F.lit("d_"), F.col("table_name")).alias("silverdwh_tablename"),
        F.col("ordinal_position").alias("column_id"), F.col("column_name").alias("source_columnname"),
        F.col("column_name").alias("silverdwh_columnname"), F.lit("text").alias("datatype"),
        F.lit(None).cast("int").alias("length"), F.lit(None).cast("int").alias("precisions"),
        F.lit(None).cast("int").alias("scale"), F.lit(None).cast("boolean").alias("nullable"),
        F.lit(None).cast("string").alias("keyconstraint"),
        F.lit(None).cast("string").alias("silver_default_value"),
        F.lit(OLD_TS).cast("timestamp_ntz").alias("createdatetime"),
        F.lit(None).cast("string").alias("document"))


def catalog_tables(t: Tables) -> DataFrame:
    """information_schema.tables of the catalog."""
    return column_catalog(t).select("table_schema", "table_name").distinct()


# Parameter of the gold-schema test: source type -> column-store type.
GOLD_TYPE_MAP = [("integer", "Int32"), ("bigint", "Int64"), ("character varying", "String"),
                 ("text", "String"), ("numeric", "Decimal(18, 2)"),
                 ("timestamp without time zone", "DateTime"), ("boolean", "Bool")]


def gold_type_map(spark) -> DataFrame:
    return spark.createDataFrame(GOLD_TYPE_MAP, "sourcedatatypes string, targetdatatypes string")


def existing_tables(t: Tables) -> DataFrame:
    """Silver tables that already exist: those of customers with a positive balance."""
    return t.customer.where(F.col("c_acctbal") > 0).select(
        F.lit("dwh").alias("table_schema"),
        F.concat(F.lit("d_"), F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey").cast("string")).alias("table_name"))


def fuzzy_targets(t: Tables) -> DataFrame:
    """Target-side column names of the fuzzy match: each catalog table's columns
    under 'd_<table>', renamed by a rule on the position (kept, underscores
    dropped, last two characters dropped, or prefixed)."""
    c = column_catalog(t)
    n = F.col("column_name")
    k = F.col("ordinal_position") % 4
    name = (F.when(k == 0, n).when(k == 1, F.regexp_replace(n, "_", ""))
            .when(k == 2, F.expr("substring(column_name, 1, length(column_name) - 2)"))
            .otherwise(F.concat(F.lit("x"), n)))
    return c.select(F.concat(F.lit("d_"), F.col("table_name")).alias("table_name"), name.alias("column_name"))
