"""Schema derivation from the column catalog.

Every table's DDL is one aggregation over its catalog rows: column definitions
are built as column expressions, collected per table as (position, text)
structs, sorted and joined.  Columns per table are bounded by the database's
own limit (1,600 in PostgreSQL), so a per-table list is bounded; the number of
tables is what grows, and it is spread over tasks by the group-by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import AUDIT_COLUMNS, legacy_key_name_col, surrogate_key_name_col
from ..functions.typemap import LEGACY_TYPE_MAP
from ..session import broadcast_if_small

# The identity clause of a generated surrogate key, the legacy
# identity clause per dialect, the legacy audit columns, and the audit part of
# the generated UPDATE SET list.
IDENTITY_PG = ("BIGINT GENERATED ALWAYS AS IDENTITY (INCREMENT BY 1 MINVALUE 1 "
               "MAXVALUE 9223372036854775807 START 1 CACHE 1 NO CYCLE) NOT NULL")
IDENTITY_LEGACY = {"mysql": "AUTO_INCREMENT NOT NULL", "postgresql": IDENTITY_PG.replace("BIGINT ", ""),
                   "mssql": "IDENTITY(1,1) NOT NULL"}
LEGACY_AUDIT = [("etlactiveind", "INT"), ("etljobname", "VARCHAR(200)"), ("envsourcecd", "VARCHAR(50)"),
                ("datasourcecd", "VARCHAR(50)"), ("etlcreateddatetime", "TIMESTAMP"),
                ("etlupdateddatetime", "TIMESTAMP")]
UPDATE_AUDIT_SET = (", etlactiveind = 1, etljobname = p_etljobname, envsourcecd = p_envsourcecd, "
                    "datasourcecd = p_datasourcecd, etlupdateddatetime = NOW()")


def _joined(pos: Column, text: Column, sep: str) -> Column:
    """Aggregate: texts ordered by position, joined by ``sep``."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos.alias("p"), text.alias("t")))),
                                    lambda s: s["t"]), sep)


# ------------------------------------------------------------------- silver

def silver_column_defs(lookup: DataFrame, untyped: str = "drop") -> DataFrame:
    """One definition per lookup row (D1 body, P14, F1, F8): char/varchar get a
    length (default 255), decimal/numeric precision and scale (default 18, 2),
    NOT NULL when not nullable; ``is_key`` for PRIMARY/UNIQUE constraints.

    ``untyped``: a column without a type is left out ('drop', as the original does), is
    'text', or makes the query fail ('refuse')."""
    name = F.coalesce(F.concat("silverdwh_tablename", F.lit("."), "silverdwh_columnname"), F.lit("?"))
    missing = {"drop": F.lit(None), "text": F.lit("text"), "refuse": F.raise_error(F.concat(F.lit("no type: "), name))}[untyped].cast("string")
    dt = F.coalesce(F.col("datatype"), missing)
    size = (F.when(dt.ilike("char%") | dt.ilike("varchar"),
                   F.concat(F.lit("("), F.coalesce(F.col("length").cast("string"), F.lit("255")), F.lit(")")))
            .when(dt.ilike("decimal") | dt.ilike("numeric"),
                  F.concat(F.lit("("), F.coalesce(F.col("precisions").cast("string"), F.lit("18")), F.lit(", "),
                           F.coalesce(F.col("scale").cast("string"), F.lit("2")), F.lit(")")))
            .otherwise(F.lit("")))
    notnull = F.when(F.col("nullable") == F.lit(False), F.lit(" NOT NULL")).otherwise(F.lit(""))
    kc = F.upper(F.col("keyconstraint"))
    is_key = F.coalesce(kc.ilike("%PRIMARY%") | kc.ilike("%UNIQUE%"), F.lit(False))
    return lookup.select("silverdwh_tablename", "silverdwh_columnname", "column_id",
                         F.concat(F.col("silverdwh_columnname"), F.lit(" "), dt, size, notnull).alias("column_def"),
                         is_key.alias("is_key"))


def silver_ddl(lookup: DataFrame, schema: str | Column = "dwh", untyped: str = "drop") -> DataFrame:
    """CREATE TABLE text per silver table (D1, A14, F5, F6): surrogate identity
    key, the columns in (column_id, name) order, six audit columns, PRIMARY KEY
    on the surrogate, UNIQUE on the business-key columns when there are any."""
    defs = silver_column_defs(lookup, untyped)
    pos = F.struct(F.col("column_id"), F.col("silverdwh_columnname"))
    g = defs.groupBy("silverdwh_tablename").agg(
        _joined(pos, F.col("column_def"), ", ").alias("_cols"),
        _joined(pos, F.when(F.col("is_key"), F.col("silverdwh_columnname")), ", ").alias("_keys"),
        F.max(F.col("is_key").cast("int")).alias("_has_key"))
    key = surrogate_key_name_col(F.col("silverdwh_tablename"))
    schema_col = schema if isinstance(schema, Column) else F.lit(schema)
    audit = ", ".join(f"{n} {t}" for n, t in AUDIT_COLUMNS)
    ddl = F.concat(F.lit("CREATE TABLE "), schema_col, F.lit("."), F.col("silverdwh_tablename"), F.lit(" ("),
                   key, F.lit(" " + IDENTITY_PG + ", "), F.col("_cols"), F.lit(", " + audit),
                   F.lit(", PRIMARY KEY ("), key, F.lit(")"),
                   F.when(F.col("_has_key") == 1, F.concat(F.lit(", UNIQUE ("), F.col("_keys"), F.lit(")")))
                   .otherwise(F.lit("")), F.lit(");"))
    return g.select("silverdwh_tablename", key.alias("surrogate_key"), ddl.alias("ddl"))


_SQL_TO_SPARK = [
    ("smallint", T.ShortType()), ("integer", T.IntegerType()), ("int", T.IntegerType()),
    ("serial", T.IntegerType()), ("bigint", T.LongType()), ("bigserial", T.LongType()),
    ("real", T.FloatType()), ("double precision", T.DoubleType()), ("boolean", T.BooleanType()),
    ("date", T.DateType()), ("timestamp", T.TimestampNTZType()),
    ("timestamp without time zone", T.TimestampNTZType()),
    ("timestamp with time zone", T.TimestampType()), ("bytea", T.BinaryType()),
]


def spark_type(datatype: str | None, precision=None, scale=None) -> T.DataType:
    """Spark type of a catalog data type; text by default."""
    t = (datatype or "text").lower().strip()
    if t.startswith("numeric") or t.startswith("decimal"):
        if "(" in t:
            p, s = t[t.index("(") + 1:t.index(")")].split(",")
            return T.DecimalType(int(p), int(s))
        return T.DecimalType(int(precision or 18), int(scale if scale is not None else 2))
    if t == "array":
        return T.ArrayType(T.StringType())
    if t == "interval":
        return T.DayTimeIntervalType()
    for name, st in _SQL_TO_SPARK:
        if t == name:
            return st
    return T.StringType()


def silver_schema(table_name: str, rows: list) -> T.StructType:
    """StructType of one silver table from its lookup rows (bounded: one table)."""
    fields = [T.StructField(f"{table_name.split('_')[1] if '_' in table_name else ''}key", T.LongType(), False)]
    for r in sorted(rows, key=lambda r: (r["column_id"] is None, r["column_id"], r["silverdwh_columnname"])):
        fields.append(T.StructField(r["silverdwh_columnname"],
                                    spark_type(r["datatype"], r["precisions"], r["scale"]),
                                    r["nullable"] is not False))
    fields += [T.StructField("etlactiveind", T.IntegerType()), T.StructField("etljobname", T.StringType()),
               T.StructField("envsourcecd", T.StringType()), T.StructField("datasourcecd", T.StringType()),
               T.StructField("etlcreateddatetime", T.TimestampNTZType()),
               T.StructField("etlupdateddatetime", T.TimestampNTZType())]
    return T.StructType(fields)


# ---------------------------------------------------------------- merge

def merge_clauses(columns: DataFrame, business_keys: DataFrame) -> DataFrame:
    """Per source table the upsert clauses the load procedure was generated
    from (D4): match condition, insert test, insert column and value lists and
    the update SET list.  Keys are PRIMARY KEY / UNIQUE columns only; a table
    with none gets '1=1' (which ``upsert`` refuses to run)."""
    k = business_keys.select(F.col("table_schema").alias("_k_s"), F.col("table_name").alias("_k_t"),
                             F.col("column_name").alias("_k_c"), F.lit(True).alias("_is_key"))
    j = columns.join(k, (F.col("table_schema") == F.col("_k_s")) & (F.col("table_name") == F.col("_k_t"))
                     & (F.col("column_name") == F.col("_k_c")), "left")
    c = F.col("column_name")
    pos = F.col("ordinal_position")
    key = F.coalesce(F.col("_is_key"), F.lit(False))
    q = lambda prefix: F.concat(F.lit(prefix + '"'), c, F.lit('"'))
    g = j.groupBy("table_schema", "table_name").agg(
        _joined(pos, F.when(key, F.concat(q("t."), F.lit(" = "), q("s."))), " AND ").alias("_match"),
        _joined(pos, F.when(key, F.concat(q("t."), F.lit(" IS NULL"))), " AND ").alias("_ins_where"),
        _joined(pos, q(""), ", ").alias("insert_columns"),
        _joined(pos, q("s."), ", ").alias("insert_values"),
        _joined(pos, F.concat(q(""), F.lit(" = "), q("s.")), ", ").alias("_set"),
        F.max(key.cast("int")).alias("_nkeys"))
    return g.select("table_schema", "table_name",
                    F.when(F.col("_nkeys") == 1, F.col("_match")).otherwise(F.lit("1=1")).alias("match_condition"),
                    F.when(F.col("_nkeys") == 1, F.col("_ins_where")).otherwise(F.lit("1=1")).alias("insert_where"),
                    "insert_columns", "insert_values",
                    F.concat(F.col("_set"), F.lit(UPDATE_AUDIT_SET)).alias("update_set"))


def silver_catalog(lookup: DataFrame) -> DataFrame:
    """Columns of each derived silver table in order: surrogate key, source
    columns, audit columns (the target side of the legacy column plan)."""
    key = lookup.select("silverdwh_tablename").distinct().select(
        "silverdwh_tablename", surrogate_key_name_col(F.col("silverdwh_tablename")).alias("column_name"),
        F.lit(0).alias("position"))
    cols = lookup.select("silverdwh_tablename", F.col("silverdwh_columnname").alias("column_name"),
                         F.col("column_id").alias("position"))
    audit = lookup.select("silverdwh_tablename").distinct().select(
        "silverdwh_tablename",
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(100000 + i).alias("position"))
                           for i, (n, _) in enumerate(AUDIT_COLUMNS)])))
    return key.unionByName(cols).unionByName(audit)


def insert_columns(target_columns: DataFrame) -> DataFrame:
    """Target columns filled by the legacy INSERT: all not ending in 'key' (P17)."""
    return target_columns.where(~F.col("column_name").endswith("key"))


def update_columns(target_columns: DataFrame, source_columns: DataFrame,
                   table_pairs: DataFrame) -> DataFrame:
    """Target columns also present (same name) in the source table: the legacy
    UPDATE list (T2), in target order; a semi join on (table pair, name).
    ``table_pairs``: (silverdwh_tablename, source_table)."""
    src = source_columns.join(table_pairs, source_columns["table_name"] == table_pairs["source_table"]).select(
        F.col("silverdwh_tablename").alias("_p_t"), F.col("column_name").alias("_p_c"))
    return target_columns.join(src, (F.col("silverdwh_tablename") == F.col("_p_t"))
                               & (F.col("column_name") == F.col("_p_c")), "left_semi")


# ------------------------------------------------------------------ gold (D3)

def gold_columns(tables: DataFrame, columns: DataFrame, gold_map: DataFrame, table_pattern: str,
                 schema_pattern: str) -> DataFrame:
    """tables JOIN columns JOIN type map, whole-name regex filters, grouped per
    column with min/max position (J8, A9, P13).  The map is the caller's
    (source type -> column-store type) table, lower-cased on both sides."""
    m = broadcast_if_small(gold_map.select(F.lower("sourcedatatypes").alias("_m_src"),
                                           F.col("targetdatatypes").alias("column_type")).dropDuplicates())
    t = tables.where(F.col("table_name").rlike("^(" + table_pattern + ")$")
                     & F.col("table_schema").rlike("^(" + schema_pattern + ")$")).select(
        F.col("table_schema").alias("_t_s"), F.col("table_name").alias("_t_t"))
    j = t.join(columns, (F.col("_t_t") == F.col("table_name")) & (F.col("_t_s") == F.col("table_schema")))
    j = j.join(m, F.lower(F.col("data_type")) == F.col("_m_src"))
    return j.groupBy("table_name", F.col("table_schema").alias("schema_name"), "column_name", "column_type",
                     "ordinal_position").agg(F.min("ordinal_position").alias("min_attnum"),
                                             F.max("ordinal_position").alias("max_attnum"))


def gold_ddl(gold_cols: DataFrame, identity: DataFrame, target_database: str) -> DataFrame:
    """Column-store CREATE TABLE per table (D3, O3, F10): columns in position
    order, the identity column typed Int64 and used as the sort key.  NULL when
    the table has no identity column or its first column is unmapped (the
    original's text concatenation with NULL)."""
    ids = identity.select(F.col("table_schema").alias("_i_s"), F.col("table_name").alias("_i_t"),
                          "identity_column")
    j = gold_cols.join(ids, (F.col("schema_name") == F.col("_i_s")) & (F.col("table_name") == F.col("_i_t")), "left")
    ctype = F.when(F.col("column_name") == F.col("identity_column"), F.lit("Int64")).otherwise(F.col("column_type"))
    line = F.concat(F.lit("\n    "), F.col("column_name"), F.lit(" "), ctype)
    g = j.groupBy("schema_name", "table_name").agg(
        _joined(F.col("ordinal_position"), line, ",").alias("_body"),
        F.min("min_attnum").alias("_first"), F.first("identity_column", ignorenulls=True).alias("_pk"))
    ddl = F.when((F.col("_first") == 1) & F.col("_pk").isNotNull(),
                 F.concat(F.lit(f"CREATE TABLE {target_database}."), F.col("table_name"), F.lit(" ("),
                          F.col("_body"), F.lit(") ENGINE = MergeTree ORDER BY tuple("), F.col("_pk"),
                          F.lit(");")))
    return g.select("schema_name", "table_name", ddl.alias("ddl"))


# ---------------------------------------------------------------- legacy

def legacy_ddl(metadata: DataFrame, table_map: DataFrame, dialect: str) -> DataFrame:
    """Per-dialect CREATE TABLE of the legacy generator.

    ``metadata``: rows of :func:`table_metadata` (a column with two constraints
    appears twice, as in the original join).  ``table_map``: (table_name,
    target_table)."""
    raw = F.replace(F.upper(F.col("data_type")), F.lit(" WITHOUT TIME ZONE"), F.lit(""))
    mapped = F.lit(None).cast("string")
    for src, m in LEGACY_TYPE_MAP.items():
        if dialect in m:
            mapped = F.when(raw == F.lit(src), F.lit(m[dialect])).otherwise(mapped)
    dtype = F.coalesce(mapped, raw)
    has_len = F.col("max_length").isNotNull() & (F.col("max_length") != 0) & raw.contains("CHAR")
    size = F.when(has_len, F.concat(F.lit("("), F.col("max_length").cast("string"), F.lit(")"))).otherwise(F.lit(""))
    if dialect == "mysql":
        dtype = F.when(~has_len & raw.contains("CHAR"), F.lit("TEXT")).otherwise(dtype)
    nullable = F.when(F.col("is_nullable") == "YES", F.lit("NULL")).otherwise(F.lit("NOT NULL"))
    name = F.concat(F.lit('"'), F.col("column_name"), F.lit('"'))
    # the original strips the indented line, leaving no indent and two spaces
    # where the (always empty) auto-increment text stood
    coldef = F.concat(name, F.lit(" "), dtype, size, F.lit("  "), nullable)
    pos = F.struct(F.col("ordinal_position"), F.coalesce(F.col("constraint_type"), F.lit("")))
    j = metadata.join(table_map.select(F.col("table_name").alias("_m_t"), "target_table"),
                      F.col("table_name") == F.col("_m_t"))
    g = j.groupBy("table_name", "target_table").agg(
        _joined(pos, coldef, ",\n").alias("_cols"),
        _joined(pos, F.when(F.col("constraint_type") == "PRIMARY KEY", name), ", ").alias("_pks"))
    audit = "".join(f"    {n} {t} NULL,\n" for n, t in LEGACY_AUDIT)
    last = F.concat(F.lit("    "), legacy_key_name_col(F.col("target_table")), F.lit(" BIGINT "),
                    F.lit(IDENTITY_LEGACY[dialect]))
    ddl = F.concat(F.lit("CREATE TABLE "), F.col("target_table"), F.lit(" (\n"), F.col("_cols"), F.lit(",\n"),
                   F.lit(audit),
                   F.when(F.length("_pks") > 0, F.concat(F.lit("    PRIMARY KEY ("), F.col("_pks"), F.lit("),\n")))
                   .otherwise(F.lit("")),
                   last, F.lit("\n);"))
    return g.select("table_name", "target_table", ddl.alias("ddl"))
