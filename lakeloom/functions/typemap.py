"""The cross-database type map (S8) and the type-class default values (L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

# ---------------------------------------------------------------------------
# They must equal the loader's seed rows exactly.
# (source database, target database, source type, target type)
# ---------------------------------------------------------------------------
TYPE_MAP_ROWS = [
    ("SQL Server", "PostgreSQL", "INT", "INTEGER"),
    ("SQL Server", "PostgreSQL", "BIGINT", "BIGINT"),
    ("SQL Server", "PostgreSQL", "SMALLINT", "SMALLINT"),
    ("SQL Server", "PostgreSQL", "TINYINT", "SMALLINT"),
    ("SQL Server", "PostgreSQL", "BIT", "TEXT"),
    ("SQL Server", "PostgreSQL", "DECIMAL", "NUMERIC"),
    ("SQL Server", "PostgreSQL", "NUMERIC", "NUMERIC"),
    ("SQL Server", "PostgreSQL", "FLOAT", "DOUBLE PRECISION"),
    ("SQL Server", "PostgreSQL", "REAL", "REAL"),
    ("SQL Server", "PostgreSQL", "MONEY", "NUMERIC(19,4)"),
    ("SQL Server", "PostgreSQL", "SMALLMONEY", "NUMERIC(10,4)"),
    ("SQL Server", "PostgreSQL", "VARCHAR", "VARCHAR"),
    ("SQL Server", "PostgreSQL", "NVARCHAR", "VARCHAR"),
    ("SQL Server", "PostgreSQL", "TEXT", "TEXT"),
    ("SQL Server", "PostgreSQL", "NTEXT", "TEXT"),
    ("SQL Server", "PostgreSQL", "CHAR", "CHAR"),
    ("SQL Server", "PostgreSQL", "NCHAR", "CHAR"),
    ("SQL Server", "PostgreSQL", "DATETIME", "TIMESTAMP"),
    ("SQL Server", "PostgreSQL", "DATETIME2", "TIMESTAMP"),
    ("SQL Server", "PostgreSQL", "SMALLDATETIME", "TIMESTAMP"),
    ("SQL Server", "PostgreSQL", "DATE", "DATE"),
    ("SQL Server", "PostgreSQL", "TIME", "TIME"),
    ("SQL Server", "PostgreSQL", "BINARY", "BYTEA"),
    ("SQL Server", "PostgreSQL", "VARBINARY", "BYTEA"),
    ("SQL Server", "PostgreSQL", "IMAGE", "BYTEA"),
    ("SQL Server", "PostgreSQL", "UNIQUEIDENTIFIER", "UUID"),
    ("SQL Server", "PostgreSQL", "XML", "TEXT"),
    ("SQL Server", "PostgreSQL", "SQL_VARIANT", "TEXT"),
    ("SQL Server", "PostgreSQL", "HIERARCHYID", "TEXT"),
    ("SQL Server", "PostgreSQL", "GEOGRAPHY", "TEXT"),
    ("SQL Server", "PostgreSQL", "GEOMETRY", "TEXT"),
    ("PostgreSQL", "PostgreSQL", "SMALLINT", "SMALLINT"),
    ("PostgreSQL", "PostgreSQL", "INTEGER", "INTEGER"),
    ("PostgreSQL", "PostgreSQL", "BIGINT", "BIGINT"),
    ("PostgreSQL", "PostgreSQL", "DECIMAL", "DECIMAL"),
    ("PostgreSQL", "PostgreSQL", "NUMERIC", "NUMERIC"),
    ("PostgreSQL", "PostgreSQL", "REAL", "REAL"),
    ("PostgreSQL", "PostgreSQL", "DOUBLE PRECISION", "DOUBLE PRECISION"),
    ("PostgreSQL", "PostgreSQL", "SERIAL", "SERIAL"),
    ("PostgreSQL", "PostgreSQL", "BIGSERIAL", "BIGSERIAL"),
    ("PostgreSQL", "PostgreSQL", "BOOLEAN", "BOOLEAN"),
    ("PostgreSQL", "PostgreSQL", "CHAR", "CHAR"),
    ("PostgreSQL", "PostgreSQL", "VARCHAR", "VARCHAR"),
    ("PostgreSQL", "PostgreSQL", "TEXT", "TEXT"),
    ("PostgreSQL", "PostgreSQL", "BYTEA", "BYTEA"),
    ("PostgreSQL", "PostgreSQL", "TIMESTAMP", "TIMESTAMP"),
    ("PostgreSQL", "PostgreSQL", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH TIME ZONE"),
    ("PostgreSQL", "PostgreSQL", "DATE", "DATE"),
    ("PostgreSQL", "PostgreSQL", "TIME", "TIME"),
    ("PostgreSQL", "PostgreSQL", "TIME WITH TIME ZONE", "TIME WITH TIME ZONE"),
    ("PostgreSQL", "PostgreSQL", "INTERVAL", "INTERVAL"),
    ("PostgreSQL", "PostgreSQL", "UUID", "UUID"),
    ("PostgreSQL", "PostgreSQL", "XML", "XML"),
    ("PostgreSQL", "PostgreSQL", "JSON", "JSON"),
    ("PostgreSQL", "PostgreSQL", "JSONB", "JSONB"),
    ("PostgreSQL", "PostgreSQL", "ARRAY", "ARRAY"),
    ("PostgreSQL", "PostgreSQL", "CITEXT", "CITEXT"),
    ("Flatfile", "PostgreSQL", "int64", "BIGINT"),
    ("Flatfile", "PostgreSQL", "int32", "INTEGER"),
    ("Flatfile", "PostgreSQL", "float64", "DOUBLE PRECISION"),
    ("Flatfile", "PostgreSQL", "float32", "REAL"),
    ("Flatfile", "PostgreSQL", "bool", "BOOLEAN"),
    ("Flatfile", "PostgreSQL", "object", "TEXT"),
    ("Flatfile", "PostgreSQL", "string", "TEXT"),
    ("Flatfile", "PostgreSQL", "category", "TEXT"),
    ("Flatfile", "PostgreSQL", "datetime64[ns]", "TIMESTAMP WITHOUT TIME ZONE"),
    ("Flatfile", "PostgreSQL", "datetime64[ns, tz]", "TIMESTAMP WITH TIME ZONE"),
    ("Flatfile", "PostgreSQL", "timedelta[ns]", "INTERVAL"),
]

# Type classes of the silver default value (information_schema
# data_type names) and the default each class gets.
INT_TYPES = ("integer", "bigint", "smallint")
DECIMAL_TYPES = ("decimal", "numeric", "float", "real", "double precision")
TEXT_TYPES = ("character varying", "varchar", "text", "character", "char")
TIME_TYPES = ("date", "timestamp", "timestamp without time zone", "timestamp with time zone", "time")
INT_DEFAULT = "0"
DECIMAL_DEFAULT = "0.00"
TEXT_DEFAULT = "''"
TIME_DEFAULT = "1970-01-01"

# Legacy per-dialect map (upper-cased source type -> dialect -> type)
LEGACY_TYPE_MAP = {
    "INT": {"mysql": "INT", "postgresql": "INTEGER", "mssql": "INT"},
    "VARCHAR": {"mysql": "VARCHAR", "postgresql": "VARCHAR", "mssql": "VARCHAR"},
    "DECIMAL": {"mysql": "DECIMAL", "postgresql": "NUMERIC", "mssql": "DECIMAL"},
    "TEXT": {"mysql": "TEXT", "postgresql": "TEXT", "mssql": "TEXT"},
    "DATE": {"mysql": "DATE", "postgresql": "DATE", "mssql": "DATE"},
    "TIMESTAMP WITHOUT TIME ZONE": {"mysql": "TIMESTAMP", "postgresql": "TIMESTAMP", "mssql": "DATETIME"},
    "TIMESTAMP": {"mysql": "TIMESTAMP", "postgresql": "TIMESTAMP", "mssql": "DATETIME"},
}

TYPE_MAP_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("sourcedatabasetype", StringType()),
    StructField("targetdatabasetype", StringType()),
    StructField("sourcedatatypes", StringType()),
    StructField("targetdatatypes", StringType()),
    StructField("createdatetime", TimestampNTZType()),
])


def type_map(spark: SparkSession, created=None) -> DataFrame:
    """The 68-row seed as a DataFrame (ids 1..68, inserted once, C7 quirk fixed)."""
    rows = [(i + 1, s, t, st, tt, created) for i, (s, t, st, tt) in enumerate(TYPE_MAP_ROWS)]
    return spark.createDataFrame(rows, TYPE_MAP_SCHEMA)


def legacy_type_map(spark: SparkSession) -> DataFrame:
    rows = [(src, dialect, tgt) for src, m in LEGACY_TYPE_MAP.items() for dialect, tgt in m.items()]
    return spark.createDataFrame(rows, "source_type string, dialect string, target_type string")


def type_default(data_type) -> F.Column:
    """Silver default value by type class (L2); NULL for other types."""
    t = F.col(data_type) if isinstance(data_type, str) else data_type
    return (F.when(t.isin(*INT_TYPES), F.lit(INT_DEFAULT))
            .when(t.isin(*DECIMAL_TYPES), F.lit(DECIMAL_DEFAULT))
            .when(t.isin(*TEXT_TYPES), F.lit(TEXT_DEFAULT))
            .when(t.isin(*TIME_TYPES), F.lit(TIME_DEFAULT))
            .otherwise(F.lit(None).cast("string")))
