"""Relational sources over JDBC (S1): one options builder per dialect.

A profile (dialect, host, port, database, user, password) becomes the option
map of ``spark.read.format("jdbc")``.  Large tables are read in parallel by
range on a numeric/date column (partitionColumn + bounds + numPartitions); the
bounds can be taken from the table itself with one MIN/MAX query.  The password
is never part of a repr or log line.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# URL prefix and driver class per dialect name of a profile.
DIALECTS = {
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver", 5432),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver", 3306),
    "mssql": ("jdbc:sqlserver://{host}:{port};databaseName={database}",
              "com.microsoft.sqlserver.jdbc.SQLServerDriver", 1433),
    "oracle": ("jdbc:oracle:thin:@//{host}:{port}/{database}", "oracle.jdbc.OracleDriver", 1521),
    "clickhouse": ("jdbc:clickhouse://{host}:{port}/{database}", "com.clickhouse.jdbc.ClickHouseDriver", 8123),
}
ALIASES = {"mssql+pyodbc": "mssql", "sqlserver": "mssql", "postgres": "postgresql"}


@dataclass
class Profile:
    dialect: str
    host: str
    database: str
    user: str
    password: str = field(repr=False, default="")
    port: int | None = None
    schema: str | None = None

    @classmethod
    def from_dict(cls, d: dict) -> "Profile":
        c = d.get("connection", d)
        return cls(dialect=d.get("dialect", c.get("dialect", "")), host=c.get("host", ""),
                   database=c.get("database", ""), user=c.get("username", c.get("user", "")),
                   password=c.get("password", "") or "", port=c.get("port"), schema=c.get("schema"))

    def __repr__(self) -> str:  # never show the password
        return f"Profile({self.dialect}://{self.user}@{self.host}:{self.port}/{self.database})"


def jdbc_options(p: Profile, table: str | None = None, query: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetchsize: int = 10000) -> dict:
    """Options for ``spark.read.format('jdbc')``; ``table`` or ``query``."""
    d = ALIASES.get(p.dialect.lower(), p.dialect.lower())
    if d not in DIALECTS:
        raise ValueError(f"unsupported dialect {p.dialect!r}")
    url, driver, default_port = DIALECTS[d]
    opts = {"url": url.format(host=p.host, port=p.port or default_port, database=p.database),
            "driver": driver, "user": p.user, "password": p.password, "fetchsize": str(fetchsize)}
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    if table is not None:
        opts["dbtable"] = table if "." in table or not p.schema else f"{p.schema}.{table}"
    else:
        opts["query"] = query
    if partition_column:
        if table is None:
            raise ValueError("a partitioned read needs a table, not a query")
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, p: Profile, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, num_partitions: int | None = None, **kw) -> DataFrame:
    """Read a table/query; with ``partition_column`` and no bounds, the bounds come
    from one MIN/MAX query on the table so the ranges cover it exactly."""
    lo, hi = kw.pop("lower_bound", None), kw.pop("upper_bound", None)
    if partition_column and (lo is None or hi is None):
        b = spark.read.format("jdbc").options(**jdbc_options(
            p, query=f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}")).load()
        row = b.collect()[0]  # one row: the bounds
        lo, hi = row["lo"], row["hi"]
        if lo is None:  # an empty table, or no value to cut ranges by: one partition reads it
            partition_column = num_partitions = None
    opts = jdbc_options(p, table=table, query=query, partition_column=partition_column, lower_bound=lo,
                        upper_bound=hi, num_partitions=num_partitions, **kw)
    return spark.read.format("jdbc").options(**opts).load()
