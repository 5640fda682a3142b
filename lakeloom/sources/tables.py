"""Plain table scans (S2), flat files (S3) and storage listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a parquet scan of orders."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = scan_table(self.spark, self.path(name))
        return self._cache[name]


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Full scan of a bronze/silver table (S2); Catalyst prunes columns and pushes filters."""
    return spark.read.format(fmt).load(path)


def scan_flat(spark: SparkSession, path: str, schema: StructType | None = None,
              header: bool = True, sep: str = ",") -> DataFrame:
    """Flat sheet with a header row; every column name forced to text (S3).

    An explicit schema avoids the inference pass over the whole file.
    """
    r = spark.read.option("header", header).option("sep", sep)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.toDF(*[str(c) for c in df.columns])


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Storage listing (S10): path, size and modification time of every file.

    Only metadata columns are selected, so the binary content is never read.
    """
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true")
          .load(root))
    return df.select(F.col("path"), F.col("length").alias("size"),
                     F.col("modificationTime").alias("modification_time"))
