"""Table sources and sinks: scan by declared schema, materialise a projection."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType, StructType

from ..session import work_dir


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a table and hold it to a declared schema: columns are checked by
    name and cast to the declared types.  ANSI casts raise on values that do not
    fit; a fraction read into an integer column raises too (it is not cut)."""
    df = spark.read.format(fmt).load(path)
    if schema is None:
        return df
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"table at {path} lacks declared columns {missing}")

    def typed(f):
        c = F.col(f.name)
        whole = isinstance(f.dataType, IntegralType)
        if whole and isinstance(df.schema[f.name].dataType, FractionalType):
            c = F.when(c.isNull() | (c == F.floor(c)), c).otherwise(
                F.raise_error(F.lit(f"column {f.name} holds a value that is not whole")))
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[typed(f) for f in schema.fields])


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """A database table (the reference's source is a relational table)."""
    return spark.read.jdbc(url, table, properties=properties or {})


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``INSERT … SELECT`` into a new table: write Parquet, read it back."""
    spark = df.sparkSession
    path = path or f"{work_dir(spark)}/lodestar/tables/{name}-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
