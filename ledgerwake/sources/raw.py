"""Landing tables: create, read, default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwake.schemas import RAW_TABLES, RawTable
from ledgerwake.sources import landing


def create_raw_tables(spark: SparkSession, root: str, database: str = "raw") -> None:
    """Declare the landing tables in the catalog, once, for writers that insert in batches.

    The catalog knows the default of ``ingestion_time``: an ``INSERT`` that does not name the
    column is stamped. NOT NULL is declared as well; Spark records it for these tables, and what
    breaks it is found by the data tests.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in RAW_TABLES.values():
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}"
            + (" NOT NULL" if field.name in table.required else "")
            + (" DEFAULT current_timestamp()" if field.name == "ingestion_time" else "")
            for field in table.schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table.name} ({columns}) "
            f"USING parquet LOCATION '{root}/{table.name}'")


def load_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The landing tables under ``root``, whichever batch or stream wrote them.

    Where a stream has landed, its log is resolved to the primary key together with what batch
    writers inserted into the same table, which counts as older: prices by upsert, trades and
    cash by their first arrival. A table that only batches wrote is read as it is.
    """
    loaded = {}
    for name, table in RAW_TABLES.items():
        path = f"{root}/{name}"
        if landing.runs(spark, path):
            loaded[name] = landing.resolved(spark, path, table)
            continue
        found = landing.inserted(spark, path, table)
        loaded[name] = spark.createDataFrame([], table.schema) if found is None else found
    return loaded


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill the ingestion time a writer left out."""
    now = F.current_timestamp()
    if "ingestion_time" not in df.columns:
        return df.withColumn("ingestion_time", now)
    return df.withColumn("ingestion_time", F.coalesce("ingestion_time", now))


def as_raw(df: DataFrame, table: RawTable) -> DataFrame:
    """Project to the table's columns, in order and typed as declared."""
    defaulted = with_defaults(df)
    return defaulted.select(*[
        F.col(field.name).cast(field.dataType).alias(field.name) for field in table.schema])
