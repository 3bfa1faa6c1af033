"""Catalog tables of extracted text, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docpipe.sinks.files import write_counted

# The target table, every column a string.
TEXT_COLUMNS = {
    "object_id": "string",
    "claim_id": "string",
    "filename": "string",
    "file_extension": "string",
    "extracted_text": "string",
}


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def create_table(spark: SparkSession, table: str, columns: dict[str, str] = TEXT_COLUMNS) -> None:
    """Create the table unless it exists."""
    listed = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet")


def overwrite_table(df: DataFrame, table: str) -> int:
    """Replace the content of an existing table; columns are matched by name. Returns the rows written."""
    spark = df.sparkSession
    target = spark.table(table)
    missing = set(target.columns) - set(df.columns)
    if missing:
        raise ValueError(f"{table} needs columns {sorted(missing)}")
    rows = df.select(*[df[c].cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return write_counted(rows, lambda counted: counted.write.insertInto(table, overwrite=True))


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def run_sql(spark: SparkSession, *fragments: str) -> DataFrame:
    """Join the fragments with blanks and run them as one statement."""
    return spark.sql(" ".join(fragments))
