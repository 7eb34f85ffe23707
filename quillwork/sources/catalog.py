"""Tables, constraints, views and partitions in the session catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillwork import schemas
from quillwork.operators.quality import missing
from quillwork.session import delete, names_in

WAREHOUSE = {
    "amenities": schemas.AMENITIES,
    "customers": schemas.CUSTOMERS,
    "paymentmethods": schemas.PAYMENT_METHODS,
    "purchases": schemas.PURCHASES,
    "greater_vancouver_prefixes": schemas.POSTAL_PREFIXES,
}

# The catalogue forgets NOT NULL of tables kept in files, so it is a property of the table as well.
REQUIRED = "quillwork.required"
DAYS_A_STATEMENT = 500


def columns_of(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
                     for f in schema)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """A schema, in a folder of its own if one is given, else in the warehouse."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 fmt: str = "parquet") -> None:
    """A typed table without rows: an earlier one of the name, and what its folder holds, goes."""
    drop_table(spark, name)
    delete(spark, location)
    needed = ",".join(f.name for f in schema if not f.nullable)
    spark.sql(f"CREATE TABLE {name} ({columns_of(schema)}) USING {fmt} LOCATION '{location}' "
              f"TBLPROPERTIES ('{REQUIRED}' = '{needed}')")


def create_warehouse(spark: SparkSession, schema: str, location: str) -> None:
    """The typed, empty tables of the star schema below one folder."""
    create_schema(spark, schema, location)
    for name, fields in WAREHOUSE.items():
        create_table(spark, f"{schema}.{name}", fields, f"{location}/{name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_warehouse(spark: SparkSession, schema: str) -> None:
    for name in WAREHOUSE:
        drop_table(spark, f"{schema}.{name}")


def required_columns(spark: SparkSession, table: str) -> list[str]:
    """The columns that were declared NOT NULL when the table was created."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(f"key = '{REQUIRED}'").collect()
    return [c for r in rows for c in r.value.split(",") if c]


def load(df: DataFrame, table: str) -> None:
    """Bulk load: replace the rows of a table, matching columns by name.

    Rows without a declared column refuse the whole load, and the table keeps what it had: they are
    counted, in one scan of those columns, before anything is replaced.
    """
    spark = df.sparkSession
    if needed := required_columns(spark, table):
        if found := missing(df, needed).filter("rows > 0").collect():
            listed = ", ".join(f"{r['rows']} rows without {r['column']}" for r in found)
            raise ValueError(f"{table} is not loaded: {listed}")
    df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)


def create_purchases_by_day(spark: SparkSession, table: str, location: str,
                            schema: T.StructType = schemas.PURCHASES_BY_DAY) -> None:
    """External comma-separated table partitioned by date; register days separately."""
    drop_table(spark, table)
    spark.sql(
        f"CREATE TABLE {table} ({columns_of(schema)}, pdate DATE) "
        f"USING csv PARTITIONED BY (pdate) LOCATION '{location}'"
    )


def add_days(spark: SparkSession, table: str, location: str, days: list[str]) -> None:
    """Register daily directories, each as a partition of its own, some hundreds a statement."""
    for at in range(0, len(days), DAYS_A_STATEMENT):
        parts = " ".join(f"PARTITION (pdate='{day}') LOCATION '{location}/pdate={day}'"
                         for day in days[at:at + DAYS_A_STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def days_in(spark: SparkSession, location: str) -> list[str]:
    """The days that have a directory."""
    return [name.removeprefix("pdate=") for name in names_in(spark, location)
            if name.startswith("pdate=")]


def register_days(spark: SparkSession, table: str, location: str) -> list[str]:
    """Register the directories that the table does not know yet, and return their days."""
    known = {r.partition.removeprefix("pdate=") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [day for day in days_in(spark, location) if day not in known]
    add_days(spark, table, location, new)
    return new


def create_view(df: DataFrame, name: str) -> None:
    """A view of this session only."""
    df.createOrReplaceTempView(name)


def create_permanent_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A view in the catalogue, for all sessions that share it; the query may start with WITH."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)
