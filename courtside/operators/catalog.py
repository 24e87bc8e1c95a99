"""What tables and columns there are, and which columns tables share."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.operators.profile import column_statistics

METADATA = "table_name string, column_name string, position int, data_type string, nullable boolean"


def describe_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table, by table and position from 0."""
    rows = [
        (name, field.name, position, field.dataType.simpleString(), field.nullable)
        for name in sorted(tables)
        for position, field in enumerate(tables[name].schema.fields)
    ]
    return spark.createDataFrame(rows, METADATA)


def list_tables(spark: SparkSession, databases: Iterable[str]) -> list[tuple[str, str]]:
    """(database, table) of every stored table of the databases."""
    return [
        (database, table.name)
        for database in databases
        for table in sorted(spark.catalog.listTables(database), key=lambda t: t.name)
        if not table.isTemporary
    ]


def database_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Every stored table of a database by name."""
    return {name: spark.table(f"`{database}`.`{name}`") for _, name in list_tables(spark, [database])}


def describe_database(spark: SparkSession, database: str) -> DataFrame:
    """:func:`describe_tables` for a database of the catalog."""
    return describe_tables(spark, database_tables(spark, database))


def columns_by_table(metadata: DataFrame) -> DataFrame:
    """Each table with its column count and its columns in order."""
    ordered = F.sort_array(F.collect_list(F.struct("position", "column_name")))
    return metadata.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.array_join(F.transform(ordered, lambda c: c["column_name"]), ", ").alias("columns"),
    )


def common_columns(metadata: DataFrame) -> DataFrame:
    """Columns whose exact name occurs in more than one table, with where and what."""
    entry = F.struct(F.col("table_name").alias("name"), "position", F.col("data_type").alias("type"))
    return (
        metadata.groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("table_count"), F.sort_array(F.collect_list(entry)).alias("tables"))
        .where(F.col("table_count") > 1)
    )


def common_columns_report(common: DataFrame) -> DataFrame:
    """Most shared columns first; tables and their positions as matching text lists."""
    return common.select(
        "column_name",
        "table_count",
        F.array_join(F.col("tables")["name"], ", ").alias("tables"),
        F.array_join(F.transform("tables", lambda t: t["position"].cast("string")), ", ").alias("positions"),
    ).orderBy(F.desc("table_count"), "column_name")


def common_columns_rows(spark: SparkSession, tables: Mapping[str, DataFrame], keep_overflow: bool = False) -> DataFrame:
    """Statistics of every shared column, one row per column and table that has numbers.

    One aggregation per table covers all its shared columns. ``keep_overflow`` is
    that of :func:`column_statistics`.
    """
    names: dict[str, int] = {}
    for df in tables.values():
        for column in df.columns:
            names[column] = names.get(column, 0) + 1
    parts = []
    for table in sorted(tables):
        shared = [c for c in tables[table].columns if names[c] > 1]
        if shared:
            parts.append(column_statistics(tables[table], shared, keep_overflow=keep_overflow).withColumn("table_name", F.lit(table)))
    if not parts:
        return spark.createDataFrame([], "column string, n long, min double, max double, mean double, std double, "
                                         "table_name string")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def common_columns_document(spark: SparkSession, tables: Mapping[str, DataFrame], keep_overflow: bool = False) -> DataFrame:
    """The shared columns that have numbers somewhere, nested per table, ready for JSON but for what overflows."""
    statistics = common_columns_rows(spark, tables, keep_overflow).select(
        F.col("column").alias("column_name"),
        "table_name",
        F.struct("min", "max", "mean", "std").alias("statistics"),
    )
    metadata = describe_tables(spark, tables)
    shared = common_columns(metadata).select("column_name", "table_count")
    entry = F.struct(
        F.col("table_name").alias("name"), "position", F.col("data_type").alias("type"), "statistics"
    )
    return (
        metadata.join(shared, "column_name")
        .join(statistics, ["column_name", "table_name"], "left")
        .groupBy("column_name", "table_count")
        .agg(F.sort_array(F.collect_list(entry)).alias("tables"), F.count("statistics").alias("_numeric"))
        .where(F.col("_numeric") > 0)
        .drop("_numeric")
    )


def is_numeric(data_type: T.DataType) -> bool:
    """True for number types, judged by the type and not by its name."""
    return isinstance(data_type, T.NumericType)


def columns_like(df: DataFrame, *parts: str) -> list[str]:
    """Columns whose name contains one of the texts, in any case."""
    return [c for c in df.columns if any(part.lower() in c.lower() for part in parts)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Number columns, but for names containing one of the ``exclude`` texts."""
    unwanted = set(columns_like(df, *exclude)) if exclude else set()
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in unwanted]


def text_columns(df: DataFrame) -> list[str]:
    """Text columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def columns_containing(metadata: DataFrame, part: str) -> DataFrame:
    """Metadata rows whose column name contains a text, in any case."""
    return metadata.where(F.lower("column_name").contains(part.lower()))
