"""New CSV files into a table, each once."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courtside.functions.text import csv_value
from courtside.operators import types
from courtside.sources.csv import typed


def incremental_csv_load(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    multiline: bool = True,
) -> StreamingQuery:
    """Append the CSV files that came since the last run to a parquet table, then stop.

    Cells are read as text and cast as a load casts them, and may hold line
    breaks inside quotes, for which one task reads a whole file: large tables should come
    in files of bounded size, as :func:`~courtside.sources.csv.in_files` makes them.
    ``multiline=False`` declares that no cell does, so that a large file is read in splits. The checkpoint knows
    which files were taken and the sink which of its files count, so a run that
    is cut off and started again neither loses nor repeats rows.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.readStream.schema(as_text).option("header", True).option("escape", '"').option("multiLine", multiline)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.csv(folder)
    cells = raw.select(*[csv_value(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return (
        typed(cells, schema)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def widening_csv_load(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 64,
    multiline: bool = True,
) -> StreamingQuery:
    """Take in the CSV files that came since the last run, whatever their headers, then stop.

    No schema is given: a file may bring columns in another order, new ones, or
    wider values than the files before. Cells are kept as text in
    ``<target>/cells/batch=<number>``, and the warehouse type of each column of a
    batch in ``<target>/types/batch=<number>``; :func:`widened_table` merges
    them. A batch that is taken again after a cut replaces its own folders, so no
    row is lost or repeated. Files without rows bring their columns only;
    names of columns differ by more than case.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        reader = session.read.option("header", True).option("escape", '"').option("multiLine", multiline)
        # As many names as a batch has files; each header is read from its first line.
        by_header: dict[tuple[str, ...], list[str]] = {}
        for row in batch.collect():
            path = unquote(row["path"])
            by_header.setdefault(tuple(reader.csv(path).columns), []).append(path)
        parts = []
        for header, paths in sorted(by_header.items()):
            if header:
                raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(sorted(paths))
                parts.append(raw.select(*[csv_value(F.col(f"`{c}`")).alias(c) for c in header]))
        if not parts:
            return
        cells = f"{target}/cells/batch={number}"
        text = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        text.write.mode("overwrite").parquet(cells)
        profiles = types.profile_rows(session.read.schema(text.schema).parquet(cells))
        rows = [
            (p["position"], p["column"], None if types.kind(p) == "empty" else types.warehouse_type(p), types.is_nullable(p))
            for p in profiles
        ]
        told = session.createDataFrame(rows, "position int, column string, type string, nullable boolean")
        told.coalesce(1).write.mode("overwrite").parquet(f"{target}/types/batch={number}")

    return (
        files.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def widened_schema(spark: SparkSession, target: str) -> T.StructType:
    """Columns of all batches in the order they came, each of the narrowest warehouse type that holds all its cells.

    Columns without values are text; those a batch lacks, or has missing values in, are nullable.
    """
    told = spark.read.parquet(f"{target}/types")
    batches = told.select(F.count_distinct("batch")).first()[0]
    # A row per column: its place, the few types it had, and whether a cell is missing.
    rows = (
        told.groupBy("column")
        .agg(F.min(F.struct("batch", "position")).alias("first"), F.array_sort(F.collect_set("type")).alias("types"),
             (F.max("nullable") | (F.count(F.lit(1)) < batches)).alias("nullable"))
        .orderBy("first")
        .collect()
    )
    return T.StructType([
        T.StructField(r["column"], types.spark_type(reduce(types.merge_warehouse, r["types"], *([] if r["types"] else ["STRING"]))), r["nullable"])
        for r in rows
    ])


def widened_table(spark: SparkSession, target: str) -> DataFrame:
    """The rows that :func:`widening_csv_load` took in, under the merged schema; columns a file lacked are NULL.

    What a column held before it became wider is cast from its text, so nothing
    is lost by the order in which files came.
    """
    schema = widened_schema(spark, target)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return typed(spark.read.schema(as_text).parquet(f"{target}/cells/batch=*"), schema)
