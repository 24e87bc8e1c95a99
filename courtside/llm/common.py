"""What the operators of this package share: word rules, let-bindings, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtside.session import materialize, ship_package

# White space between words, and what stands between words of letters, digits
# and anything outside ASCII.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
PLAIN_GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def one_spaced(text: Column) -> Column:
    """The words of a text joined by one space each; empty for NULL and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.regexp_replace(trimmed, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def raw_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters as they are written; an empty array for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), PLAIN_GAP_ANY_CASE), "")


def each_text(docs: DataFrame, fn: Callable, columns: list[str], schema: str) -> DataFrame:
    """Run ``fn(*values) -> row`` for every row, Arrow batches in and out.

    The rows of a batch are taken one by one, so a worker holds one batch and
    one text in Python form whatever the size of the table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    out = StructType.fromDDL(schema)
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            rows = [fn(*(v.as_py() for v in values)) for values in zip(*batch.columns)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], type=arrow.field(i).type) for i in range(len(names))], schema=arrow
            )

    return docs.select(*columns).mapInArrow(run, out)


def stored_copy(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; lineage ends there."""
    return materialize(df, name)


def stored_place() -> list[Column]:
    """The order in which a table of parquet files was written: by number of the part, name of its file, and row in it."""
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), name, F.col("_metadata.row_index")]


def with_row_key(docs: DataFrame) -> DataFrame:
    """(doc, k1, k2): each row as a struct, so that no name of its columns meets another, and two hashes of all of it.

    Equal rows have equal keys, other rows have others.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = lambda seed: F.xxhash64(F.lit(seed), *columns, *[c.isNull() for c in columns])
    return docs.select(F.struct(*columns).alias("doc"), key(1).alias("k1"), key(2).alias("k2"))


def once(keyed: DataFrame) -> DataFrame:
    """``with_row_key`` rows, one of each key."""
    twice = keyed.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2")
    if twice.isEmpty():
        return keyed
    single = keyed.join(twice, ["k1", "k2"], "left_anti")
    return single.unionByName(keyed.join(twice, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]))


def text_key(text: Column) -> list[Column]:
    """Two hashes that tell texts apart."""
    return [F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2")]


def sent_if_small(df: DataFrame, most: int) -> DataFrame:
    """``df`` to be broadcast if it has been counted to have no more than ``most`` rows; else the planner decides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def plain_words(text: Column) -> Column:
    """``raw_words`` with A-Z in lower case."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), PLAIN_GAP_ANY_CASE), "")
