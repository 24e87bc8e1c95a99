"""Stacking: two sides of a row, several id slots, several tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unpivot_sides(df: DataFrame, shared: Sequence[str], sides: Sequence[Mapping[str, str]]) -> DataFrame:
    """One output row per side of each input row, in one scan.

    ``sides`` maps output names to input columns, one mapping per side.
    """
    rows = F.array(*[F.struct(*[F.col(src).alias(out) for out, src in side.items()]) for side in sides])
    return df.select(*shared, F.inline(rows))


def team_points(line_score: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(game, team, final score) for the home and the away side."""
    return unpivot_sides(
        line_score,
        ["game_id", *keep],
        [
            {"team_id": "team_id_home", "final_score": "pts_home"},
            {"team_id": "team_id_away", "final_score": "pts_away"},
        ],
    )


def distinct_roster(play_by_play: DataFrame, slots: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Distinct (game, team, player) over the named player slots, nulls left out."""
    sides = [{"team_id": f"player{s}_team_id", "player_id": f"player{s}_id"} for s in slots]
    stacked = unpivot_sides(play_by_play, ["game_id"], sides)
    return stacked.where(F.col("player_id").isNotNull()).distinct()


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """One type for a column that several tables have: same, widest number, or text."""
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, T.IntegralType) for t in distinct):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in distinct):
        return T.DoubleType()
    return T.StringType()


def stack_tables(
    tables: Mapping[str, DataFrame], source_column: str | None = "__source_table", limit: int | None = None
) -> DataFrame:
    """All rows of all tables; columns a table lacks are NULL.

    A column with different types is widened, or made text where no number
    type fits. ``limit`` keeps that many rows of each table, for previews.
    """
    wanted: dict[str, list[T.DataType]] = {}
    for df in tables.values():
        for field in df.schema.fields:
            wanted.setdefault(field.name, []).append(field.dataType)
    target = {name: common_type(types) for name, types in wanted.items()}

    parts = []
    for table, df in tables.items():
        part = df.limit(limit) if limit else df
        part = part.select(
            *[F.col(f.name).cast(target[f.name]) if f.dataType != target[f.name] else F.col(f.name)
              for f in df.schema.fields]
        )
        if source_column:
            part = part.withColumn(source_column, F.lit(table))
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stack_database(
    spark: SparkSession, database: str, source_column: str | None = "__source_table", limit: int | None = None
) -> tuple[DataFrame | None, dict[str, str]]:
    """:func:`stack_tables` over a database, and the tables that could not be read."""
    readable: dict[str, DataFrame] = {}
    skipped: dict[str, str] = {}
    for table in sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary):
        try:
            readable[table] = spark.table(f"`{database}`.`{table}`")
        except AnalysisException as error:
            skipped[table] = str(error).splitlines()[0]
    return (stack_tables(readable, source_column, limit) if readable else None), skipped


def merge_same_named(databases: Mapping[str, Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """Tables of the same name in several databases, appended to each other."""
    grouped: dict[str, dict[str, DataFrame]] = {}
    for database, tables in databases.items():
        for table, df in tables.items():
            grouped.setdefault(table, {})[database] = df
    return {table: stack_tables(parts, source_column=None) for table, parts in grouped.items()}
