"""Previous-row values inside a group, also where one group holds most rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.session import materialize, ship_package

# A group with more rows than this is not left to one task.
SLICE_ROWS = 1_000_000

# Most rows a lookup may have to be broadcast; beyond it the join is left to
# the adaptive planner.
BROADCAST_ROWS = 100_000


def _in_order(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> list[str]:
    """The columns rows of a group are put in order by: ``order``, then the values, then all else that can be compared."""
    first = [order, *columns]
    taken = {*keys, *first}
    rest = [f.name for f in df.schema.fields if f.name not in taken and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [*first, *rest]


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    prefix: str = "prev_",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``prev_<column>``: the value one row earlier in the group, by ``order``.

    ``order`` is a column of any type that can be compared. Rows without a value
    for it come first, and rows that share one are put in order by the values
    and then by their other columns, so the result is the same on any
    partitioning. When no group has more than ``slice_rows`` rows this is one
    window; otherwise the rows are scanned in ranges, see :func:`scanned`.
    """
    keys, columns = list(keys), list(columns)
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if largest is not None and largest > slice_rows:
        return scanned(df, keys, order, columns, prefix)
    window = Window.partitionBy(*keys).orderBy(*_in_order(df, keys, order, columns))
    return df.withColumns({prefix + c: F.lag(c).over(window) for c in columns})


# --- the scan in ranges ---

# Where a row stands in its range: number of the range, first of it, last of it.
_PLACE = (("_range", T.IntegerType()), ("_first", T.BooleanType()), ("_last", T.BooleanType()))


def _same(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether two arrays agree row by row; NULL agrees with NULL, and NaN with NaN."""
    equal = pc.or_(pc.fill_null(pc.equal(left, right), False), pc.and_(pc.is_null(left), pc.is_null(right)))
    if pa.types.is_floating(left.type):
        equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(left), pc.is_nan(right)), False))
    return equal


def _shifted(before: pa.Array, column: pa.Array) -> pa.Array:
    """A column one row down, with the one row ``before`` in front."""
    return pa.concat_arrays([before, column.slice(0, len(column) - 1)])


def scan_ranges(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """``df`` sorted by range, stored, with the previous values inside each range, and where each row stands in it."""
    ship_package(df.sparkSession)
    names = df.columns
    at_key, at_value = [names.index(k) for k in keys], [names.index(c) for c in columns]
    added = [T.StructField(prefix + c, df.schema[c].dataType) for c in columns]
    out = T.StructType([*df.schema.fields, *added, *[T.StructField(n, t) for n, t in _PLACE]])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, before = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            same = pa.array([True] * n)
            for i in at_key:
                column = batch.column(i)
                same = pc.and_(same, _same(column, _shifted(column.slice(0, 1) if before is None else before.column(i), column)))
            first = pa.array([before is None] + [False] * (n - 1))
            same = pc.and_not(same, first)
            found = []
            for i in at_value:
                column = batch.column(i)
                back = _shifted(column.slice(0, 1) if before is None else before.column(i), column)
                found.append(pc.if_else(same, back, pa.scalar(None, column.type)))
            if held is not None:
                yield pa.RecordBatch.from_arrays([*held, pa.array([False] * len(held[0]))], names=out.names)
            held = [*batch.columns, *found, pa.array([number] * n, pa.int32()), first]
            before = batch.slice(n - 1, 1)
        if held is not None:
            n = len(held[0])
            yield pa.RecordBatch.from_arrays([*held, pa.array([False] * (n - 1) + [True])], names=out.names)

    sorting = [*keys, *_in_order(df, keys, order, columns)]
    ranges = df.repartitionByRange(*[F.col(c) for c in sorting]).sortWithinPartitions(*sorting)
    return materialize(ranges.mapInArrow(scan, out), "scan")


def scanned(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """:func:`with_previous` by a segmented scan over a range sort, whatever the size of a group.

    Rows are sorted by keys and order by range, so a large group lies in several
    ranges of equal size. Each task looks one row back in its range; the first
    row of a range takes what it needs from the last row of the range before, and
    these last rows, one per range, are all that is passed on. Only rows that are
    the same in all columns cannot be cut apart.
    """
    keys, columns = list(keys), list(columns)
    stored = scan_ranges(df, keys, order, columns, prefix)
    # One row per range from here on.
    last = stored.where("_last").select("_range", F.struct(*keys).alias("_keys"), F.struct(*columns).alias("_values"))
    in_order = Window.orderBy("_range")
    seams = last.select(
        F.col("_range").alias("_at"), F.lag("_keys").over(in_order).alias("_keys"), F.lag("_values").over(in_order).alias("_values")
    )
    heads = stored.where("_first").join(F.broadcast(seams), F.col("_range") == F.col("_at"))
    goes_on = F.struct(*keys).eqNullSafe(F.col("_keys"))
    heads = heads.withColumns({prefix + c: F.when(goes_on, F.col("_values").getField(c)) for c in columns})
    result = [*df.columns, *[prefix + c for c in columns]]
    return stored.where("NOT _first").select(*result).unionByName(heads.select(*result))
