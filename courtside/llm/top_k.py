"""Exact top-k search by histograms: for each query the k-th best score is located, then only what reaches it is kept.

Every row is scored against every query, in blocks. A round counts, for each
query, the scores of all rows in equal bins of the interval that holds its k-th
best score; the bin that holds it is the next interval, until an interval is one
whole number wide. Blocks leave out the bins below those that hold k scores of
their own, since the k-th best score of all rows is not there. A last pass
keeps the scores that are at least the k-th best, and of those that equal
it, in each block, no more of the smallest ids than can be needed.

Queries are worked on in waves of a bounded number of bytes, so what travels with the
plan does not grow with the table; a larger query set takes more waves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import stored_copy
from courtside.llm.vectors import scaled
from courtside.session import ship_package

K = 5
SCALE = 256
QUERY_EVERY = 50
# Bits of a score told apart in one round.
ROUND_BITS = 12
# Bytes of queries that travel with the plan at a time.
WAVE_BYTES = 32 << 20
# Rows and queries scored at once.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 256
SCHEMA = "query_id long, rank int, vec_id long, score long"


class _Unfit(ArithmeticError):
    """Scores that 64 bits cannot hold."""


def _blocks(batches: Iterable[pa.RecordBatch], scale: float, dims: int | None, numbers, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and matrix of the rows that count, ``size`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            kept, values = scaled(piece.column(1), scale, dims)
            yield piece.column(0).cast(pa.int64()).filter(pa.array(kept)), values.astype(numbers)


def _sizes(vectors: DataFrame, scale: float) -> tuple[int, int]:
    """Most entries of a vector, and its largest sum of squares, rounded up, of those that count."""

    size = BLOCK_ROWS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, square = 0, 0.0
        for _, x in _blocks(batches, scale, None, np.float64, size):
            dims, square = max(dims, x.shape[1]), max(square, float((x * x).sum(1).max(initial=0)))
        yield pa.RecordBatch.from_pydict({"dims": pa.array([dims], pa.int32()), "square": [square]})

    row = vectors.mapInArrow(run, "dims int, square double").agg(F.max("dims"), F.max("square")).first()
    dims, square = row[0] or 0, row[1] or 0.0
    if not square < float(1 << 61):
        raise _Unfit("scores of these vectors do not fit 64 bits")
    return dims, int(square * 1.000001) + 1


def _packed_queries(queries: DataFrame, scale: float, dims: int) -> DataFrame:
    """(block, wave, ids, data): queries in blocks of rows, dealt to waves by their bytes."""

    size = BLOCK_ROWS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, scale, dims, np.int64, size):
            if len(x):
                yield pa.RecordBatch.from_pydict({"ids": pa.array([ids.to_pylist()], pa.list_(pa.int64())), "data": pa.array([x.tobytes()], pa.binary())})

    packed = queries.mapInArrow(run, "ids array<long>, data binary").withColumn("block", F.monotonically_increasing_id())
    packed = stored_copy(packed, "queries")
    # Only numbers and sizes of blocks are summed up in order, a row for so many queries.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = packed.select("block", F.octet_length("data").cast("long").alias("bytes"))
    waves = sizes.select("block", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(WAVE_BYTES)).cast("long").alias("wave"))
    return packed.join(waves, "block")


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (queries @ rows.T).astype(np.int64)


class _Wave:
    """Some queries and, for each, the interval that holds its k-th best score."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, bound: int, k: int, scale: float):
        self.ids, self.matrix, self.k, self.scale = ids, matrix, k, scale
        self.block_rows, self.block_queries = BLOCK_ROWS, BLOCK_QUERIES
        self.bits = (2 * bound).bit_length()
        self.low = np.full(len(ids), -bound, np.int64)
        self.need = np.full(len(ids), k, np.int64)

    def scored(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """(first query, ids, scores less the low end of the query's interval) of blocks of queries and rows.

        A query's own row is far below any interval.
        """
        for ids, rows in _blocks(batches, self.scale, self.matrix.shape[1], self.matrix.dtype, self.block_rows):
            numbers = ids.fill_null(-1).to_numpy()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            asks = np.flatnonzero(known & np.isin(numbers, self.ids))
            for at in range(0, len(self.ids), self.block_queries):
                here = slice(at, at + self.block_queries)
                away = _scores(self.matrix[here], rows) - self.low[here, None]
                own = np.nonzero(self.ids[here, None] == numbers[asks])
                away[own[0], asks[own[1]]] = -1
                yield at, ids, away

    def histogram(self, batches: Iterable[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
        """(query, need, bin, n): counts of scores in bins 2 ** ``shift`` wide, from the top down to the block's own k-th best."""
        bins = 1 << (self.bits - shift)
        for at, _, away in self.scored(batches):
            inside = (away >= 0) & (away >> self.bits == 0)
            row, _ = np.nonzero(inside)
            flat = row * bins + (away[inside] >> shift)
            counts = np.bincount(flat, minlength=len(away) * bins).reshape(len(away), bins)
            above = counts[:, ::-1].cumsum(1)[:, ::-1] - counts
            need = self.need[at : at + len(away)]
            q, b = np.nonzero((counts > 0) & (above < need[:, None]))
            yield pa.RecordBatch.from_pydict({"query": pa.array(q + at, pa.int32()), "need": need[q], "bin": pa.array(b, pa.int32()), "n": counts[q, b]})

    def narrowed(self, shift: int, found: list) -> None:
        """Take the bin that holds the k-th best score as the interval; a query with fewer rows than k takes all."""
        all_rows = self.need > 0
        for query, bin_, above in found:
            self.low[query] += bin_ << shift
            self.need[query] -= above
            all_rows[query] = False
        self.low[all_rows] = np.iinfo(np.int64).min // 2
        self.need[all_rows] = 0
        self.bits = shift

    def reaching(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(query, vec_id, score) of a block's k best rows, smallest ids first among equals, that reach the k-th best score."""
        for at, ids, away in self.scored(batches):
            q, row = np.nonzero(away >= 0)
            score = away[q, row] + self.low[q + at]
            number, known = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
            order = np.lexsort((number[row], ~known[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            first = np.searchsorted(q, q)
            best = np.arange(len(q)) - first < self.k
            yield pa.RecordBatch.from_pydict(
                {"query_id": self.ids[q[best] + at], "query": pa.array(q[best] + at, pa.int32()), "vec_id": ids.take(pa.array(row[best])), "score": score[best]}
            )


def _kth_bins(counts: DataFrame) -> DataFrame:
    """(query, bin, above): the highest bin down to which there are ``need`` scores, and how many are above it."""
    down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    added = counts.groupBy("query", "need", "bin").agg(F.sum("n").alias("n")).withColumn("to_here", F.sum("n").over(down))
    above = F.col("to_here") - F.col("n")
    return added.where((F.col("to_here") >= F.col("need")) & (above < F.col("need"))).select("query", "bin", above.alias("above"))


def _search(vectors: DataFrame, wave: _Wave) -> DataFrame:
    """The wave's results, stored; one narrow job a round, of which a row per query of the wave comes back."""
    context = vectors.sparkSession.sparkContext

    def counted(shift: int) -> list:
        sent = context.broadcast(wave)  # WAVE_BYTES and three numbers per query at most
        counts = vectors.mapInArrow(lambda batches: sent.value.histogram(batches, shift), "query int, need long, bin int, n long")
        found = _kth_bins(counts).collect()
        sent.unpersist()
        return found

    while wave.bits > 0:
        shift = max(wave.bits - ROUND_BITS, 0)
        wave.narrowed(shift, counted(shift))
    sent = context.broadcast(wave)
    reached = vectors.mapInArrow(lambda batches: sent.value.reaching(batches), "query_id long, query int, vec_id long, score long")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = reached.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= wave.k)
    result = stored_copy(ranked.select("query_id", "rank", "vec_id", "score"), "top-k")
    sent.unpersist()
    return result


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = K, scale: float = SCALE) -> DataFrame:
    """The ``k`` best rows of ``vectors`` (vec_id, embedding, any others) for each query: query_id, rank, vec_id, score.

    Queries are the rows that ``is_query`` holds for, those whose vec_id is
    divisible by ``QUERY_EVERY`` if it is not given. The score is the inner product of
    floor(``scale`` * entry), exact; equal scores are ranked by smaller vec_id.

    Rows whose vector is NULL or holds a NULL or non-finite entry take no part;
    entries that a shorter vector lacks are 0. Rows with the query's vec_id are
    the query's own and no candidates; a query row that repeats has its results
    as often. Rows without vec_id are never queries, and rank last among
    equals. A query with fewer than ``k`` candidates has them all, and an
    empty table gives no rows. Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    is_query = F.col("vec_id") % QUERY_EVERY == 0 if is_query is None else is_query
    rows = vectors.select("vec_id", "embedding")
    dims, square = _sizes(rows, scale)
    dims = max(dims, 1)  # vectors without entries are those of one entry of 0
    queries = vectors.where(is_query & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    packed = _packed_queries(queries, scale, dims)
    # Products of numbers so small are exact in doubles, whose products are the faster ones.
    kind = np.float64 if square < 1 << 52 else np.int64
    results = []
    for (number,) in packed.select("wave").distinct().orderBy("wave").collect():
        blocks = packed.where(F.col("wave") == number).orderBy("block").select("ids", "data").collect()
        ids = np.concatenate([np.array(b["ids"], np.int64) for b in blocks])
        matrix = np.concatenate([np.frombuffer(b["data"], np.int64).reshape(-1, dims) for b in blocks])
        longest = max(isqrt(int(s)) + 1 for s in np.einsum("ij,ij->i", matrix.astype(np.float64), matrix.astype(np.float64)))
        bound = longest * (isqrt(square) + 1)
        results.append(_search(rows, _Wave(ids, matrix.astype(kind), bound, k, scale)))
    if not results:
        return spark.createDataFrame([], SCHEMA)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
