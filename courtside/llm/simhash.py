"""SimHash near-duplicates through segment popcounts.

A 64-bit fingerprint is cut into 32 segments of two bits, and each segment is
replaced by its number of ones (0, 1 or 2). The Manhattan distance of two such
vectors never exceeds the Hamming distance of the fingerprints. Two
fingerprints at Hamming distance 5 or less are therefore within Manhattan
distance 2 in the first or in the second half of the vector, and then some grid
point of that half lies within 1 of both. Every fingerprint is put on its own
grid point and the points next to it, and fingerprints that meet on a point are
compared exactly.

Copies share a fingerprint and are folded before the grid. On a point that many
fingerprints share no list of pairs is written: a search that takes
fingerprints out as it reaches them returns one link per fingerprint. A
point with more than ``POINT_ROWS`` of them is cut into blocks, and every two
blocks are searched together, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import each_text, once, stored_copy, with_row_key
from courtside.session import ship_package

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
POINT_ROWS = 4096
SMALL_POINT = 12
_STEP = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of a text; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle_words:
        spans = [(0, len(joined))]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        spans = list(zip((ends - sizes + 1).tolist(), ends[shingle_words - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), _STEP):
        part = spans[at : at + _STEP]
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row of ``docs`` (doc_id, text)."""
    return each_text(docs, _identified, ["doc_id", "text"], "doc_id long, fp long")


def _identified(doc_id, text):
    return doc_id, fingerprint(text)


def grid(fps: DataFrame) -> DataFrame:
    """(point, fp): the grid points of each half that a fingerprint lies on or next to."""
    field = lambda half: f"(shiftrightunsigned(fp, {32 * half}) & 4294967295L)"
    points = []
    for half in (0, 1):
        ones = f"(({field(half)} & 1431655765L) + (shiftright({field(half)}, 1) & 1431655765L))"
        own = f"({ones} | shiftleft({half}L, 32))"
        up = f"filter(transform(sequence(0, 15), s -> if((shiftright({ones}, 2 * s) & 3) < 2, {own} + shiftleft(1L, 2 * s), null)), p -> p is not null)"
        down = f"filter(transform(sequence(0, 15), s -> if((shiftright({ones}, 2 * s) & 3) > 0, {own} - shiftleft(1L, 2 * s), null)), p -> p is not null)"
        points += [f"array({own})", up, down]
    return fps.select(F.explode(F.expr(f"concat({', '.join(points)})")).alias("point"), "fp")


def _reach(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """One link per fingerprint, to the one it was reached from; the links connect each component."""
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    rest = fps
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = [root]
        while frontier and len(rest):
            here = frontier.pop()
            near = np.bitwise_count(rest ^ here) <= bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                frontier.extend(found)
                left.append(np.full(len(found), here))
                right.append(found)
    return np.concatenate(left), np.concatenate(right)


def _links(points: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among rows sorted by point."""
    heads = np.flatnonzero(np.r_[True, points[1:] != points[:-1]])
    sizes = np.diff(np.r_[heads, len(points)])
    a, b = [], []
    size_of_row = np.repeat(sizes, sizes)
    few = size_of_row <= SMALL_POINT
    p, f, n = points[few], fps[few], size_of_row[few]
    for shift in range(1, SMALL_POINT):
        if len(p) <= shift:
            break
        met = (p[shift:] == p[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= bits)
        a.append(f[:-shift][met])
        b.append(f[shift:][met])
        wider = n > shift + 1
        p, f, n = p[wider], f[wider], n[wider]
    for head, size in zip(heads[sizes > SMALL_POINT], sizes[sizes > SMALL_POINT]):
        left, right = _reach(fps[head : head + size], bits)
        a.append(left)
        b.append(right)
    none = [np.empty(0, np.uint64)]
    return np.concatenate(a or none).view(np.int64), np.concatenate(b or none).view(np.int64)


def _search(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(points, fps):
            left, right = _links(points, fps, bits)
            pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0) if len(left) else np.empty((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        points, fps = np.empty(0, np.int64), np.empty(0, np.uint64)  # signed numbers are counted without their sign
        for batch in batches:
            points = np.r_[points, batch.column(0).to_numpy(zero_copy_only=False)]
            fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
            if not len(points):
                continue
            last = np.searchsorted(points, points[-1])  # the last point may go on in the next batch
            if last:
                yield out(points[:last], fps[:last])
                points, fps = points[last:], fps[last:]
        if len(points):
            yield out(points, fps)

    return run


def links(fps: DataFrame, bits: int = MAX_BITS, point_rows: int = POINT_ROWS) -> DataFrame:
    """(a, b), a < b: links that connect all distinct fingerprints at ``bits`` or fewer differing bits.

    Every component is connected by the links; not every close pair is listed.
    """
    if bits > 5:
        raise ValueError("two halves with neighbouring points find distances up to 5")
    ship_package(fps.sparkSession)
    met = grid(fps).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("point"))).where("n > 1")
    met = stored_copy(met, "grid")
    small = met.where(F.col("n") <= point_rows).select("point", "fp").repartition("point").sortWithinPartitions("point")
    blocks = F.ceil(F.col("n") * 2 / point_rows)
    large = (
        met.where(F.col("n") > point_rows)
        .select("point", "fp", blocks.alias("k"), F.pmod(F.xxhash64("fp"), blocks).alias("own"))
        .select("point", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("other"))
        .select(F.xxhash64("point", F.least("own", "other"), F.greatest("own", "other")).alias("point"), "fp")
        .repartition("point")
        .sortWithinPartitions("point")
    )
    search = _search(bits)
    found = small.mapInArrow(search, "a long, b long").unionByName(large.mapInArrow(search, "a long, b long"))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for the nodes of ``edges`` (a, b).

    Rounds of large star and small star; each round is a written table, and the
    rounds end when the links no longer change.
    """
    edges = stored_copy(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored_copy(large.where("a <> b").distinct(), "star")
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        edges = stored_copy(small.where("a <> b").distinct(), "star")
        mark, before = _mark(edges), mark
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs`` (doc_id, text, any others).

    ``component_id`` is the smallest doc_id reachable over links of ``bits`` or
    fewer differing bits. NULL and blank texts have fingerprint zero and link
    like any other; repeated rows stay; rows without doc_id get the component
    of their fingerprint; an empty table gives no rows.
    """
    prints = stored_copy(fingerprints(docs), "fingerprints")
    first = stored_copy(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "first")
    found = components(links(first.select("fp"), bits))
    member = found.withColumnRenamed("node", "fp").join(first, "fp")
    smallest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = member.join(smallest, "root").select("fp", "component_id")
    classes = first.join(classes, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    # Stored, so that nothing else asks for the copies of a fingerprint to stay together and the join may split them.
    classes = stored_copy(classes, "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the row with the smallest doc_id, one without doc_id only if no other has one.

    All columns are kept. Rows are told apart by a key of all their columns, so
    different texts that share a doc_id, or have none, are documents of their
    own. Of equal rows one stays; rows with neither doc_id nor words stay.
    """
    keyed = with_row_key(docs)
    named = keyed.select("doc.doc_id", "doc.text", "k1", "k2")
    prints = stored_copy(each_text(named, _keyed, ["doc_id", "text", "k1", "k2"], "doc_id long, fp long, blank boolean, k1 long, k2 long"), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    first = stored_copy(prints.groupBy("fp").agg(F.min(place).alias("first")), "first")
    member = components(links(first.select("fp"), bits)).withColumnRenamed("node", "fp").join(first, "fp")
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    classes = first.join(member.join(least, "root").select("fp", "least"), "fp", "left")
    classes = stored_copy(classes.select("fp", F.coalesce("least", "first").alias("stays")), "classes")
    others = (F.col("k1") != F.col("stays.k1")) | (F.col("k2") != F.col("stays.k2"))
    extra = prints.join(classes, "fp").where(others & ~(F.col("blank") & F.col("doc_id").isNull())).select("k1", "k2").distinct()
    return once(keyed.join(extra, ["k1", "k2"], "left_anti")).select("doc.*")


def _keyed(doc_id, text, k1, k2):
    return doc_id, fingerprint(text), not (text or "").split(), k1, k2
