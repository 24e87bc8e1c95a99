"""Mixing sources to target weights along a time-varying curriculum.

DataFrame functions only. Training time runs from 0 to 1, and each source has a
weight that changes in a straight line over it. The integral of the weight is
the source's demand: of its target, the share G(t) is due by time t. A document
of the source holds a stretch of the source's words, repeats included, and its
position is the time at which the demand reaches that stretch, the inverse of
G. Documents sorted by position by range are the curriculum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import SPACE, SPACE_CHARS, let, once, stored_copy, with_row_key

# Weights dealt to the sources in order, repeating, and how each weight's
# schedule leans: weight at the end minus weight at the start, half of it, as a
# share of the mean (-1: all early, 0: even, 1: all late).
WEIGHTS = (5.0, 2.0, 1.0)
TILTS = (-0.5, 0.0, 0.5)
MAX_EPOCHS = 3
# Each source is cut into 16 ** BUCKET_DIGITS ranges of its shuffled order for running sums.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Words between white space; 0 for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return let(trimmed, lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE))).cast("long"))


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with their rank (from 0) by code point, NULL last.

    Sources are sorted by range and ranked in each range; where a range begins
    follows from the sizes of the ranges before it.
    """
    first = [F.col("source").isNull(), F.col("source")]
    ranged = stored_copy(sources.repartitionByRange(*first).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    begin = ranged.groupBy("range").agg(F.count("*").alias("n")).select(F.col("range").alias("_range"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    placed = ranged.join(F.broadcast(begin), F.col("range") == F.col("_range"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*first))
    return placed.withColumn("rank", F.col("begin") + inside - 1).select(*sources.columns, "rank")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size) with target and tilt.

    Weights are dealt to the sources by code point, NULL last. Targets share
    the sum of all sizes by weight; a target stops at ``max_epochs`` times its
    source, and the excess is shared again by weight, until none is above: the
    level at which the rest is shared only rises, so each round stops more
    sources. One row per source; what reaches the driver is a sum per round.
    """
    slot = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), slot + 1)
    cap = F.col("source_size") * float(max_epochs)
    dealt = _ranked(sources).withColumns({"weight": pick(weights), "tilt": pick(TILTS[: len(weights)]), "cap": cap})
    dealt = stored_copy(dealt.select("source", "source_size", "weight", "tilt", "cap"), "weights")
    everything = float(dealt.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        stopped = F.col("cap") <= F.lit(level) * F.col("weight") if level else F.lit(False)
        held, free = dealt.agg(F.sum(F.when(stopped, F.col("cap"))), F.sum(F.when(~stopped, F.col("weight")))).first()
        if free is None:  # all stop, or there is none
            break
        level, last = (everything - (held or 0.0)) / free, level
        if level <= last:
            break
    share = F.lit(level) * F.col("weight")
    return dealt.select("source", "source_size", "tilt", F.when(share >= F.col("cap"), F.col("cap")).otherwise(share).alias("target"))


def due(share: Column, tilt: Column) -> Column:
    """The time at which the integrated schedule reaches ``share``: the inverse of t + tilt (t * t - t)."""
    b = 1 - tilt
    return F.when(tilt == 0, share).otherwise((F.sqrt(F.greatest(b * b + 4 * tilt * share, F.lit(0.0))) - b) / (2 * tilt))


def mixed(docs: DataFrame, whole: bool = False, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, any others), sorted by range of position.

    doc_id, size, source, source_size, target, taken, copies, positions. A
    source's documents follow in the order of a hash of doc_id and text, as often as the
    target asks; the last one is taken in part, so that ``taken`` adds up to
    the rounded target. With ``whole`` it is taken whole if at least half of
    it is due, and not at all otherwise. ``positions`` are the training times
    of the copies. NULL texts have size 0 and are taken 0 times; NULL sources
    are one source; repeated rows are rows of their own.

    No group is summed in one task: each source is cut into hash ranges, whose
    sums are added up first. Only rows that are the same in id and text share one.
    """
    return _mixed(docs, whole, weights, max_epochs, [])


def _mixed(docs: DataFrame, whole: bool, weights: tuple[float, ...], max_epochs: int, carry: list[str]) -> DataFrame:
    """``mixed`` beside the columns ``carry``, which also order the documents that nothing else does."""
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    order = F.md5(named.cast("binary"))
    sized = stored_copy(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("o"), *carry).withColumn(
            "bucket", F.substring("o", 1, BUCKET_DIGITS)
        ),
        "sizes",
    )
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    goals = targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)).cast("long"))
    same = buckets["source"].eqNullSafe(goals["source"])
    plan = stored_copy(buckets.join(goals, same).select(buckets["source"], "bucket", "bucket_start", "source_size", "tilt", "target"), "mix")
    named = plan.withColumnsRenamed({"source": "_s", "bucket": "_b"})
    rows = sized.join(named, sized["source"].eqNullSafe(named["_s"]) & (sized["bucket"] == named["_b"]))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("o", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("bucket_start") + F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
    # Words of the target that are left when each epoch reaches the document.
    epochs = F.sequence(F.lit(0), F.lit(max_epochs - 1))
    wanted = F.round("target").cast("long")
    left = lambda e: wanted - (e * F.col("source_size") + F.col("start"))
    part = lambda e: F.greatest(F.least(left(e), F.col("size")), F.lit(0).cast("long"))
    slot = lambda e: F.when(2 * part(e) >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long")) if whole else part(e)
    share = lambda e: F.coalesce(F.least(F.try_divide(e * F.col("source_size") + F.col("start"), F.col("target")), F.lit(1.0)), F.lit(0.0))
    slots = F.filter(
        F.transform(epochs, lambda e: F.struct(slot(e).alias("words"), due(share(e), F.col("tilt")).alias("position"))), lambda s: s.getField("words") > 0
    )
    out = rows.withColumn("slots", slots).select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        F.aggregate("slots", F.lit(0).cast("long"), lambda a, s: a + s.getField("words")).alias("taken"),
        F.size("slots").alias("copies"),
        F.transform("slots", lambda s: s.getField("position")).alias("positions"),
        *carry,
    )
    return out.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def curriculum(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, position: str | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, any others) as often as the mix takes them, whole, sorted by range of training position.

    Columns as in ``docs``, and the training position as ``position`` if a name
    is given for it. Rows are told apart by a key of all their columns, so
    repeated and missing ids are rows of their own; equal rows are taken as
    often as all of them are. Rows with a NULL or blank text are not taken, rows
    without source are of one source, and an empty table stays empty.
    """
    keyed = with_row_key(docs)
    taken = _mixed(keyed.select("doc.doc_id", "doc.text", "doc.source", "k1", "k2"), True, weights, max_epochs, ["k1", "k2"]).where("copies > 0")
    rows = once(keyed).join(taken.select("k1", "k2", F.explode("positions").alias("position")), ["k1", "k2"])
    ordered = rows.orderBy("position", "doc.doc_id", "k1", "k2")
    return ordered.select("doc.*", *([F.col("position").alias(position)] if position else []))
