"""Benchmark decontamination: hash set of test windows, scan, verify, remove.

DataFrame functions only. Hashes of the word runs inside the benchmark's windows
are the set; each document's windows are scanned against it by the run that
every window must hold, and the few windows that hit are verified by their
words in a join with the benchmark. A small set travels with the plan. A larger
one is a table that the hashes of the documents' runs, one in eleven words,
are joined to: broadcast up to ``MAX_SENT`` hashes, shuffled beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import ascii_lower, let, plain_words, raw_words, sent_if_small, stored_copy, text_key

WINDOW = 13
# Hashes of runs that are spelled out in the plan, and rows that are broadcast: some forty bytes each.
MAX_SET = 50_000
MAX_SENT = 2_000_000
# Words of a run that is looked up before the window around it is.
ANCHOR = 3
# A document is contaminated if hit words are at least one in so many.
ONE_IN = 20


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(size, gram, item_id): each item's windows; an item of fewer words is one window; none without words."""
    words = benchmark.select("item_id", plain_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.array_join(F.slice("w", i, size), " "))
    return words.select(size.alias("size"), F.explode(grams).alias("gram"), "item_id").distinct()


def _anchor(size: int) -> int:
    return min(ANCHOR, size)


def _hash(words: Column) -> Column:
    """Of words as they are written: case is folded, more of it than A-Z, so equal windows have equal hashes."""
    return F.xxhash64(F.lower(F.array_join(words, " ")))


def anchors(grams: DataFrame, size: int) -> DataFrame:
    """(h): hashes of all runs of anchor length inside the windows of a size."""
    k = _anchor(size)
    words = F.split("gram", " ")
    runs = F.transform(F.sequence(F.lit(1), F.lit(size - k + 1)), lambda i: _hash(F.slice(words, i, k)))
    return grams.where(F.col("size") == size).select(F.explode(runs).alias("h")).distinct()


def _runs(words: Column, size: int) -> Column:
    """Starts (from 1) of the runs that are looked up.

    Of ``size - k + 1`` neighbouring starts one is a multiple of that
    number, so each window holds the run of k words at such a start.
    """
    k = _anchor(size)
    step, last = size - k + 1, F.size(words) - (k - 1)
    return F.when(last >= step, F.sequence(F.lit(step), last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def _around(words: Column, size: int, hit: Column) -> Column:
    """Starts of the windows that hold a run that is in the set."""
    last, step = F.size(words) - (size - 1), size - _anchor(size) + 1
    around = F.flatten(F.transform(hit, lambda i: F.sequence(i - (step - 1), i)))
    return F.filter(around, lambda i: i <= last)


def _found_runs(docs: DataFrame, known: DataFrame, sizes: list[int], max_sent: int) -> DataFrame:
    """(t1, t2, at): for each text with runs in the set, their (size, start)."""
    words = raw_words(F.col("text"))
    run = lambda w, n: F.transform(
        _runs(w, n), lambda i: F.struct(F.lit(n).alias("size"), i.alias("start"), _hash(F.slice(w, i, _anchor(n))).alias("h"))
    )
    runs = docs.select(*text_key(F.col("text")), F.explode(let(words, lambda w: F.concat(*[run(w, n) for n in sizes]))).alias("run"))
    runs = runs.select("t1", "t2", "run.*")
    hits = runs.join(sent_if_small(known, max_sent), ["size", "h"], "left_semi")
    # Texts that occur again have the same runs.
    return hits.groupBy("t1", "t2").agg(F.collect_set(F.struct("size", "start")).alias("at"))


def scanned(docs: DataFrame, grams: DataFrame, max_set: int = MAX_SET, max_sent: int = MAX_SENT) -> DataFrame:
    """The columns of ``docs`` (text, others) but the text, n_words, hit: one row per document without ``hit``, and one per window that may hit."""
    sizes = [r[0] for r in grams.select("size").distinct().orderBy("size").collect()]  # at most WINDOW of them
    others = [c for c in docs.columns if c != "text"]

    def windows(words: Column, size: int, hit: Column) -> Column:
        gram = lambda i: ascii_lower(F.array_join(F.slice(words, i, size), " "))
        return F.transform(_around(words, size, hit), lambda i: F.struct(i.alias("start"), F.lit(size).alias("size"), gram(i).alias("gram")))

    def told(words: Column, hit_of) -> Column:
        none = F.array(F.lit(None).cast("struct<start:int,size:int,gram:string>"))
        return F.struct(F.size(words).cast("long").alias("n_words"), F.concat(none, *[windows(words, n, hit_of(words, n)) for n in sizes]).alias("hits"))

    known = stored_copy(grams.limit(0).select("size", F.lit(0).cast("long").alias("h")) if not sizes else _anchor_sets(grams, sizes), "anchors")
    if known.limit(max_set + 1).count() <= max_set:
        sets: dict[int, list[int]] = {n: [] for n in sizes}
        for n, h in known.collect():
            sets[n].append(h)
        inside = lambda words, n: F.filter(_runs(words, n), lambda i: _hash(F.slice(words, i, _anchor(n))).isin(sets[n]))
        seen = docs.select(*others, let(raw_words(F.col("text")), lambda w: told(w, inside)).alias("s"))
    else:
        found = sent_if_small(stored_copy(_found_runs(docs, known, sizes, max_sent), "runs"), max_sent // 100)
        placed = docs.select("*", *text_key(F.col("text"))).join(found, ["t1", "t2"], "left")
        at = lambda n: F.transform(F.filter(F.coalesce("at", F.array()), lambda r: r.getField("size") == n), lambda r: r.getField("start"))
        seen = placed.select(*others, let(raw_words(F.col("text")), lambda w: told(w, lambda _, n: at(n))).alias("s"))
    return seen.select(*others, "s.n_words", F.explode("s.hits").alias("hit"))


def _anchor_sets(grams: DataFrame, sizes: list[int]) -> DataFrame:
    """(size, h): the hashes of all runs of anchor length inside the windows of each size."""
    parts = [anchors(grams, n).select(F.lit(n).alias("size"), "h") for n in sizes]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def covered(spans: Column) -> Column:
    """Number of words inside spans (start, size), overlaps once."""
    ordered = F.sort_array(spans)
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = s.getField("start") + s.getField("size")
        new = F.greatest(end - F.greatest(acc.getField("end"), s.getField("start")), F.lit(0))
        return F.struct(F.greatest(acc.getField("end"), end).alias("end"), (acc.getField("n") + new).alias("n"))

    return F.aggregate(ordered, first, add, lambda acc: acc.getField("n"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_set: int = MAX_SET, max_sent: int = MAX_SENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, n_words, n_hit, n_items, item_ids, spans, contaminated.

    ``spans`` are the windows found (start from 1, size). NULL texts have no
    words; benchmark items without words or without item_id hit like others
    but a NULL id is not counted; repeated rows give repeated results; an
    empty benchmark leaves all documents clean.
    """
    judged = _judged(docs.select("doc_id", F.xxhash64("text").alias("digest"), "text"), benchmark, window, max_set, max_sent)
    # Rows that are the same in id and text were counted together.
    return judged.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(
        "doc_id", "n_words", "n_hit", "n_items", "item_ids", "spans", "contaminated"
    )


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, max_set: int, max_sent: int) -> DataFrame:
    """One row per different row of ``docs`` but its text, with how often it occurs (``times``) and what ``contamination`` tells."""
    grams = stored_copy(benchmark_windows(benchmark, window), "grams")
    rows = scanned(docs, grams, max_set, max_sent)
    pairs = sent_if_small(grams.select("gram", "item_id", F.lit(True).alias("verified")), max_sent // 20)
    joined = rows.join(pairs, rows["hit.gram"] == pairs["gram"], "left")
    spans = F.collect_set(F.when(F.col("verified"), F.struct(F.col("hit.start").alias("start"), F.col("hit.size").alias("size"))))
    found = joined.groupBy(*[c for c in docs.columns if c != "text"], "n_words").agg(
        F.count_if(F.col("hit").isNull()).alias("times"), spans.alias("spans"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")
    )
    counted = found.withColumn("n_hit", covered(F.col("spans")))
    dirty = (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))
    return counted.withColumn("contaminated", dirty).withColumn("n_items", F.size("item_ids").cast("long"))


def _by_text(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``_judged`` of the different texts of ``docs``: (t1, t2) and what is found in them."""
    return _judged(docs.select(*text_key(F.col("text")), "text"), benchmark, WINDOW, MAX_SET, MAX_SENT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, any others, which all come out) whose text is not contaminated.

    Each row is judged by its own text, so rows that share a doc_id, or have
    none, do not touch each other, and rows that repeat stay or go together.
    NULL and empty texts stay. With an empty benchmark all rows stay; an empty
    table stays empty.
    """
    bad = stored_copy(_by_text(docs, benchmark).where("contaminated").select("t1", "t2"), "contaminated")
    placed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *text_key(F.col("text")))
    return placed.join(sent_if_small(bad, MAX_SENT // 10), ["t1", "t2"], "left_anti").select("doc.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id and text of every row of ``docs`` (doc_id, text, any others), the words inside hit windows cut out.

    The words left are in lower case and joined by one space, also in rows
    without a hit; a NULL text has none and comes out empty. Each row is cut by
    its own text's windows, whatever its doc_id; repeated rows stay.
    """
    found = stored_copy(_by_text(docs, benchmark).where("n_hit > 0").select("t1", "t2", "spans"), "spans")
    hit = lambda i: F.exists(
        "spans", lambda s: (i + 1 >= s.getField("start")) & (i + 1 < s.getField("start") + s.getField("size"))
    )
    texts = docs.select("doc_id", plain_words(F.col("text")).alias("w"), *text_key(F.col("text"))).join(found, ["t1", "t2"], "left")
    left = F.when(F.col("spans").isNull(), F.col("w")).otherwise(F.filter("w", lambda w, i: ~hit(i)))
    return texts.select("doc_id", F.array_join(left, " ").alias("text"))
