"""Quality rules: counts of each text, and divergence from language references.

DataFrame functions only. A document's histogram of character classes and its
histogram of common words are compared with those of each language by
Jensen-Shannon distance (base 2, 0 to 1), and the nearest language counts. The
references are sums over all documents of a language that are long enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import SPACE_CHARS, let, one_spaced, stored_copy

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Below these lengths a histogram says too little and the rule is not applied.
# The distances are set so that no labelled good document of the test tables
# that passes the base rules lies beyond them.
MIN_CLASS_CHARS = 300
MIN_COMMON_WORDS = 50
MAX_CLASS_DISTANCE = 0.28
MAX_COMMON_DISTANCE = 0.265
MIN_LANGUAGE_DOCS = 20
# Up to so many references are written into the plan; more are a joined row.
INLINE_LANGUAGES = 200

# Frequent function words of the languages that have a list.
COMMON_WORDS = {
    "de": "der die und den von das mit ist",
    "en": "the of and to in that for is",
    "es": "de la que el en los del por",
    "fr": "de la le et les des pour qui",
}


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more, first ones included.

    Words and windows are told apart by 64-bit hashes. Only texts with fewer
    distinct windows than windows are sorted.
    """

    join = lambda x, y: F.xxhash64(x, y)

    def after(h: Column, step: int) -> Column:
        return F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0)))

    def doubled(length: int):
        return lambda r: F.zip_with(r, after(r, length), join)

    def windows(h: Column) -> Column:
        """Hashes of growing runs: of n words, then n more, as far as the window."""
        runs, length = h, 1
        while 2 * length <= window:
            runs, length = let(runs, doubled(length)), 2 * length
        for length in range(length, window):
            runs = F.zip_with(runs, after(h, length), join)
        return F.slice(runs, 1, F.greatest(F.size(h) - (window - 1), F.lit(0)))

    def covered(keys: Column) -> Column:
        """A walk over the windows beside those that occur once, which stand in the same order."""
        twice = let(F.sort_array(keys), lambda o: F.array_distinct(F.filter(o, lambda x, j: F.when(j > 0, F.get(o, j - 1) == x).otherwise(False))))
        return let(F.array_except(keys, twice), lambda once: F.aggregate(keys, start, lambda a, x: step(a, x, once), lambda a: a.getField("n")))

    start = F.struct(*[F.lit(0).alias(f) for f in ("seen", "at", "end", "n")])

    def step(a: Column, key: Column, once: Column) -> Column:
        single = F.coalesce(F.get(once, a.getField("seen")) == key, F.lit(False))
        at, end = a.getField("at"), a.getField("end")
        return F.struct(
            (a.getField("seen") + single.cast("int")).alias("seen"),
            (at + 1).alias("at"),
            F.when(single, end).otherwise(at + window).alias("end"),
            (a.getField("n") + F.when(single, 0).otherwise(at + window - F.greatest(end, at))).alias("n"),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(
        let(hashes, windows), lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(covered(keys))
    )


def class_counts(text: Column, word_chars: Column) -> Column:
    """Counts of characters by class: white space, lower-case, upper-case, digits, symbols, punctuation, bytes past ASCII."""
    without = lambda t, pattern: F.length(t) - F.length(F.regexp_replace(t, pattern, ""))
    blank = F.length(text) - word_chars

    def of(rest: Column) -> Column:
        lower = F.length(text) - F.length(rest) - blank
        signs = without(rest, r"[!\"'()+,./:;=?@\[\\\]^_`{}~-]+")
        return F.array(blank, lower, without(rest, "[A-Z]+"), without(rest, "[0-9]+"), without(rest, SYMBOLS), signs, F.octet_length(rest) - F.length(rest))

    # What is left without lower-case letters and white space is short.
    return let(F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", ""), of)


def vocabulary(common_words: dict[str, str] = COMMON_WORDS) -> list[str]:
    return sorted({w for words in common_words.values() for w in words.split()})


def common_counts(words: Column, listed: list[str]) -> Column:
    """Counts of each listed word, small or with a capital, and of all others at the end."""
    spelled = sorted({*listed, *(w.capitalize() for w in listed)})
    count = lambda t, n, w: (n - F.length(F.replace(t, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)
    joined = lambda x: F.lower(F.concat(F.lit(" "), F.array_join(x, "  "), F.lit(" ")))
    return let(
        F.filter(words, lambda w: w.isin(spelled)),
        lambda x: F.concat(let(joined(x), lambda t: let(F.length(t), lambda n: F.array(*[count(t, n, w) for w in listed]))), F.array((F.size(words) - F.size(x)).cast("double"))),
    )


def _entropy(x: Column) -> Column:
    return F.when(x > 0, -x * F.log2(x)).otherwise(0.0)


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def _distance(shares: Column, own: Column, reference: Column, other: Column | float) -> Column:
    """Of shares and a reference, with the entropies of both."""
    mean = F.zip_with(shares, reference, lambda p, q: _entropy((p + q) / 2))
    return F.sqrt(F.greatest(_total(mean) - (own + other) / 2, F.lit(0.0)))


def _compared(counts: Column, nearest) -> Column:
    """``nearest(shares, their entropy)`` of counts."""
    of = lambda shares: let(_total(F.transform(shares, _entropy)), lambda own: nearest(shares, own))
    return let(let(F.greatest(_total(counts), F.lit(1.0)), lambda n: F.transform(counts, lambda c: c / n)), of)


def distances(counts: Column, known: list[list[float]]) -> Column:
    """The smallest Jensen-Shannon distance (base 2) between counts and one of the reference shares."""

    def to(shares: Column, own: Column, reference: list[float]) -> Column:
        other = -math.fsum(q * math.log2(q) for q in reference if q > 0)
        return _distance(shares, own, F.array(*[F.lit(q) for q in reference]), other)

    return _compared(counts, lambda shares, own: F.least(*[to(shares, own, r) for r in known], F.lit(1.0)))


def distances_to(counts: Column, known: Column) -> Column:
    """``distances`` to an array of reference shares."""
    to = lambda shares, own, r: let(_total(F.transform(r, _entropy)), lambda other: _distance(shares, own, r, other))
    return _compared(counts, lambda shares, own: F.aggregate(known, F.lit(1.0), lambda a, r: F.least(a, to(shares, own, r))))


def measured(docs: DataFrame, listed: list[str]) -> DataFrame:
    """``docs`` (text, any others) with the struct column ``m``: counts, chars, and both histograms, in one pass over the text."""

    def of(text: Column, spaced: Column) -> Column:
        words = F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))
        return let(words, lambda w: with_words(text, w, F.length(spaced) - F.greatest(F.size(w) - 1, F.lit(0))))

    def with_words(text: Column, words: Column, word_chars: Column) -> Column:
        return let(
            class_counts(text, word_chars),
            lambda classes: F.struct(
                F.struct(
                    F.size(words).cast("long").alias("n_words"),
                    word_chars.cast("long").alias("word_chars"),
                    F.get(classes, F.lit(4)).cast("long").alias("n_symbols"),
                    repeated_lines(text).cast("long").alias("n_dup_lines"),
                    repeated_words(words).cast("long").alias("n_repeat_words"),
                ).alias("counts"),
                F.length(text).alias("chars"),
                classes.cast("array<double>").alias("classes"),
                common_counts(words, listed).alias("common"),
            ),
        )

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("m", let(text, lambda t: let(one_spaced(t), lambda s: of(t, s))))


def references(counted: DataFrame, listed: list[str]) -> DataFrame:
    """(lang, classes, common) of every language of ``counted`` (lang, m): shares of character classes and common words.

    Summed over all documents with enough words, of languages that have enough of them.
    """
    n_classes, n_common = 7, len(listed) + 1
    enough = counted.where((F.col("m.counts.n_words") >= MIN_COMMON_WORDS) & F.col("lang").isNotNull())
    sums = [F.sum(F.get("m.classes", F.lit(i))).alias(f"c{i}") for i in range(n_classes)]
    sums += [F.sum(F.get("m.common", F.lit(i))).alias(f"w{i}") for i in range(n_common)]
    by_lang = enough.groupBy("lang").agg(F.count("*").alias("n"), *sums).where(F.col("n") >= MIN_LANGUAGE_DOCS)
    shares = lambda x: let(F.greatest(_total(x), F.lit(1.0)), lambda n: F.transform(x, lambda v: v / n))
    histogram = lambda key, n: shares(F.array(*[F.col(f"{key}{i}") for i in range(n)]))
    return by_lang.select("lang", histogram("c", n_classes).alias("classes"), histogram("w", n_common).alias("common"))


def _judged(docs: DataFrame, carry: list[str], common_words: dict[str, str], own: bool = False) -> DataFrame:
    """``quality`` beside the columns ``carry`` of ``docs``, which are called c0, c1 and so on.

    With ``own`` a document whose language has no reference is not compared with those of others.
    """
    listed = vocabulary(common_words)
    rows = docs.select(F.col("text"), F.col("lang"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])
    counted = stored_copy(measured(rows, listed).drop("text"), "measured")
    refs = stored_copy(references(counted, listed), "references")
    known = refs.limit(INLINE_LANGUAGES + 1).collect()
    if len(known) > INLINE_LANGUAGES:
        counted = counted.crossJoin(F.broadcast(refs.agg(*[F.collect_list(c).alias(f"_{c}") for c in refs.columns])))  # one row
        nearest = lambda key: distances_to(F.col(f"m.{key}"), F.col(f"_{key}"))
        has_own = F.array_contains("_lang", F.col("lang"))
    else:
        nearest = lambda key: distances(F.col(f"m.{key}"), [r[key] for r in known])
        has_own = F.col("lang").isin([r["lang"] for r in known])
    judge = F.coalesce(has_own, F.lit(False)) if own else F.lit(True)
    guard = lambda enough, key: F.when(judge & enough, nearest(key)) if known else F.lit(None).cast("double")
    n, repeat = F.col("m.counts.n_words"), F.col("m.counts.n_repeat_words")
    base = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
    far = counted.withColumns(
        {"base": base, "class_far": guard(F.col("m.chars") >= MIN_CLASS_CHARS, "classes"), "common_far": guard(n >= MIN_COMMON_WORDS, "common")}
    )
    near = (F.coalesce("class_far", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (F.coalesce("common_far", F.lit(0.0)) <= MAX_COMMON_DISTANCE)
    verdict = F.struct(
        "m.counts.*",
        F.col("base").alias("base_failed"),
        F.col("class_far").alias("class_distance"),
        F.col("common_far").alias("common_distance"),
        (~F.col("base") & near).alias("kept"),
    )
    return far.select(*[f"c{i}" for i in range(len(carry))], verdict.alias("quality"))


def judged(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), common_words: dict[str, str] = COMMON_WORDS) -> DataFrame:
    """The columns ``carry`` of ``docs`` (doc_id, text, lang, any others) and a struct column ``quality``.

    Fields: the five counts, ``base_failed``, ``class_distance`` and
    ``common_distance`` (NULL below the minimum lengths, or where no language
    has a reference) and ``kept``. NULL and empty texts have no words and
    fail the base rule. Rows are judged one by one, so repeated rows stay.
    Texts are read once; what was measured is stored, summed to references,
    and compared with them.
    """
    return _judged(docs, list(carry), common_words).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "quality")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were.

    Only documents whose own language has a reference are judged by distance.
    """
    kept = _judged(docs, docs.columns, COMMON_WORDS, own=True).where("quality.kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
