from __future__ import annotations

import pytest

from courtside.llm import decontamination as d
from tests.llm.conftest import awkward, plain_words, told

ITEMS = [
    (1, " ".join(f"q{i}" for i in range(20))), (2, "Q3 q4 q5 q6 q7 q8 q9 q10 q11 q12 q13 q14 q15 other end"), (3, "short item"), (4, None), (5, "..."),
    (6, "alone"), (6, "alone"), (7, "word1 the of 1 word2 the of 2 word3 the of 3 word4 the"),
]


def brute(text, items=ITEMS):
    grams = {}
    for item, t in items:
        w = plain_words(t)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if w else ():
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    words, hit, found = plain_words(text), set(), set()
    for n in {len(g) for g in grams}:
        for i in range(len(words) - n + 1):
            g = tuple(words[i : i + n])
            if g in grams:
                hit.update(range(i, i + n))
                found |= grams[g]
    return len(words), len(hit), len(found), sorted(found), 0 < len(hit) and 20 * len(hit) >= len(words)


EXTRA = [
    (100, "Intro. " + ITEMS[0][1].upper() + " outro"), (101, "q0 " * 40), (102, "a short item and an alone one " + "x " * 500), (103, "alone"),
    (104, " ".join(f"q{i}" for i in range(3, 16))), (105, " ".join(f"q{i}" for i in range(12))),
]


@pytest.mark.parametrize(("max_set", "max_sent"), [(d.MAX_SET, d.MAX_SENT), (0, d.MAX_SENT), (0, 0)])
def test_hits_by_brute_force(spark, docs, max_set, max_sent):
    rows = [(r[0], r[1]) for r in awkward()] + EXTRA
    table = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = d.contamination(table, items, max_set=max_set, max_sent=max_sent)
    got = told(found, "doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated")
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_nothing_to_compare_with(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {tuple(r) for r in d.contamination(docs, none).select("n_hit", "contaminated").collect()} == {(0, False)}
    assert d.contamination(docs, none).count() == docs.count()
    assert d.contamination(no_docs, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_clean_rows_stay_as_they_were(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = d.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    want = sorted((r for r in awkward() if not brute(r[1])[4]), key=repr)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == want


def test_rows_that_share_an_id_do_not_touch_each_other(spark):
    bad = f"before {ITEMS[0][1]} after"
    rows = [(1, bad, "a"), (1, "clean", "b"), (None, bad, "c"), (None, "clean", "d"), (1, "clean", "b"), (2, None, "e"), (2, bad, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, t1 string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert told(d.drop_contaminated(df, items), "doc_id", "text", "t1") == sorted((r for r in rows if r[1] != bad), key=repr)
    want = [(i, {bad: "before after", None: ""}.get(t, t)) for i, t, _ in rows]
    assert told(d.remove_spans(df, items), "doc_id", "text") == sorted(want, key=repr)


def test_spans_are_cut_out(spark):
    rows = spark.createDataFrame([(1, f"before {ITEMS[0][1]} after"), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert told(d.remove_spans(rows, items), "doc_id", "text") == [(1, "before after"), (2, "clean")]


def test_no_python_in_the_plan(spark, docs):
    plan = d.contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
