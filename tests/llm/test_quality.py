from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from courtside.llm import quality as q
from tests.llm.conftest import awkward, space_words, told


def brute(text):
    words = space_words(text)
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_by_brute_force(docs):
    rows = [(r["doc_id"], *(r["quality"][c] for c in COUNTS)) for r in q.judged(docs).collect()]
    assert sorted(rows, key=repr) == sorted(((r[0], *brute(r[1])) for r in awkward()), key=repr)


def test_repeats_of_many_shapes(spark):
    shapes = ["a b c d e a b c d e", "a b c d e f a b c d e", "x " * 9, "a b c d e " * 3 + "z", "a b c d a b c d", "p a b c d e q a b c d e r a b c d f"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(shapes)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["quality"]["n_repeat_words"] for r in q.judged(df).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(shapes)}


def distance(p, r):
    p, r = [x / max(sum(p), 1) for x in p], [x / sum(r) for x in r]
    m = [(x + y) / 2 for x, y in zip(p, r)]
    part = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return math.sqrt(max(0.0, (part(p) + part(r)) / 2))


def test_distance_is_that_of_the_definition(spark):
    known = [[0.5, 0.25, 0.25, 0.0], [0.1, 0.1, 0.1, 0.7]]
    rows = [([1.0, 2.0, 3.0, 4.0],), ([0.0, 0.0, 0.0, 9.0],), ([2.0, 1.0, 1.0, 0.0],)]
    df = spark.createDataFrame(rows, "c array<double>")
    got = [r[0] for r in df.select(q.distances(df["c"], known)).collect()]
    assert got == pytest.approx([min(distance(r[0], k) for k in known) for r in rows], abs=1e-9)


def clean(i):
    rng = random.Random(i)
    made = lambda: "".join(rng.choice("st er in ou la me ri on de ta".split()) for _ in range(rng.randrange(2, 4)))
    return " ".join(rng.choice("the of and to in that for is".split()) if k % 3 else made() for k in range(120)) + "."


def test_texts_unlike_any_language_go_and_the_others_stay(spark):
    rows = [(i, clean(i), "en") for i in range(60)]
    rows += [(100, " ".join(f"{w}$$$ {w}###%%%" for w in clean(100).split()), "en"), (101, " ".join(f"{chr(97 + k % 26)}q{k}zz |" for k in range(200)), "en")]
    rows += [(102, clean(102), None), (103, "Short but with $$$ %%% ### in its ten words, all fine now", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in q.judged(df).where("quality.kept").collect()}
    assert kept == {*range(60), 102, 103}


def test_rows_that_stay_are_as_they_were(docs, no_docs):
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = {r[0]: tuple(r) for r in awkward()}
    assert all(tuple(r) == rows[r["doc_id"]] for r in kept.where("doc_id is not null").collect())
    assert told(kept, "doc_id")[0] in told(docs, "doc_id") and q.keep_good(no_docs).count() == 0


def test_languages_without_a_reference_are_not_judged_by_others(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("абвгдежзиклмнопрст") for _ in range(6))
    rows = [(i, clean(i), "en") for i in range(30)] + [(100 + k, " ".join(word() for _ in range(90)), lang) for k, lang in enumerate(["ru", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in q.keep_good(df).collect()} == {*range(30), 100, 101}


def test_references_in_a_joined_row_judge_alike(spark, monkeypatch):
    rows = [(i, clean(i), "en" if i % 2 else "xx") for i in range(60)] + [(100, " ".join(f"{w}$$$ {w}###%%%" for w in clean(100).split()), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told_of = lambda: {r["doc_id"]: (r["quality"]["kept"], round(r["quality"]["class_distance"], 9)) for r in q.judged(df).collect()}
    inline = told_of()
    monkeypatch.setattr(q, "INLINE_LANGUAGES", 1)
    assert told_of() == inline and not inline[100][0]


def test_no_python_in_the_plan(docs):
    plan = q.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
