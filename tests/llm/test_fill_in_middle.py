from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import fill_in_middle as f
from tests.llm.conftest import LONG, awkward, told

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    pre, mid, suf = ("".join(tokens[s]) for s in (slice(a), slice(a, b), slice(b, None)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(tokens), "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, len(tokens), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(tokens), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(3)
    return ["".join(rng.choice(" \t\n\x0b\r\x1c\xa0ab<PSM>é\U0001f600") for _ in range(rng.randrange(90))) for _ in range(400)]


@pytest.fixture(scope="module")
def many(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(1, "a <P> b"), (2, "a <S>"), (3, "<M>"), (4, "x" * 5000), (5, " " * 5000), (6, LONG), (8, LONG)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_against_brute_force(many):
    rows, df = many
    made = f.fill_in_middle(df)
    assert told(made, *made.columns) == sorted((brute(*r) for r in rows), key=repr)
    forms = {r["form"] for r in made.select("form").distinct().collect()}
    assert forms == {"plain", "psm", "spm"}


def test_texts_come_back(many):
    rows, df = many
    back = f.fill_in_middle(df).select("doc_id", f.restored(F.col("output"), F.col("form")).alias("text"))
    assert told(back, "doc_id", "text") == sorted(rows, key=repr)


def test_awkward_rows(docs, no_docs):
    made = f.fill_in_middle(docs)
    assert told(made, *made.columns) == sorted((brute(r[0], r[1]) for r in awkward()), key=repr)
    assert f.fill_in_middle(no_docs).count() == 0


def test_boundaries_are_those_of_the_tokens(monkeypatch):
    for step in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(f, "_STEP", step)
        for text in [*texts()[:100], "", " ", "a", " a ", "a b"]:
            assert f.boundaries(text).tolist() == [0, *np.cumsum([len(t) for t in TOKEN.findall(text)])]


@pytest.mark.parametrize("error", [0, 1, 31, 200])
def test_index_finds_every_offset(error):
    rng = np.random.default_rng(1)
    kinds = [
        np.array([0]), np.arange(500), np.arange(500) * 7, np.cumsum(rng.integers(1, 12, 3000)), np.cumsum(rng.pareto(1, 2000).astype(int) + 1),
        np.r_[np.arange(1000), 10**9 + np.arange(1000) * 3, 10**12],
    ]
    for offsets in kinds:
        index = f.RankIndex(offsets, error)
        assert [index.offset(r) for r in range(len(offsets))] == offsets.tolist()
        assert np.abs(index.missed).max() <= error + 1
    assert len(f.RankIndex(kinds[1], error).starts) == 1 and len(f.RankIndex(kinds[3], 31).starts) < 100


def test_shares_of_the_forms(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'some words to cut' AS text")
    n = {r["form"]: r["count"] for r in f.fill_in_middle(df).groupBy("form").count().collect()}
    assert abs(n["plain"] - 2000) < 150 and abs(n["spm"] - 1600) < 150 and abs(n["psm"] - 400) < 80
    assert {r["form"] for r in f.fill_in_middle(df, cut_percent=100, spm_percent=0).select("form").distinct().collect()} == {"psm"}
