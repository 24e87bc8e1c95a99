from __future__ import annotations

import random
import zlib

from courtside.llm import language_id as l
from courtside.llm.common import read
from tests.conftest import FOLDER
from tests.llm.conftest import awkward

SYLLABLES = {"en": "th ing er on wh ly", "de": "sch ung ein ver keit ü", "fr": "eau oi ç tion ê aux", "es": "ción mente ñ ll os ar", "xx": "zq qz xk kx vv jj"}


def made(lang, rng, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows(seed=1, n=60):
    rng = random.Random(seed)
    return [(k * 1000 + i, made(lang, rng), lang) for k, lang in enumerate(SYLLABLES) for i in range(n)]


def table(spark, some):
    return spark.createDataFrame(some, "doc_id long, text string, lang string")


def test_families_come_first():
    tree = l.Tree(["de", "en", "es", "fr", "xx"])
    assert tree.nodes == {"family germanic": ["language de", "language en"], "family romance": ["language es", "language fr"], "all": ["family germanic", "language xx", "family romance"]}


def test_groups_of_many_families():
    import numpy as np

    rng = np.random.default_rng(1)
    names = [f"l{i:03}" for i in range(300)]
    tree = l.Tree([*names, "de", "en"], {n: rng.random(l.FEATURES) for n in names})
    assert max(map(len, tree.nodes.values())) <= l.BRANCH and sorted(tree.under["all"]) == sorted([*names, "de", "en"])
    below = [n for ns in tree.nodes.values() for n in ns]
    assert sorted(n for n in below if n.startswith("language")) == sorted(f"language {n}" for n in [*names, "de", "en"]) and len(below) == len(set(below))


def test_three_hundred_languages_are_learned(spark):
    """Each made language has syllables of its own; twelve rows of each."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    syllables = {f"l{k:03}": ["".join(rng.choice(letters) for _ in range(4)) for _ in range(6)] for k in range(300)}
    text = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(2)) for _ in range(30))
    some = [(k * 100 + i, text(lang), lang) for k, lang in enumerate(syllables) for i in range(12)]
    found = l.identify(table(spark, some)).where("held_out").collect()
    lang = {r[0]: r[2] for r in some}
    assert len(found) > 500 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in found) >= 0.95 * len(found)
    assert len({r["lang_pred"] for r in found}) > 250


def test_held_out_accuracy(spark):
    found = l.identify(table(spark, rows())).collect()
    lang = {r[0]: r[2] for r in rows()}
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert len(held) > 30 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_accuracy_on_the_test_tables(spark):
    docs = read(spark, FOLDER, "documents")
    found = l.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.95 * len(found)


def test_predictions_do_not_read_the_labels(spark):
    some = rows()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    other = [(i, t, "zz" if held(i) else lang) for i, t, lang in some]
    told = lambda x: {(r["doc_id"], r["lang_pred"], r["score"]) for r in l.identify(table(spark, x)).collect()}
    assert told(some) == told(other)


def test_nothing_to_tell(spark, docs, no_docs):
    model = l.train(table(spark, rows()))
    found = {r["doc_id"]: r for r in l.identify(docs, model).collect()}
    for i in (0, 1, 2, 4, 6):
        assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0
    assert found[3]["lang_pred"] in SYLLABLES and found[None]["held_out"]
    assert l.identify(docs, model).count() == len(awkward())
    assert l.identify(no_docs).count() == 0
    alone = l.identify(table(spark, [(i, "word here", "en") for i in range(9)])).collect()
    assert {r["lang_pred"] for r in alone} == {"en"}
    unlabelled = l.identify(table(spark, [(1, "word here", None)])).first()
    assert (unlabelled["lang_pred"], unlabelled["score"]) == ("und", 0.0)
