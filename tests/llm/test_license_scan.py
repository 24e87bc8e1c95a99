from __future__ import annotations

from courtside.llm.license_scan import BASE_PHRASES, Index, Scanner, license_scan
from tests.llm.conftest import awkward, plain_words, told


def brute(text):
    words, places, labels = plain_words(text), [], set()
    for phrase, label in BASE_PHRASES.items():
        want = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "All rights reserved. (C) all Rights  RESERVED",
    "CC-BY 4.0, cc by cc by",
    "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "general public general public license license",
    "Licensed under the Apache License, Version 2.0.",
    "the apache helicopter has a version 2 0 license under it",
    "rights reserved all rights",
]


def test_base_places_by_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    found = license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = told(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_templates_by_relative_position():
    scan = Scanner(Index.build()).scan
    assert scan(TEXTS[2]).labels == {"mit"} and scan(TEXTS[3]).labels == {"gpl", "gpl-3.0"} and scan(TEXTS[5]).labels == {"apache-2.0"}
    assert scan(TEXTS[6]).labels == set() and scan(TEXTS[6]).score == 0
    moved = scan("word " * 500 + TEXTS[5])
    assert moved.labels == {"apache-2.0"} and moved.score == 1.0
    # Most of the words at their places, but not the key phrase.
    assert scan("licensed under the apache public version 2 0").labels == set()
    assert 0.6 <= scan("licensed beneath the apache license version 2").score < 1


def test_all_license_words_of_a_text_are_looked_up():
    templates = {f"t{i}": (f"rare{i}a rare{i}b shared words", [f"rare{i}a rare{i}b"]) for i in range(120)}
    scan = Scanner(Index.build(templates)).scan
    assert scan(" . ".join(text for text, _ in templates.values())).labels == set(templates)


def test_awkward_rows(docs, no_docs):
    got = told(license_scan(docs), "doc_id", "n_words", "n_base", "labels", "score")
    assert got == sorted(((r[0], len(plain_words(r[1])), 0, "", 0.0) for r in awkward()), key=repr)
    assert license_scan(no_docs).count() == 0
