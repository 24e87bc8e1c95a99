"""License scan by a positional index of rare words.

The index holds, for each word of the license templates, its postings
(template, position) and its inverse document frequency over the templates. In
a file the license words present are looked up from the rarest on. Each
occurrence votes for (template, offset): words that stand at the same relative
position as in the template vote for the same offset. A template is found when
enough of its words vote for one offset and its mandatory key phrases stand in
the file word by word.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame

from courtside.llm.common import each_text

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

# Phrases that are labels by themselves.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening or notice sentences of common licenses, with the
# phrases that must stand word by word.
TEMPLATES = {
    "mit": ("released under the mit license", ["mit license"]),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ["permission is hereby granted free of charge"],
    ),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license"]),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2", ["general public license version 2"]),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ["general public license version 3"]),
    "lgpl": ("licensed under the gnu lesser general public license", ["lesser general public license"]),
    "agpl": ("licensed under the gnu affero general public license", ["affero general public license"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    "cc-by-sa": ("licensed under a creative commons attribution sharealike license", ["creative commons attribution sharealike"]),
    "cc-by-nc": ("licensed under a creative commons attribution noncommercial license", ["creative commons attribution noncommercial"]),
    "cc0": ("to the extent possible under law the author has waived all copyright", ["waived all copyright"]),
}

# The share of a template's words that must agree.
MIN_SHARE = 0.6


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER) if text and not text.isascii() else (text or "").lower())


@dataclass
class Index:
    """Postings and weights of template words; phrases with their labels."""

    templates: dict[str, list[str]]
    phrases: dict[str, list[list[str]]]
    labels: dict[str, str]
    base: frozenset
    postings: dict[str, list[tuple[str, int]]]
    weight: dict[str, float]

    @staticmethod
    def build(templates=None, base_phrases=None) -> Index:
        templates = TEMPLATES if templates is None else templates
        base_phrases = BASE_PHRASES if base_phrases is None else base_phrases
        texts = {name: words_of(text) for name, (text, _) in templates.items()}
        keys = {name: [words_of(k) for k in need] for name, (_, need) in templates.items()}
        labels = {name: name for name in templates}
        for phrase, label in base_phrases.items():
            name = f"phrase {phrase}"
            texts[name], keys[name], labels[name] = words_of(phrase), [words_of(phrase)], label
        postings: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for name, words in texts.items():
            for i, w in enumerate(words):
                postings[w].append((name, i))
        in_templates = {w: len({t for t, _ in places}) for w, places in postings.items()}
        weight = {w: math.log(len(texts) / n) + 1.0 for w, n in in_templates.items()}
        base = frozenset(f"phrase {p}" for p in base_phrases)
        return Index(texts, keys, labels, base, dict(postings), weight)

    def rare(self, name: str, count: int = 2) -> list[str]:
        """The template's rarest words, of which a file must have one."""
        return sorted(set(self.templates[name]), key=lambda w: (-self.weight[w], w))[:count]


@dataclass
class Found:
    n_words: int
    places: list[int]
    base: set
    labels: set
    score: float


class Scanner:
    def __init__(self, index: Index):
        self.index = index
        # Only words that are among the rarest of some template start a look-up.
        self.triggers = frozenset(w for name in index.templates for w in index.rare(name))
        self.base_rare = {name: index.rare(name, 1)[0] for name in index.base}

    def scan(self, text: str | None) -> Found:
        """Labels of one text. Nothing is found in NULL and empty texts."""
        words = words_of(text)
        found = Found(len(words), [], set(), set(), 0.0)
        present = self.triggers.intersection(words)
        if not present:
            return found
        at: dict[str, list[int]] = {w: [] for w in self.index.postings}
        for i, w in enumerate(words):
            if w in at:
                at[w].append(i)
        for name, rare in self.base_rare.items():
            if rare in present:
                places = self._places(words, at, self.index.templates[name])
                if places:
                    found.places += places
                    found.base.add(self.index.labels[name])
                    found.score = 1.0
        looked_up = sorted(present, key=lambda w: (-self.index.weight[w], w))
        candidates = {t for w in looked_up for t, _ in self.index.postings[w] if t not in self.index.base}
        for name in candidates:
            share = self._share(name, at)
            if share >= MIN_SHARE and all(self._places(words, at, k) for k in self.index.phrases[name]):
                found.labels.add(self.index.labels[name])
                found.score = max(found.score, share)
        found.labels |= found.base
        return found

    def _share(self, name: str, at: dict[str, list[int]]) -> float:
        """The largest share of the template's words at one relative position."""
        template = self.index.templates[name]
        votes = Counter(p - i for i, w in enumerate(template) for p in at[w])
        return max(votes.values(), default=0) / len(template)

    def _places(self, words: list[str], at: dict[str, list[int]], phrase: list[str]) -> list[int]:
        """All starts at which the phrase's words stand consecutively, by its rarest word."""
        k = min(range(len(phrase)), key=lambda i: len(at.get(phrase[i], ())))
        starts = (p - k for p in at.get(phrase[k], ()))
        return [s for s in starts if s >= 0 and words[s : s + len(phrase)] == phrase]


COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def license_scan(docs: DataFrame, templates=None, base_phrases=None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others).

    n_words, n_base (places of base phrases), first_word and last_word (their
    smallest and largest start, else NULL), base_labels, labels, score (share
    of the best template's words found at one relative position; 1 for a base
    phrase; 0 if nothing is found). NULL is an empty text; repeated rows give
    repeated results; an empty table gives none.
    """
    index = Index.build(templates, base_phrases)
    scanner = Scanner(index)

    def row(doc_id, text):
        f = scanner.scan(text)
        places = f.places
        return (
            doc_id,
            f.n_words,
            len(places),
            min(places) if places else None,
            max(places) if places else None,
            ",".join(sorted(f.base)),
            ",".join(sorted(f.labels)),
            f.score,
        )

    return each_text(docs, row, ["doc_id", "text"], COLUMNS)
