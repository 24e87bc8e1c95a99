"""Documents with everything that is awkward, and brute-force answers."""

from __future__ import annotations

import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality string, m string, fp string, position double, _k1 long, k1 long, doc string, _position int, spans string, t1 long, at int"
LONG = " ".join(f"word{i % 977} the of {i}" for i in range(12_000))
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall((text or "").translate(UPPER))


def space_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def awkward():
    """Null, empty and blank texts, a very long one, copies, repeated rows, odd white space, nulls in every column."""
    texts = [
        None, "", " \t\n", "one", "\xa0", "One\x0btwo\x0cthree\r\nfour  five six ", "..!?..", LONG, "é É ß ñandú İstanbul \U0001f600 x",
        "same text here and there " * 12, "same text here and there " * 12, "a\nb\na\n\nb\n \na", "ab " * 300, "A line.\nA line.\nOther | line",
    ]
    rows = [(i, t, ("en", "fr", None)[i % 3], (None, "a", "b", "é")[i % 4], None if i % 2 else 5, "q", "m", "f", 0.5, 1, 2, "d", 3, "s", 4, 5) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "without an id, five words more", *[None] * 14), (None,) * 16]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def told(df, *columns):
    """Rows as tuples, in an order that does not depend on NULL."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
