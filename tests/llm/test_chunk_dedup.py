from __future__ import annotations

import random

from courtside.llm import chunk_dedup as c
from tests.conftest import FOLDER
from tests.llm.conftest import awkward, space_words, told


def text_of(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def test_chunks_are_the_words_in_order():
    for row in awkward():
        digests, words = c.chunks(row[1])
        assert len(digests) == len(words) and sum(words) == len(space_words(row[1])) and all(w > 0 for w in words)


def test_gear_is_the_sum_over_the_window():
    import numpy as np

    data = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    want = [sum(int(c._GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) % (1 << 16) for i in range(300)]
    assert c.gear(data).tolist() == want


def test_long_texts_are_cut_as_in_one_piece(monkeypatch):
    text = text_of(random.Random(2), 3000)
    whole = c.chunks(text)
    monkeypatch.setattr(c, "_STEP", 1000)
    assert [a.tolist() for a in c.chunks(text)] == [a.tolist() for a in whole]


def test_insertions_move_no_other_boundary():
    rng = random.Random(4)
    a, b = text_of(rng, 400), text_of(rng, 7)
    words = a.split()
    one, two = set(c.chunks(a)[0].tolist()), set(c.chunks(" ".join([*words[:200], b, *words[200:]]))[0].tolist())
    assert len(one - two) <= 4


def test_shared_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(5)
    passages = [text_of(rng, 51) for _ in range(60)]
    rows = [(i, text_of(rng, rng.randrange(5, 300))) for i in range(200)]
    holders = set()
    for k, p in enumerate(passages):
        for copy in range(2):
            i = 1000 + 2 * k + copy
            rows.append((i, f"{text_of(rng, rng.randrange(40))} {p} {text_of(rng, rng.randrange(40))}"))
            holders.add(i)
    found = c.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = {r["doc_id"] for r in found}
    assert not ids & set(range(200)) and len(ids) >= 0.97 * len(holders)
    assert all(r["removed_words"] == r["n_words"] if r["doc_id"] % 2 else r["removed_words"] < c.MIN_WORDS for r in found)


def test_no_chunk_grows_in_texts_that_repeat():
    rng = random.Random(8)
    for _ in range(60):
        one = text_of(rng, rng.randrange(1, 9)).split()
        assert max(c.chunks(" ".join((one * 500)[:500]))[1]) <= c.CUT_WORDS


def test_passages_of_repeated_words_phrases_and_lines_are_found(spark):
    rng = random.Random(9)
    rows, n = [], 0
    for length in (51, 60, 100, 500):
        for period in (1, 2, 3, 5, 8, 12):
            for _ in range(4):
                p = " ".join((text_of(rng, period).split() * length)[:length])
                for _ in range(2):
                    rows.append((n, f"{text_of(rng, 60)} {p} {text_of(rng, 60)}"))
                    n += 1
    found = c.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == set(range(n))


def test_passages_are_reported_from_their_first_word_to_their_last(spark):
    rng = random.Random(10)
    rows, want = [], set()
    for k, n in enumerate([16, 25, 40, 49, 50, 51, 52, 70, 300] * 6):
        p = text_of(rng, n)
        for i in (2 * k, 2 * k + 1):
            at = rng.randrange(1, 60)
            rows.append((i, f"{text_of(rng, at)} {p} {text_of(rng, rng.randrange(1, 60))}"))
            if n > 50:
                want.add((i, at, n, n if i % 2 else 0))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in c.repeated_passages(df).collect()} == want
    left, cut = dict(told(c.remove_repeats(df), "doc_id", "text")), {i: (at, n) for i, at, n, gone in want if gone}
    for i, text in rows:
        at, n = cut.get(i, (0, 0))
        assert left[i].split() == text.split()[:at] + text.split()[at + n :]


def test_shorter_passages_are_left(spark):
    rng = random.Random(7)
    rows = []
    for k in range(40):
        p = text_of(rng, 25)
        rows += [(2 * k + c, f"{text_of(rng, 30)} {p} {text_of(rng, 30)}") for c in range(2)]
    found = c.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.count() == 0
    assert c.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), passage_words=20, min_words=6).select("doc_id").distinct().count() > 70


def brute(rows, n=51):
    """{(doc_id, text): {start: first document}} of all windows that different documents have."""
    owner = lambda i, t: (1, t) if i is None else (0, i)
    holders = {}
    for i, t in rows:
        w = space_words(t)
        for k in range(len(w) - n + 1):
            holders.setdefault(tuple(w[k : k + n]), set()).add(owner(i, t))
    out = []
    for i, t in set(rows):
        w, end = space_words(t), -1
        spans = []
        for k in range(len(w) - n + 1):
            if len(holders[tuple(w[k : k + n])]) > 1:
                if k >= end:
                    spans.append([k, 0])
                end = k + n
                spans[-1][1] = end - spans[-1][0]
        out += [(i, a, b) for a, b in spans]
    return sorted(out, key=repr)


def test_passages_by_brute_force_on_the_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = told(c.repeated_passages(spark.read.parquet(f"{FOLDER}/documents.parquet")), "doc_id", "start_word", "n_words")
    assert found == brute(rows) and len(found) > 20


def test_small_packs_and_ranges(spark, monkeypatch):
    rng = random.Random(12)
    parts = [text_of(rng, 70) for _ in range(12)]
    rows = [(rng.choice([None, i, i, i % 7]), " ".join(rng.choice([text_of(rng, 20), rng.choice(parts)]) for _ in range(rng.randrange(6)))) for i in range(200)]
    rows += rows[:20] + [(1000 + i, t) for i, (_, t) in enumerate(rows[:30])] + [(None, rows[3][1])]
    monkeypatch.setattr(c, "RANGE", 50)
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, spans string, key int").repartition(6)
    assert told(c.repeated_passages(df), "doc_id", "start_word", "n_words") == brute(rows)


def test_rows_without_an_id_are_documents_of_their_own(spark):
    rng = random.Random(13)
    p, own = text_of(rng, 60), [text_of(rng, 20) for _ in range(4)]
    rows = [(None, f"{own[0]} {p}"), (None, f"{own[1]} {p}"), (None, f"{own[1]} {p}"), (5, f"{own[2]} {p}"), (5, own[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(5, 20, 60, 0), (None, 20, 60, 60), (None, 20, 60, 60)]
    assert told(c.repeated_passages(df), "doc_id", "start_word", "n_words", "removed_words") == want
    left = told(c.remove_repeats(df), "doc_id", "text")
    assert left == sorted([(None, own[0]), (None, own[1]), (None, own[1]), (5, rows[3][1]), (5, own[3])], key=repr)


def test_numbers_come_back_from_few_bytes():
    import numpy as np

    rng = np.random.default_rng(1)
    arrays = [np.sort(rng.integers(-(2**62), 2**62, 1000)), np.empty(0, np.int64), rng.integers(0, 300, 5000), np.array([-(2**63), 2**63 - 1])]
    data = c.squeezed(*arrays)
    assert [a.tolist() for a in c.unsqueezed(data, 4)] == [a.tolist() for a in arrays] and len(data) < 1000 * 8 + 5000 * 2.2


def test_repeats_are_removed_but_for_the_first(spark):
    rng = random.Random(6)
    p, own = text_of(rng, 80), [text_of(rng, 30) for _ in range(3)]
    rows = [(i, f"{own[i]} {p}") for i in range(3)] + [(9, None)]
    left = dict(told(c.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text"))
    assert left[0] == rows[0][1] and left[9] is None
    for i in (1, 2):
        assert left[i].startswith(own[i][:60]) and len(left[i].split()) < 60


def test_awkward_rows(docs, no_docs):
    found = told(c.repeated_passages(docs), "doc_id", "start_word", "n_words", "removed_words")
    assert found == [(10, 0, 60, 60), (9, 0, 60, 0)]
    assert c.repeated_passages(no_docs).count() == 0
