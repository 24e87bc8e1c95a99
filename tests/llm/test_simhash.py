from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from courtside.llm import simhash
from tests.llm.conftest import UPPER, awkward, space_words, told


def brute_fingerprint(text):
    words = space_words((text or "").translate(UPPER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def brute_classes(prints):
    """Smallest reachable node of each, over all pairs."""
    values = sorted(set(prints))
    a = np.array(values, np.int64).view(np.uint64)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4):
            x, y = find(v), find(values[i + 1 + j])
            root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprints_by_brute_force():
    for row in awkward():
        assert simhash.fingerprint(row[1]) == brute_fingerprint(row[1])


def some_prints():
    """Far ones, chains of four bits, a crowd around one centre, and the ends of the number range."""
    rng = random.Random(3)
    out = [rng.getrandbits(64) for _ in range(400)] + [0, (1 << 64) - 1, 1 << 63, 15, 255]
    for start in out[:20]:
        x = start
        for _ in range(6):
            for bit in rng.sample(range(64), 4):
                x ^= 1 << bit
            out.append(x)
    centre = rng.getrandbits(64)
    for _ in range(300):
        x = centre
        for bit in rng.sample(range(64), rng.randrange(7)):
            x ^= 1 << bit
        out.append(x)
    return [x - (1 << 64) if x >> 63 else x for x in set(out)]


@pytest.mark.parametrize("point_rows", [16, 4096])
def test_links_reach_what_all_pairs_reach(spark, point_rows):
    prints = some_prints()
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = simhash.links(fps, point_rows=point_rows)
    edges = found.collect()
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 4 for r in edges)
    got = {r["node"]: r["root"] for r in simhash.components(found).collect()}
    want = brute_classes(prints)
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    found = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(docs, no_docs):
    found = simhash.near_duplicates(docs)
    prints = [(r[0], brute_fingerprint(r[1])) for r in awkward()]
    root = brute_classes([p for _, p in prints])
    smallest = {}
    for i, p in prints:
        if i is not None:
            smallest[root[p]] = min(smallest.get(root[p], i), i)
    want = sorted(((i, p, smallest.get(root[p])) for i, p in prints), key=repr)
    assert told(found, "doc_id", "fp", "component_id") == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_different_texts_with_one_id_or_none_stay(spark):
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    rows = [(1, text(0)), (1, text(1)), (2, text(1)), (None, text(2)), (None, text(2)), (None, text(3)), (None, text(0))]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["text"] for r in kept.collect()} == {text(k) for k in range(4)} and kept.count() == 4


def test_one_document_of_each_group_stays(docs, no_docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    known = [i for i in ids if i is not None]
    found = simhash.near_duplicates(docs).where("doc_id is not null").groupBy("component_id").agg(F.min("doc_id")).collect()
    assert sorted(known) == sorted(r[1] for r in found) and ids.count(None) == 2
    assert simhash.drop_near_duplicates(no_docs).count() == 0
