"""The stages against brute force, and the registered queries against their SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from courtside.llm import mixing, quality, registry
from courtside.llm.common import read, stored_copy
from tests.conftest import FOLDER
from tests.llm.conftest import awkward
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_quality import brute as brute_counts
from tests.llm.test_simhash import brute_classes, brute_fingerprint
from tests.oracle import TABLES, _rows, _types, connect


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_agrees_with_its_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, FOLDER).toArrow(), duck.sql(registry.ORACLES[name]).to_arrow_table()
    assert _types(ours) == _types(theirs) and _rows(ours) == _rows(theirs)


def test_the_queries_are_registered():
    assert TABLES and set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLES) <= set(entry.oracle_sql())


def test_stages_by_brute_force(spark):
    docs = read(spark, FOLDER, "documents")
    items = [tuple(r) for r in read(spark, FOLDER, "benchmark").collect()]
    rows = {r["doc_id"]: r for r in docs.collect()}
    seen = docs
    for (name, stage), check in zip(corpus_pipeline.STAGES[:3], ("quality", "copies", "benchmark")):
        before, seen = {r["doc_id"] for r in seen.collect()}, stage(spark, seen, FOLDER).cache()
        after = [r["doc_id"] for r in seen.collect()]
        assert seen.columns == docs.columns and len(set(after)) == len(after) and set(after) <= before, name
        gone = before - set(after)
        if check == "quality":
            judged = {r["doc_id"]: r["quality"]["base_failed"] for r in quality.judged(docs).collect()}
            failed = {i for i in before if brute_counts(rows[i]["text"])[5]}
            assert failed <= gone and failed == {i for i in before if judged[i]}
            # The rest go by distance from their language, which no labelled good document has.
            labels = {r["doc_id"]: r["quality"] for r in read(spark, FOLDER, "labels").collect()}
            assert not [i for i in gone - failed if labels.get(i) == 1] and len(gone - failed) < 0.1 * len(before)
        elif check == "copies":
            prints = {i: brute_fingerprint(rows[i]["text"]) for i in before}
            root, first = brute_classes(prints.values()), {}
            for i in sorted(before):
                first.setdefault(root[prints[i]], i)
            assert set(after) == set(first.values())
        else:
            assert gone == {i for i in before if brute_hits(rows[i]["text"], items)[4]}
    mixed = stored_copy(corpus_pipeline.STAGES[3][1](spark, seen, FOLDER), "mixed")
    assert mixed.columns == docs.columns
    last = corpus_pipeline.STAGES[4][1](spark, mixed, FOLDER)
    # The files hold the curriculum from its first position to its last.
    order = [r["doc_id"] for r in mixing.curriculum(seen, position="at").orderBy("at", "doc_id").collect()]
    assert [r["doc_id"] for r in last.orderBy("start").collect()] == order
    assert order != sorted(order)


def test_training_order_over_many_files(spark):
    rows = [(i, f"w{i} " * (1 + i % 7), "en", "abc"[i % 3], 5) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = stored_copy(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
        last = corpus_pipeline.write_tokens(spark, mixed, "")
        told = [r["doc_id"] for r in last.orderBy("start").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(mixed.inputFiles()) > 3 and told == [r["doc_id"] for r in mixing.curriculum(docs, position="at").orderBy("at", "doc_id").collect()]


def test_rows_that_share_or_lack_an_id_come_through_every_stage(spark, tmp_path):
    words = lambda k: " ".join(f"{'abcdefghij'[(i * k) % 10]}word{k}of{(i * 7 + k) % 83}" for i in range(60))
    item = " ".join(f"benchmark{i}" for i in range(14))
    rows = [(1, words(1)), (1, words(2)), (None, words(3)), (None, words(4)), (1, f"{words(5)} {item}"), (None, f"{item} {words(6)}"), (1, words(1))]
    rows = [(i, t, "en", "a", len(t)) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, want = read(spark, str(tmp_path), "documents"), {words(k) for k in (1, 2, 3, 4)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored_copy(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        assert want <= {r["text"] for r in docs.collect()}, name
    assert {r["text"] for r in docs.collect()} == want
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in last) == ["1", "1", "None", "None"]


def test_run_over_awkward_and_empty_tables(spark, tmp_path):
    schema = read(spark, FOLDER, "documents").schema
    for name, rows in (("odd", [r[:5] for r in awkward()]), ("none", [])):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        read(spark, FOLDER, "benchmark").write.parquet(str(tmp_path / name / "benchmark.parquet"))
        found = corpus_pipeline.run(spark, str(tmp_path / name))
        assert {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(found.columns)
        # Of the awkward rows the long texts without repeats are good.
        assert (found.count() > 0) == (name == "odd")
