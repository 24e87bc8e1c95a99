from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courtside.llm import token_files as t
from tests.llm.conftest import awkward

VOCABULARY = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
WHOLE = Tokenizer.from_str(VOCABULARY)
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50_000), st.integers(0, 2**32 - 1)), min_size=1, max_size=300), st.floats(0, 1))
def test_blocks_come_back(values, percentile):
    ids = np.array(values, np.uint32)
    assert t.unpack(t.pack(ids, percentile)).tolist() == values


def test_outliers_do_not_widen_a_block():
    ids = np.array([7] * 4000 + [2**32 - 1] * 5, np.uint32)
    assert len(t.pack(ids)) < 100


def shard(sizes):
    rng, file = np.random.default_rng(1), io.BytesIO()
    writer, docs = t.Shard(file), []
    for i, n in enumerate(sizes):
        ids = rng.integers(0, 49_408, n).astype(np.uint32)
        docs.append((None if i == 0 else i, ids))
        writer.add(*docs[-1])
    writer.close()
    return docs, t.Reader(io.BytesIO(file.getvalue()), len(file.getvalue()))


@pytest.mark.parametrize("sizes", [[], [1], [0, 3, 0], [t.BLOCK], [5, t.BLOCK * 70 + 3, 1, t.BLOCK - 9, 2]])
def test_shards_come_back(sizes):
    docs, reader = shard(sizes)
    assert [(i, ids.tolist()) for i, _, ids in reader.documents()] == [(i, ids.tolist()) for i, ids in docs]
    every = np.concatenate([ids for _, ids in docs]) if docs else np.empty(0)
    assert reader.n_ids == len(every)
    for start, count in ((0, min(3, len(every))), (len(every) // 2, len(every) // 3), (len(every), 0)):
        assert reader.ids(start, count).tolist() == every[start : start + count].tolist()


def test_only_the_asked_blocks_are_read():
    _, reader = shard([t.BLOCK * 5])
    seen, block = [], reader.block
    reader.block = lambda i: seen.append(i) or block(i)
    reader.ids(t.BLOCK * 2 + 1, 10)
    assert seen == [2]


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        t.Reader(io.BytesIO(b"x" * 100), 100)


TEXTS = ["I\'LL don\'t 'Tis we've", "ß²¼\xa0x\x85y\x1cz\x7f ÀÉ\u0130Å \xad ¡¿ǅ", "".join(map(chr, range(1, 0x260))), "Straße,naïve—x <| |> <|x|>", "", " ", "a\tb\x0bc d", "don't <|endoftext|> x<|startoftext|>y", "É é ́x ﬁ Ǆ Σς İ", "a  \n\n b", "12345 $$$ \U0001f600‍", "x" * 300 + " " + "y" * 90]


def whole(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_give_the_ids_of_the_text():
    vocabulary = open(PATH, encoding="utf-8").read()
    for text in [*TEXTS, *(r[1] for r in awkward())]:
        assert t.encode(text, vocabulary).tolist() == whole(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZé Ñ'sSlLtTdD.,!$1²\n\t\xa0\u0301\u0130<|>"), max_size=30))
def test_any_text_gives_its_ids(text):
    assert t.encode(text, VOCABULARY).tolist() == [*WHOLE.encode(text, add_special_tokens=False).ids, 1]


def test_a_tokenizer_that_keeps_spaces_sees_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary, other = open(path, encoding="utf-8").read(), Tokenizer.from_file(path)
    for text in TEXTS:
        assert t.encode(text, vocabulary).tolist() == [*other.encode(text, add_special_tokens=False).ids, 1]


def test_awkward_rows(docs, no_docs, tmp_path):
    found = [tuple(r) for r in t.token_output(docs, PATH, str(tmp_path / "some")).orderBy("start").collect()]
    rows = sorted(((r[0], r[1]) for r in awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "")[: t.ORDER_CHARS]))
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array(whole(text), "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == want
    assert t.token_output(no_docs, PATH, str(tmp_path / "none")).count() == 0


def test_rows_without_an_id_are_spread_over_the_shards(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('same start of all texts that is long ', id) AS text")
    manifest = t.write_shards(rows.repartition(8), str(tmp_path), PATH, shard_bytes=300_000)
    sizes = sorted(r["n_docs"] for r in manifest.collect())
    assert len(sizes) >= 8 and sum(sizes) == 60_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_documents_stand_in_the_order_asked_for(spark, tmp_path):
    rows = [(i, f"text {i}", (i * 7919) % 1000) for i in range(1000)] + [(None, "x", -1), (5, "y", -2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place int").repartition(5)
    found = t.token_output(df, PATH, str(tmp_path), order=[F.col("place")]).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [r[0] for r in sorted(rows, key=lambda r: r[2])]
