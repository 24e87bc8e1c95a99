"""Token ids in binary shards of patched frame-of-reference blocks.

A shard holds the ids of a range of documents, one after the other, cut into
blocks of ``BLOCK`` ids. A block stores its minimum, and each id's difference
from it in as many bits as the ``PERCENTILE`` of the differences needs; larger
differences go to a list of exceptions. Behind the blocks stand the start of
every block, and id, number of ids of every document, so that a reader finds
any id without reading the blocks before it.

    magic | blocks | block starts u64 | doc_ids i64 | has_id u8 | ids per document u64 | trailer
    block: minimum u32, ids u32, exceptions u32, width u8 | packed differences | positions u32 | differences u32
    trailer: blocks u64, documents u64, ids u64, start of the index u64, magic

Shards are written by tasks under names of their own and count only when they
stand in the manifest, which Spark writes from the tasks that succeeded; a task
that is run again leaves an unused file at worst.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.llm.common import stored_copy
from courtside.session import scratch_path, ship_package

MAGIC = b"PFORTOK1"
BLOCK = 4096
PERCENTILE = 0.98
END_ID = 1
# Text to a shard, where Spark's own number of partitions would put more in one.
SHARD_BYTES = 128 << 20
# Characters by which rows that share a doc_id are ordered before their hash is.
ORDER_CHARS = 32
# Pieces of text, and runs within them, whose ids a worker remembers before it starts anew.
REMEMBERED = 400_000
_HEAD = struct.Struct("<IIIB")
_TRAILER = struct.Struct("<QQQQ8s")
_FLUSH = 64


def pack(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of unsigned 32-bit values; there must be one at least."""
    low = int(values.min())
    delta = (values - np.uint32(low)).astype(np.uint32)
    kth = min(len(delta) - 1, int(percentile * len(delta)))
    width = int(np.partition(delta, kth)[kth]).bit_length()
    out = np.flatnonzero(delta >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = ((delta[:, None] >> np.arange(width, dtype=np.uint32)) & 1).astype(np.uint8)
    return b"".join(
        (
            _HEAD.pack(low, len(values), len(out), width),
            np.packbits(bits, bitorder="little").tobytes(),
            out.astype("<u4").tobytes(),
            delta[out].astype("<u4").tobytes(),
        )
    )


def unpack(block: bytes) -> np.ndarray:
    low, n, n_out, width = _HEAD.unpack_from(block)
    at = _HEAD.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(block, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    delta = np.zeros(n, np.uint32)
    for i in range(width):
        delta |= bits[:, i].astype(np.uint32) << np.uint32(i)
    at += size
    places = np.frombuffer(block, "<u4", n_out, at)
    delta[places] = np.frombuffer(block, "<u4", n_out, at + 4 * n_out)
    return delta + np.uint32(low)


class Shard:
    """Writes one shard; ids may come in any number and any pieces."""

    def __init__(self, sink):
        self.sink, self.at = sink, len(MAGIC)
        sink.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.starts: list[int] = []
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= _FLUSH * BLOCK:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for i in range(0, n, BLOCK):
            block = pack(ids[i : min(i + BLOCK, n)])
            self.starts.append(self.at)
            self.sink.write(block)
            self.at += len(block)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.n_waiting)
        self.sink.write(np.array(self.starts, "<u8").tobytes())
        self.sink.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.sink.write(np.array([d is not None for d in self.doc_ids], np.uint8).tobytes())
        self.sink.write(np.array(self.sizes, "<u8").tobytes())
        self.sink.write(_TRAILER.pack(len(self.starts), len(self.doc_ids), self.n_ids, self.at, MAGIC))


class Reader:
    """Reads a shard from a file that can seek."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - _TRAILER.size)
        n_blocks, n_docs, self.n_ids, self.end, magic = _TRAILER.unpack(source.read(_TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        source.seek(self.end)
        index = source.read(8 * n_blocks + 17 * n_docs)
        self.starts = np.frombuffer(index, "<u8", n_blocks)
        ids = np.frombuffer(index, "<i8", n_docs, 8 * n_blocks)
        known = np.frombuffer(index, np.uint8, n_docs, 8 * n_blocks + 8 * n_docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.sizes = np.frombuffer(index, "<u8", n_docs, 8 * n_blocks + 9 * n_docs).astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        stop = int(self.starts[i + 1]) if i + 1 < len(self.starts) else self.end
        self.source.seek(int(self.starts[i]))
        return unpack(self.source.read(stop - int(self.starts[i])))

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on; only their blocks are read."""
        if not count:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK, (start + count - 1) // BLOCK
        found = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return found[start - first * BLOCK :][:count]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) in order; every block is read once."""
        blocks = iter(range(len(self.starts)))
        held, start = np.empty(0, np.uint32), 0
        for doc_id, size in zip(self.doc_ids, self.sizes.tolist()):
            pieces, have = [held], len(held)
            while have < size:
                pieces.append(self.block(next(blocks)))
                have += len(pieces[-1])
            held = np.concatenate(pieces) if len(pieces) > 1 else held
            yield doc_id, start, held[:size]
            held, start = held[size:], start + size


class _Remembered(dict):
    """Results of a function, forgotten all at once when they are too many."""

    def __init__(self, fn):
        super().__init__()
        self.fn = fn

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self.fn(key)
        if len(key) <= 64:
            self[key] = value
        return value


# Pieces whose characters have had the same case and class in every version of
# Unicode, and neither compose nor count as white space.
_PLAIN_PIECE = re.compile("[!-~\xa1-\u024f]+")


class _Packers(dict):
    """Packers of so many unsigned 32-bit integers."""

    def __missing__(self, n: int) -> struct.Struct:
        return self.setdefault(n, struct.Struct(f"<{n}I"))


_INTEGERS = _Packers()


def _byte_letters() -> list[str]:
    """The letter each byte is written as by byte-level tokenizers: printable ones stay, the others follow from 256 on."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in stay else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, by a tokenizer file's content.

    A tokenizer that lower-cases and drops white space gives the ids of a text
    as those of its pieces between spaces and line breaks, and the ids of a
    plain piece as those of the runs its own pattern finds; both are remembered.
    Any other tokenizer encodes the text as a whole.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        made = json.loads(vocabulary)
        self.model = self.tokenizer.model
        self.special = re.compile("|".join(re.escape(t["content"]) for t in made["added_tokens"]) or "(?!)")
        self.pattern = self._pattern(made)
        self.letters = _byte_letters()
        self.pieces, self.runs = _Remembered(self._piece), _Remembered(self._run)

    @staticmethod
    def _pattern(made: dict) -> regex.Pattern | None:
        """The pattern of the pre-tokenizer, if the file drops white space and is byte-level."""
        kinds = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            return None
        split, level = steps
        if split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
            return None
        pattern = regex.compile(split["pattern"]["Regex"])
        as_runs = pattern.findall("abcé,") == ["abcé", ","] and pattern.findall("z.") == ["z", "."]
        return pattern if as_runs and not pattern.search(" \n") else None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        word = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
        return _INTEGERS[len(tokens := self.model.tokenize(word))].pack(*[t.id for t in tokens])

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        low = piece.lower()
        if not _PLAIN_PIECE.fullmatch(low) or self.special.search(piece):
            return self._whole(piece)
        if low.isalpha():
            return self.runs[low]
        if low[-1] in ",." and low[:-1].isalpha():
            return self.runs[low[:-1]] + self.runs[low[-1]]
        return b"".join(map(self.runs.__getitem__, self.pattern.findall(low)))

    def ids(self, text: str) -> np.ndarray:
        if self.pattern is None:
            return np.frombuffer(self._whole(text), "<u4")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" "))), "<u4")


_known: dict[int, Encoder] = {}


def encode(text: str | None, vocabulary: str, end_id: int = END_ID) -> np.ndarray:
    """Ids of a text and the end id; ``vocabulary`` is the tokenizer file's content."""
    key = hash(vocabulary)
    if key not in _known:
        _known[key] = Encoder(vocabulary)
    return np.append(_known[key].ids(text or ""), np.uint32(end_id))


def _place(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))


def by_id() -> list[Column]:
    """Ascending order of doc_id, NULL first; rows that share one, or have none, by the start of their texts, then by a hash of them."""
    return [F.col("doc_id").asc_nulls_first(), F.substring("text", 1, ORDER_CHARS).asc_nulls_first(), F.xxhash64("text").asc()]


def write_shards(
    docs: DataFrame, folder: str, vocabulary_path: str, end_id: int = END_ID, order: list[Column] | None = None, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Write ``docs`` (doc_id, text, any others) as shards below ``folder``; returns the manifest.

    shard (their order), path, n_docs, n_ids. Documents are in the given
    ``order`` of columns over all shards, or in that of :func:`by_id`. Splitting by
    range gives every task a bounded stretch, also of rows without doc_id, and
    a task holds some blocks at a time. Shards are as many as there are
    ``shard_bytes`` of text, where that is more than Spark's own number.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())  # one file of a few MB
    place = folder if "://" in folder else f"file://{folder}"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = sink = path = None
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                if shard is None:
                    files, base = _place(place)
                    files.create_dir(base, recursive=True)
                    path = f"{place}/{uuid.uuid4().hex}.pfor"
                    sink = files.open_output_stream(_place(path)[1])
                    shard = Shard(sink)
                shard.add(doc_id.as_py(), encode(text.as_py(), vocabulary.value, end_id))
        if shard is not None:
            shard.close()
            sink.close()
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([number], pa.int32()), "path": [path], "n_docs": pa.array([len(shard.doc_ids)], pa.int64()), "n_ids": pa.array([shard.n_ids], pa.int64())}
            )

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = by_id() if order is None else order
    number = -(-size // shard_bytes)
    ranged = (docs.repartitionByRange(number, *order) if number > usual else docs.repartitionByRange(*order)).sortWithinPartitions(*order, "text")
    return stored_copy(ranged.select("doc_id", "text").mapInArrow(write, "shard int, path string, n_docs long, n_ids long"), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document, from the files.

    Shards are numbered by range, so one running sum over their sizes, a row
    per shard, gives where each begins.
    """
    ship_package(manifest.sparkSession)
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begun = manifest.select("path", "shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, at = _place(path)
                with files.open_input_file(at) as source:
                    rows = [(doc_id, start + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc_id, s, ids in Reader(source, source.size()).documents()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = manifest.sparkSession.sparkContext.defaultParallelism
    dealt = begun.select("path", "start").repartition(max(shards, manifest.count()))
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, vocabulary_path: str, folder: str | None = None, order: list[Column] | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text, any others) to shards and read them back: doc_id, start, n_tokens, ids_crc32 per row.

    Rows stand in the files in the given ``order``, else in that of
    :func:`by_id`. NULL and empty texts are the end id alone, rows that repeat are rows of their own,
    and an empty table gives no shard and no rows.
    """
    spark: SparkSession = docs.sparkSession
    return read_shards(write_shards(docs, folder or scratch_path(spark, "tokens"), vocabulary_path, order=order))
