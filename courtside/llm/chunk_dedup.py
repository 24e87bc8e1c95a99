"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text. A chunk ends after the word at
whose end the hash is the smallest of some ``CUT_WORDS`` words that follow each
other, ties included. So no chunk is longer than that, whatever the text repeats,
and where chunks end depends on the words around only: text inserted elsewhere
moves no boundary.
Chunks are told apart by a digest of their bytes. A run of neighbouring
chunks that all occur in another document is a candidate: with the words around
it in which boundaries may differ, it holds every passage that goes through it.
The candidates' windows of one word more than ``PASSAGE_WORDS`` are digested and
looked up in other documents, so a passage is reported from its first word to
its last, and only if it is longer than ``PASSAGE_WORDS``.

Digests are looked up in packs: texts are packed with their digests, each pack
sends the digests of a range once, sorted and squeezed, to the task of that range,
and gets back which of them other documents have. A digest that is in many
documents meets as one entry a pack, so no task gets a hot one's rows.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtside.llm.common import each_text, sent_if_small, stored_copy
from courtside.session import ship_package

PASSAGE_WORDS = 50
MIN_WORDS = 16
# Boundaries in the first sixteen bytes of a passage depend on what stands
# before it; so many words fit there.
WINDOW_WORDS = 8
_STEP = 1 << 20
# Digests of a pack (texts are not cut, so one long text may have more), and
# those that meet in one task.
PACK = 1 << 17
RANGE = 1 << 20
# Texts with copies, of some forty bytes each, that are broadcast.
MAX_SENT = 100_000
# Chunks are told apart by so many bits, which is enough for candidates; windows by 64.
CHUNK_BITS = 40
# Gear values: one 16-bit number for each byte, from a fixed generator.
_GEAR = np.random.default_rng(20240501).integers(0, 1 << 16, 256, dtype=np.uint16)


def cut_words(passage_words: int = PASSAGE_WORDS, min_words: int = MIN_WORDS) -> int:
    """Words of the window whose smallest hash ends a chunk.

    The first window behind the sixteen bytes of a passage, and the last one in
    it, have the same smallest hash wherever the passage stands, and so have all
    windows between. The chunks from the one boundary to the other are at least
    ``min_words`` words for windows of this size.
    """
    return max(1, (passage_words + 1 - (WINDOW_WORDS - 1) - min_words) // 2)


CUT_WORDS = cut_words()


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: sum of gear values of the last 16 bytes, each shifted by its age."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width].copy() << np.uint16(width)
    return h


def smallest(hashes: np.ndarray, size: int = CUT_WORDS) -> np.ndarray:
    """Whether each hash is the smallest, or as small, in one of the windows of ``size`` hashes that hold it."""
    n = len(hashes)
    cut = np.zeros(n, bool)
    if n < size:
        return cut
    low = np.lib.stride_tricks.sliding_window_view(hashes, size).min(1)
    for k in range(size):
        here = slice(k, n - size + 1 + k)
        cut[here] |= hashes[here] == low
    return cut


def chunks(text: str | None, size: int = CUT_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each chunk and the number of its words; empty for a text without words.

    Words are joined by one space before, so white space does not matter.
    """
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    data = np.frombuffer(joined, np.uint8)
    hashes = np.empty(len(ends), np.uint16)
    for at in range(0, len(data), _STEP):  # long texts in steps that overlap by the window
        from_byte = max(0, at - 15)
        part = gear(data[from_byte : at + _STEP])
        here = slice(np.searchsorted(ends - 1, at), np.searchsorted(ends - 1, at + _STEP))
        hashes[here] = part[ends[here] - 1 - from_byte]
    cut = smallest(hashes, size)
    cut[-1] = True
    last = np.flatnonzero(cut)
    stops = ends[last].tolist()
    starts = [0, *(s + 1 for s in stops[:-1])]
    digest = xxhash.xxh3_64_intdigest
    digests = np.fromiter((digest(joined[a:b]) for a, b in zip(starts, stops)), np.uint64, len(stops))
    return digests, np.diff(np.r_[-1, last])


# --- looking digests up ---


def squeezed(*arrays: np.ndarray) -> bytes:
    """Whole numbers, small or close to each other, in few bytes: byte planes, compressed."""
    planes = [np.ascontiguousarray(a, "<i8").view(np.uint8).reshape(len(a), 8).T.tobytes() for a in arrays]
    body = b"".join(planes)
    return struct.pack(f"<{len(arrays)}I", *map(len, arrays)) + pa.compress(body, codec="zstd", asbytes=True)


def unsqueezed(data: bytes, count: int) -> list[np.ndarray]:
    sizes = struct.unpack_from(f"<{count}I", data)
    body = pa.decompress(data[4 * count :], 8 * sum(sizes), codec="zstd", asbytes=True)
    out, at = [], 0
    for n in sizes:
        out.append(np.frombuffer(body, np.uint8, 8 * n, at).reshape(8, n).T.copy().view("<i8").ravel())
        at += 8 * n
    return out


class Owners:
    """Documents in order: those with doc_id by it, then those without by the key of their text."""

    def __init__(self, no_id: np.ndarray, ids: np.ndarray):
        order = np.lexsort((ids, no_id))
        new = np.r_[True, (np.diff(no_id[order]) != 0) | (np.diff(ids[order]) != 0)][: len(order)]
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.cumsum(new) - 1
        self.no_id, self.ids = no_id[order][new], ids[order][new]


class Entries:
    """The different digests of a pack, sorted, and of each the first and the last document that has it."""

    def __init__(self, digests: np.ndarray, low: np.ndarray, high: np.ndarray):
        order = np.argsort(digests, kind="stable")
        sorted_ = digests[order]
        starts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]][: len(order)])
        self.digests = sorted_[starts]
        self.low, self.high = (np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts)) if len(order) else (low, high)
        self.place = np.empty(len(order), np.int64)  # entry of each digest that came in
        self.place[order] = np.repeat(np.arange(len(starts)), np.diff([*starts, len(order)]))

    def ranges(self, count: int, bits: int) -> list[tuple[int, slice]]:
        """Entries of each of ``count`` ranges of digests, those that have some."""
        range_of = ((self.digests >> np.uint64(bits - 32)) * np.uint64(count)) >> np.uint64(32)
        cuts = np.flatnonzero(np.r_[True, range_of[1:] != range_of[:-1]][: len(range_of)])
        return [(int(range_of[a]), slice(a, b)) for a, b in zip(cuts, [*cuts[1:], len(range_of)])]


def _meet(tell_first: bool):
    def meet(table: pa.Table) -> pa.Table:
        """What a range's task tells each pack: 0 for an entry no other document has, else 1 and, if asked, the first document that has it."""
        blobs = [unsqueezed(b, 5) for b in table.column("blob").to_pylist()]
        owners = Owners(np.concatenate([b[3] for b in blobs]), np.concatenate([b[4] for b in blobs]))
        base = np.cumsum([0, *[len(b[3]) for b in blobs]])
        # Digests come as differences of unsigned numbers, which wrap around alike.
        digests = np.concatenate([np.cumsum(b[0]) for b in blobs])
        entries = Entries(digests.view(np.uint64), *[np.concatenate([owners.rank[base[k] + b[c]] for k, b in enumerate(blobs)]) for c in (1, 2)])
        shared = (entries.low != entries.high)[entries.place]
        first = entries.low[entries.place]
        replies, at = [], 0
        for b in blobs:
            here = slice(at, at + len(b[0]))
            at = here.stop
            if not tell_first:
                replies.append(squeezed(shared[here], np.empty(0), np.empty(0)))
                continue
            known, code = np.unique(first[here][shared[here]], return_inverse=True)
            told = np.zeros(len(b[0]), np.int64)
            told[shared[here]] = code + 1
            replies.append(squeezed(told, owners.no_id[known], owners.ids[known]))
        return pa.table({"piece": table.column("piece"), "range": table.column("range"), "reply": pa.array(replies, pa.binary())})

    return meet


def looked_up(packs: DataFrame, entries_of: Callable, bits: int, tell_first: bool) -> DataFrame:
    """``packs`` (piece, n, others) with ``replies``: what the tasks of the ranges tell of the digests of each pack.

    ``entries_of(row)`` gives a pack's entries and owners. A range holds some
    ``RANGE`` digests, whatever the table's size, and each pack sends a digest once.
    """
    count = max(1, -(-(packs.agg(F.sum("n")).first()[0] or 0) // RANGE))
    columns = packs.columns

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches, columns):
            entries, owners = entries_of(row)
            for number, here in entries.ranges(count, bits):
                digests = entries.digests[here].view(np.int64)
                used, ranks = np.unique(np.r_[entries.low[here], entries.high[here]], return_inverse=True)
                n = len(digests)
                blob = squeezed(np.diff(digests, prepend=0), ranks[:n], ranks[n:], owners.no_id[used], owners.ids[used])
                yield pa.RecordBatch.from_pydict({"piece": pa.array([row["piece"]], pa.int64()), "range": pa.array([number], pa.int64()), "blob": [blob]})

    sent = packs.mapInArrow(send, "piece long, range long, blob binary")
    replies = sent.groupBy("range").applyInArrow(_meet(tell_first), "piece long, range long, reply binary")
    by_piece = replies.groupBy(F.col("piece").alias("_piece")).agg(F.collect_list(F.struct("range", "reply")).alias("replies"))
    # Both sides grow with the table: neither is ever broadcast.
    return packs.join(by_piece.hint("merge"), F.col("piece") == F.col("_piece")).drop("_piece")


def _told(row: dict, entries: Entries, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each digest of a pack: whether other documents have it, and of the first one that has, whether it lacks an id, and the id."""
    shared = np.zeros(len(entries.digests), bool)
    no_id, ids = np.zeros(len(shared), np.int64), np.zeros(len(shared), np.int64)
    at = 0
    for reply in sorted(row["replies"], key=lambda r: r["range"]):
        code, of_no_id, of_ids = unsqueezed(reply["reply"], 3)
        here = np.arange(at, at + len(code))
        at += len(code)
        hit = here[code > 0]
        shared[hit] = True
        if len(of_ids):
            no_id[hit], ids[hit] = of_no_id[code[code > 0] - 1], of_ids[code[code > 0] - 1]
    return shared[entries.place], no_id[entries.place], ids[entries.place]


def _rows(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(k)[i].as_py() for k, c in enumerate(columns)}


def _packed(rows: DataFrame, pack_of: Callable, columns: list[str], schema: str) -> DataFrame:
    """``rows`` in packs, stored: ``pack_of(*values)`` gives a text's digests and what else a pack keeps of it, None for nothing."""
    ship_package(rows.sparkSession)
    names = [f.name for f in StructType.fromDDL(schema)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for values in zip(*batch.columns):
                got = pack_of(*[v.as_py() for v in values])
                if got is None:
                    continue
                held.append(got)
                n += len(got[0])
                if n >= PACK:
                    yield batch_of(number, n, held)
                    number, held, n = number + 1, [], 0
        if held:
            yield batch_of(number, n, held)

    def batch_of(number: int, n: int, held: list) -> pa.RecordBatch:
        digests, *rest = zip(*held)
        fields = [np.concatenate(digests).astype("<u8").tobytes(), *rest]
        types = [pa.binary(), *[f.type for f in kept]]
        arrays = [pa.array([number], pa.int64()), pa.array([n], pa.int64())]
        arrays += [pa.array([f if k == 0 else list(f)], t) for k, (f, t) in enumerate(zip(fields, types))]
        return pa.RecordBatch.from_arrays(arrays, names=["piece", "n", "digests", *names])

    from pyspark.sql.pandas.types import to_arrow_schema

    kept = list(to_arrow_schema(StructType.fromDDL(schema)))
    return stored_copy(rows.select(*columns).mapInArrow(run, f"piece long, n long, digests binary, {schema}"), "packs")


# --- from chunks to passages ---


def _sizes(values: list[bytes], width: int) -> np.ndarray:
    return np.array([len(v) // width for v in values], np.int64)


def _chunk_pack(size: int):
    def pack(doc_id, key, text):
        digests, words = chunks(text, size)
        if not len(digests):
            return None
        return digests & np.uint64((1 << CHUNK_BITS) - 1), int(doc_id is None), key if doc_id is None else doc_id, key, words.astype("<u2").tobytes()

    return pack


def _chunk_entries(row: dict) -> tuple[Entries, Owners]:
    owners = Owners(np.array(row["no_id"], np.int64), np.array(row["id"], np.int64))
    mine = np.repeat(owners.rank, _sizes(row["words"], 2))
    return Entries(np.frombuffer(row["digests"], "<u8"), mine, mine), owners


def _regions_of(words: np.ndarray, shared: np.ndarray, size: int, passage_words: int, min_words: int) -> list[tuple[int, int]]:
    """Runs of shared neighbouring chunks with the words around them that a passage may hold, as (start, end) in words."""
    ends = np.cumsum(words)
    edges = np.flatnonzero(np.diff(np.r_[False, shared, False]))
    out: list[tuple[int, int]] = []
    for i, j in edges.reshape(-1, 2).tolist():
        first, last = int(ends[i] - words[i]), int(ends[j - 1])
        # The first common boundary is in the first window past the sixteen bytes, the last one in the last window.
        start, end = max(0, first - WINDOW_WORDS - size), min(int(ends[-1]), last + size)
        if last - first >= min_words and end - start > passage_words:
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], end)
            else:
                out.append((start, end))
    return out


def candidates(docs: DataFrame, passage_words: int = PASSAGE_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, low, high, n_words, regions), stored: of each different text where it may hold a passage, and the first and last document that has the text."""
    size = cut_words(passage_words, min_words)
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    packs = _packed(rows, _chunk_pack(size), ["doc_id", "key", "text"], "no_id array<int>, id array<long>, key array<long>, words array<binary>")
    told = looked_up(packs, _chunk_entries, CHUNK_BITS, False)
    columns = told.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches, columns):
            shared, at, out = _told(row, _chunk_entries(row)[0], CHUNK_BITS)[0], 0, []
            for no_id, id_, key, packed in zip(row["no_id"], row["id"], row["key"], row["words"]):
                words = np.frombuffer(packed, "<u2").astype(np.int64)
                found = _regions_of(words, shared[at : at + len(words)], size, passage_words, min_words)
                at += len(words)
                if found:
                    out.append((no_id, id_, key, int(words.sum()), [{"start": a, "end": b} for a, b in found]))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["no_id", "id", "key", "n_words", "regions"])

    regions = told.mapInArrow(run, "no_id int, id long, key long, n_words long, regions array<struct<start:int,end:int>>")
    place = F.struct("no_id", "id")
    texts = regions.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.first("n_words").alias("n_words"), F.first("regions").alias("regions"))
    return stored_copy(texts, "regions")


_WINDOWS = "no_id array<int>, id array<long>, last_no_id array<int>, last_id array<long>, key array<long>, starts array<binary>"


def _window_pack(passage_words: int):
    def pack(low, high, key, regions, text):
        """Digests of all windows of ``passage_words + 1`` words in the regions, in order."""
        words, digest, out, starts = (text or "").encode("utf-8", "surrogatepass").split(), xxhash.xxh3_64_intdigest, [], []
        for r in regions:
            part = words[r["start"] : r["end"]]
            joined, stops = b" ".join(part), np.cumsum([len(w) + 1 for w in part]).tolist()
            out += [digest(joined[a : b - 1]) for a, b in zip([0, *stops], stops[passage_words:])]
            starts.append(np.arange(r["start"], r["start"] + max(0, len(part) - passage_words)))
        if not out:
            return None
        return np.array(out, np.uint64), low["no_id"], low["id"], high["no_id"], high["id"], key, np.concatenate(starts).astype("<u4").tobytes()

    return pack


def _window_entries(row: dict) -> tuple[Entries, Owners]:
    owners = Owners(np.array(row["no_id"] + row["last_no_id"], np.int64), np.array(row["id"] + row["last_id"], np.int64))
    n, sizes = len(row["id"]), _sizes(row["starts"], 4)
    return Entries(np.frombuffer(row["digests"], "<u8"), np.repeat(owners.rank[:n], sizes), np.repeat(owners.rank[n:], sizes)), owners


def _spans_of(starts: np.ndarray, shared: np.ndarray, again: np.ndarray, passage_words: int, only_again: bool) -> list[dict]:
    """Passages as (start_word, n_words, removed_words): windows that overlap are one."""
    out, end, removed_to = [], -1, 0
    for k in np.flatnonzero(again if only_again else shared).tolist():
        start = int(starts[k])
        if start >= end:
            out.append({"start_word": start, "n_words": 0, "removed_words": 0})
            removed_to = start
        end = start + passage_words + 1
        out[-1]["n_words"] = end - out[-1]["start_word"]
        if again[k]:
            out[-1]["removed_words"] += end - max(start, removed_to)
            removed_to = end
    return out


def spans(docs: DataFrame, passage_words: int, min_words: int, only_again: bool) -> DataFrame:
    """(doc_id, key, spans): the passages of each text, or with ``only_again`` those that a document before has.

    Of copies only the first document's windows are looked up: any other has
    the whole text again.
    """
    texts = candidates(docs, passage_words, min_words)
    same = F.col("key") == F.col("_key")
    first = F.when(F.col("low.no_id") == 0, F.col("low.id"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_key"), "text").join(texts.hint("merge"), same & F.col("doc_id").eqNullSafe(first))
    packs = _packed(rows, _window_pack(passage_words), ["low", "high", "key", "regions", "text"], _WINDOWS)
    told = looked_up(packs, _window_entries, 64, True)
    columns = told.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches, columns):
            shared, of_no_id, of_id = _told(row, _window_entries(row)[0], 64)
            at, out = 0, []
            for no_id, id_, key, packed in zip(row["no_id"], row["id"], row["key"], row["starts"]):
                starts = np.frombuffer(packed, "<u4")
                here = slice(at, at + len(starts))
                at = here.stop
                again = shared[here] & ((of_no_id[here] != no_id) | (of_id[here] != id_))
                found = _spans_of(starts, shared[here], again, passage_words, only_again)
                if found:
                    out.append((None if no_id else id_, key, found))
            span = pa.list_(pa.struct([("start_word", pa.int64()), ("n_words", pa.int64()), ("removed_words", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), span))], names=["doc_id", "key", "spans"])

    schema = "doc_id long, key long, spans array<struct<start_word:long,n_words:long,removed_words:long>>"
    of_first = told.mapInArrow(run, schema).dropDuplicates(["doc_id", "key"])
    again = texts.where((F.col("low") != F.col("high")) & (F.col("n_words") > passage_words)).select("key", "n_words", first.alias("first"))
    copies = docs.select("doc_id", F.xxhash64("text").alias("_key")).join(sent_if_small(again, MAX_SENT), same & ~F.col("doc_id").eqNullSafe(F.col("first")))
    copies = copies.select("doc_id", "key", "n_words").distinct()
    whole = F.struct(F.lit(0).cast("long").alias("start_word"), "n_words", F.col("n_words").alias("removed_words"))
    return of_first.unionByName(copies.select("doc_id", "key", F.array(whole).alias("spans")))


def repeated_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of more than ``passage_words`` words of ``docs`` (doc_id, text, any others) that occur in other documents too.

    doc_id, start_word (from 0), n_words, removed_words (those in passages that
    a document before has already: one with a smaller doc_id, or any with a
    doc_id for those without). One row per passage and document, the first
    document included; passages that overlap are told as one. ``min_words`` words
    of shared chunks make a candidate, which is then looked up window by
    window, told apart by 64-bit digests. Nothing is found in NULL and empty
    texts and in an empty table. Rows that repeat a doc_id do not count as other
    documents, and rows that are the same are told once; of rows without
    doc_id, each different text is a document.
    """
    return spans(docs, passage_words, min_words, False).select("doc_id", F.inline("spans"))


def remove_repeats(docs: DataFrame, passage_words: int = PASSAGE_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and the text left of each row of ``docs`` (doc_id, text, any others), with passages cut that a document before has.

    Texts that lose words are joined by one space, others stay as they are, NULL
    and empty ones too. Rows that repeat stay, each cut alike; an empty table
    stays empty.
    """
    cut = spans(docs, passage_words, min_words, True).withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    rows = rows.join(cut, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return each_text(rows, _without, ["doc_id", "text", "spans"], "doc_id long, text string")


def _without(doc_id, text, spans):
    if not spans:
        return doc_id, text
    words = (text or "").encode("utf-8", "surrogatepass").split()
    for s in spans:
        words[s["start_word"] : s["start_word"] + s["n_words"]] = [b""] * s["n_words"]
    return doc_id, b" ".join(w for w in words if w).decode("utf-8", "surrogatepass")
