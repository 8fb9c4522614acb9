"""Token ids in fixed-width bits: whole texts are encoded in key order, packed in blocks, and read back with NumPy.

A file image is, little-endian: magic (4 bytes), bits per id and flags (2 x uint16), ids in a block (uint32), number of
ids, documents and blocks (3 x uint64); where the documents' keys are and their lengths (int64 key, int64 number of ids,
uint8 null mark, each an array); the byte offset of each block in the packed part and its end (uint64); the packed ids.
Images lie as rows (part, seq, n_ids, image) in a Parquet table, so any store that Spark writes to can hold them and a
lost executor's half-written files are never seen. ``part`` and ``seq`` give their order.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelsift.llm.words import in_batches, mix, slices
from reelsift.shared import scratch_path, written

MAGIC = b"RSTB"
HEAD = struct.Struct("<4sHHIQQQ")
BLOCK_IDS = 8192
#: Ids in a file image, besides what the last document adds.
IMAGE_IDS = 1 << 20


def bits_for(vocabulary: int) -> int:
    """The least number of bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)]).astype(np.uint64)
    place = np.arange(n, dtype=np.int64) * bits
    byte, value = place >> 3, np.zeros(n, np.uint64)
    for k in range((bits + 14) // 8):
        value |= raw[byte + k] << np.uint64(8 * k)
    return ((value >> (place & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def image(keys: list[int | None], lengths: list[int], ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """A file image of documents and all their ids."""
    blocks = [pack(ids[i : i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    head = HEAD.pack(MAGIC, bits, 0, block_ids, len(ids), len(keys), len(blocks))
    null = np.array([k is None for k in keys], np.uint8)
    arrays = [np.array([k or 0 for k in keys], "<i8"), np.array(lengths, "<i8"), null, np.cumsum([0, *map(len, blocks)]).astype("<u8")]
    return b"".join([head, *(x.tobytes() for x in arrays), *blocks])


class TokenImage:
    """Reads a file image: ``ids(start, stop)`` unpacks only the blocks that hold these ids."""

    def __init__(self, data: bytes):
        magic, self.bits, _, self.block_ids, self.n_ids, n_docs, n_blocks = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD.size
        self.keys = np.frombuffer(data, "<i8", n_docs, at)
        self.lengths = np.frombuffer(data, "<i8", n_docs, at + 8 * n_docs)
        self.null = np.frombuffer(data, np.uint8, n_docs, at + 16 * n_docs) != 0
        at += 17 * n_docs
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.packed = memoryview(data)[at + 8 * (n_blocks + 1) :]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        some = [unpack(self.packed[self.offsets[i] : self.offsets[i + 1]], min(self.block_ids, self.n_ids - i * self.block_ids), self.bits) for i in range(first, last + 1)]
        return np.concatenate(some)[start - first * self.block_ids : stop - first * self.block_ids]


#: White space outside ASCII and separators: texts with them are encoded whole.
_RARE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BYTE = np.arange(256)
_BLANK = ((_BYTE >= 9) & (_BYTE <= 13)) | (_BYTE == 32)
_LETTER = ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
_NO_LETTER = ~_LETTER & (_BYTE < 128)
#: The low bytes of a number that a piece of so many bytes fills.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Pieces:
    """Ids of pieces of at most 16 bytes: an open hash table in arrays, keyed by all bytes of a piece, so exact.

    A piece is its length, first 8 and last 8 bytes. The table takes 40 bytes a slot, whatever the corpus; once half full
    it starts anew.
    """

    def __init__(self, slots: int = 1 << 21):
        self.slots = slots
        self.clear()

    def clear(self) -> None:
        self.head, self.tail = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint64)
        self.length, self.start, self.count = np.zeros(self.slots, np.uint8), np.zeros(self.slots, np.int64), np.zeros(self.slots, np.int32)
        self.ids, self.used, self.n = np.empty(self.slots, np.uint32), 0, 0

    def find(self, head: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The slot of each piece, or of the free slot it would take as -1 - slot."""
        slot = (mix(head ^ mix(tail + length)) & np.uint64(self.slots - 1)).astype(np.int64)
        left = np.arange(len(slot))
        while len(left):
            at = slot[left]
            free = self.length[at] == 0
            same = (self.head[at] == head[left]) & (self.tail[at] == tail[left]) & (self.length[at] == length[left])
            slot[left[free]] = -1 - at[free]
            left = left[~free & ~same]
            slot[left] = (slot[left] + 1) & (self.slots - 1)
        return slot

    def add(self, head: np.ndarray, tail: np.ndarray, length: np.ndarray, found: list[list[int]]) -> None:
        """Adds distinct pieces that are not there yet."""
        counts = np.fromiter(map(len, found), np.int32, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(max(len(ids), self.used), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(counts) - counts
        self.used, self.n = self.used + len(ids), self.n + len(found)
        left = np.arange(len(found))
        while len(left):
            at = -1 - self.find(head[left], tail[left], length[left])
            _, one = np.unique(at, return_index=True)  # of pieces that want one slot the first gets it
            own, at = left[one], at[one]
            self.head[at], self.tail[at], self.length[at] = head[own], tail[own], length[own]
            self.start[at], self.count[at] = starts[own], counts[own]
            left = np.delete(left, one)


class Encoder:
    """Ids of whole texts from a tokenizers file.

    A byte-level tokenizer that adds no blank splits a text before blanks and between letters and other characters before
    it merges bytes, so a text's ids are those of its pieces: cut before each run of blanks, and after an ASCII letter
    before another ASCII character. The library encodes a piece once while the table remembers it, and each piece over
    16 bytes once in a slice. Texts with white space outside ASCII or with a special string, and all texts of other
    tokenizers, are encoded whole.
    """

    #: Pieces or whole texts given to the library at once.
    BATCH = 4096

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        self.library = Tokenizer.from_file(path)
        file = json.loads(self.library.to_str())
        before = file.get("pre_tokenizer") or {}
        self.cuts = not file.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.special = [x["content"] for x in file.get("added_tokens", [])]
        self.known = Pieces()

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        return [x.ids for i in range(0, len(pieces), self.BATCH) for x in self.library.encode_batch_fast(pieces[i : i + self.BATCH], add_special_tokens=False)]

    def encode(self, texts: list[str], end: int) -> Iterator[np.ndarray]:
        """The ids of each text and the end id."""
        whole = [not self.cuts or bool(_RARE.search(x)) or any(y in x for y in self.special) for x in texts]
        cut = iter(self._by_pieces([x.encode() for x, w in zip(texts, whole, strict=True) if not w]))
        for text, w in zip(texts, whole, strict=True):
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32) if w else next(cut)
            yield np.append(ids, np.uint32(end))

    def _by_pieces(self, texts: list[bytes]) -> list[np.ndarray]:
        data = b"".join(texts)
        size = len(data)
        if not size:
            return [np.empty(0, np.uint32)] * len(texts)
        raw = np.frombuffer(data, np.uint8)
        begin = np.cumsum([0, *map(len, texts)])
        blank, first = _BLANK[raw], np.zeros(size, bool)
        first[1:] = (blank[1:] & ~blank[:-1]) | (_LETTER[raw[:-1]] & _NO_LETTER[raw[1:]])
        first[begin[:-1][begin[:-1] < size]] = True
        starts = np.flatnonzero(first)
        stops = np.append(starts[1:], size)
        lengths = stops - starts
        padded = bytes(8) + data + bytes(8)
        eight = np.ndarray((size + 9,), "<u8", padded, strides=(1,))
        head = eight[starts + 8] & _MASK[np.minimum(lengths, 8)]
        tail = np.where(lengths > 8, eight[stops], np.uint64(0))
        short = np.flatnonzero(lengths <= 16)
        head, tail, length = head[short], tail[short], lengths[short].astype(np.uint64)
        if self.known.n * 2 > self.known.slots:
            self.known.clear()
        slot = self.known.find(head, tail, length)
        new = np.flatnonzero(slot < 0)
        if len(new):
            _, one = np.unique(np.stack([head[new], tail[new], length[new]], 1).view("V24").ravel(), return_index=True)
            own = new[one]
            while self.known.n + len(own) > self.known.slots * 3 // 4:  # only by a slice of very many new pieces
                self.known = Pieces(self.known.slots * 2)
                slot = np.full(len(short), -1)
                new, own = np.arange(len(short)), np.unique(np.stack([head, tail, length], 1).view("V24").ravel(), return_index=True)[1]
            pieces = [data[s:e].decode() for s, e in zip(starts[short[own]].tolist(), stops[short[own]].tolist(), strict=True)]
            self.known.add(head[own], tail[own], length[own], self._ids(pieces))
            slot[new] = self.known.find(head[new], tail[new], length[new])
        at, counts = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        at[short], counts[short] = self.known.start[slot], self.known.count[slot]
        ids = self.known.ids[: self.known.used]
        long = np.flatnonzero(lengths > 16)
        if len(long):
            pieces = [data[s:e].decode() for s, e in zip(starts[long].tolist(), stops[long].tolist(), strict=True)]
            index: dict[str, int] = {}
            place = np.array([index.setdefault(x, len(index)) for x in pieces])
            found = self._ids([*index])
            many = np.fromiter(map(len, found), np.int64, len(found))
            at[long], counts[long] = (len(ids) + np.cumsum(many) - many)[place], many[place]
            extra = np.fromiter(chain.from_iterable(found), np.uint32, int(many.sum()))
        else:
            extra = np.empty(0, np.uint32)
        before = np.cumsum(counts) - counts
        where = np.repeat(at - before, counts) + np.arange(int(counts.sum()))
        if len(extra):
            out = np.where(where < len(ids), ids[np.minimum(where, len(ids) - 1)] if len(ids) else np.uint32(0), extra[np.maximum(where - len(ids), 0)])
        else:
            out = ids[where]
        # where each text's ids end
        ends = np.append(before, len(out))[np.searchsorted(starts, begin[1:])]
        return np.split(out, ends[:-1]) if len(texts) > 1 else [out]


_loaded: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _encode(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    bits, part, seq = bits_for(encoder.library.get_vocab_size()), TaskContext.get().partitionId(), 0
    keys: list[int | None] = []
    lengths: list[int] = []
    held: list[np.ndarray] = []
    n = 0

    def row() -> pa.RecordBatch:
        data = image(keys, lengths, np.concatenate(held), bits)
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([n], pa.int64()), pa.array([data], pa.binary())], names=["part", "seq", "n_ids", "image"])

    for batch in batches:
        own_keys, lengths_of = batch.column(0).to_pylist(), pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        for a, b in slices(lengths_of):
            texts = [x or "" for x in batch.column(1).slice(a, b - a).to_pylist()]
            for key, ids in zip(own_keys[a:b], encoder.encode(texts, end), strict=True):
                keys.append(key)
                lengths.append(len(ids))
                held.append(ids)
                n += len(ids)
                if n >= IMAGE_IDS:
                    yield row()
                    keys, lengths, held, n, seq = [], [], [], 0, seq + 1
    if keys:
        yield row()


def write_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, end: int = 0) -> None:
    """Writes the ids of all texts in ascending ``key`` order (null first, then repeated keys in any order) to ``path``.

    Null and empty texts have the end id alone. Special strings in a text are encoded as the tokenizer's file says.
    ``tokenizer`` is the path of a tokenizers file that all executors have. Nothing is written for an empty table but an
    empty table. Other columns are not kept.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first())
    in_batches(rows, lambda it: _encode(it, tokenizer, end), "part int, seq int, n_ids long, image binary").write.parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, start in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = TokenImage(data.as_py())
            ids, begin = found.ids().astype("<u4"), np.cumsum(found.lengths) - found.lengths
            crc = [zlib.crc32(ids[s : s + n]) for s, n in zip(begin, found.lengths, strict=True)]
            yield pa.record_batch(
                [pa.array(found.keys, pa.int64(), mask=found.null), pa.array(begin + start, pa.int64()), pa.array(found.lengths, pa.int64()), pa.array(crc, pa.int64())],
                names=["key", "start", "n_tokens", "ids_crc32"],
            )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """For each document of the files: key, start (ids of all documents before it), n_tokens, ids_crc32 (all long)."""
    files = spark.read.schema("part int, seq int, n_ids long, image binary").parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    along = Window.partitionBy("part").orderBy("seq")
    starts = files.select("part", "seq", "n_ids").withColumn("inner", F.sum("n_ids").over(along) - F.col("n_ids"))
    starts = starts.join(parts, F.col("part") == F.col("p")).select(F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("inner") + F.col("base")).alias("start"))
    starts = written(starts, "starts")
    rows = files.join(starts, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s"))).select("image", "start")
    return in_batches(rows, _decode, "key long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, key, text, tokenizer)
    return read_index(docs.sparkSession, path).withColumnRenamed("key", key)
