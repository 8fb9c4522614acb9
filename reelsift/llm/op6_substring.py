"""Substring dedup: words inside any window of words that starts more than once are removed.

Sampled window hashes (the least hash of the 8-word pieces in a window) of all texts go, batch by batch, into a
``FingerprintLog``, whose merge join with its history tells which are repeated. Windows with equal words have equal
samples, so only windows with such a sample can repeat; they are verified by two hashes of all their words, 128 bits,
among those with the same sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelsift.llm.fingerprint_log import FingerprintLog, bitmap, in_bitmap
from reelsift.llm.words import BLANKS, as_bytes, in_batches, inside, mix, moving, named, slices, tokens, unused, window_hashes

WIDTH = 35
PIECE = 8
BITS = 26
#: More text at once than usual, as equal windows of one slice are settled there.
SLICE = 3 << 20


def _samples(counts: np.ndarray, ids: np.ndarray, width: int, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all pieces, the least in each window (0 where a window spans texts), and whether a piece is one."""
    pieces = window_hashes(ids, piece)
    if len(ids) < width:
        return pieces, np.zeros(0, np.uint64), np.zeros(len(pieces), bool)
    least = np.where(inside(counts, width), moving(pieces, width - piece + 1, np.minimum), np.uint64(0))
    edge = np.zeros(width - piece, np.uint64)
    return pieces, least, pieces == moving(np.concatenate([edge, least, edge]), width - piece + 1, np.maximum)


def _sample_batches(batches: Iterator[pa.RecordBatch], width: int, piece: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column(0))
        for a, b in slices(texts):
            found = tokens(texts[a:b], BLANKS)
            pieces, _, used = _samples(found.counts, found.ids, width, piece)
            values, n = np.unique(pieces[used], return_counts=True)
            yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["fp", "n"])


_ROWS = "sample long, k1 long, k2 long, spans array<long>, fps array<long>, also array<long>, ns array<byte>"


def _window_batches(batches: Iterator[pa.RecordBatch], width: int, piece: int, repeated) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, k1, k2 = as_bytes(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for a, b in slices(texts, SLICE):
            if (rows := _windows(texts[a:b], k1[a:b], k2[a:b], width, piece, repeated.value)) is not None:
                yield rows


def _windows(texts, k1, k2, width: int, piece: int, words: np.ndarray) -> pa.RecordBatch | None:
    """Windows that may repeat, those of a text with one sample in one row.

    A window that this slice repeats is settled: its run is one entry with a hash of its own and n = 2, and only its
    first occurrence stands for it among the others. So no window comes more than once from a slice, however common.
    """
    found = tokens(texts, BLANKS)
    _, least, _ = _samples(found.counts, found.ids, width, piece)
    at = np.flatnonzero((least != 0) & in_bitmap(least, words, BITS))
    if not len(at):
        return None
    fps, also = window_hashes(found.ids, width)[at], window_hashes(mix(found.ids), width)[at]
    _, first, back, n = np.unique(fps, return_index=True, return_inverse=True, return_counts=True)
    again = n[back] > 1
    text = np.searchsorted(np.cumsum(found.counts), at, side="right")
    begin = np.cumsum(found.counts) - found.counts
    pos = at - begin[text]
    lone = np.zeros(len(at), bool)
    lone[first] = True
    # runs of settled windows
    run = again & ~np.concatenate([[False], again[:-1] & (np.diff(at) == 1) & (np.diff(text) == 0)])
    run_at = np.flatnonzero(run)
    run_of = np.cumsum(run)[again] - 1
    run_len = np.bincount(run_of, minlength=len(run_at)) if len(run_at) else np.zeros(0, np.int64)
    one = np.flatnonzero(lone)
    entry_text = np.concatenate([text[one], text[run_at]])
    sample = np.concatenate([least[at[one]], fps[run_at] ^ (pos[run_at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))])
    span = np.concatenate([pos[one] << 32 | 1, pos[run_at] << 32 | run_len]).astype(np.int64)
    fp, other = np.concatenate([fps[one], sample[len(one) :]]), np.concatenate([also[one], sample[len(one) :]])
    two = np.concatenate([np.where(n[back[one]] > 1, 2, 1), np.full(len(run_at), 2)]).astype(np.int8)
    order = np.lexsort([span, sample, entry_text])
    entry_text, sample, span, fp, other, two = (x[order] for x in (entry_text, sample, span, fp, other, two))
    new = np.flatnonzero(np.concatenate([[True], (np.diff(entry_text) != 0) | (sample[1:] != sample[:-1])]))
    offsets = pa.array(np.append(new, len(span)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (span, fp.view(np.int64), other.view(np.int64), two)]
    keys = [pa.array(sample[new].view(np.int64)), pa.array(k1[entry_text[new]]), pa.array(k2[entry_text[new]])]
    return pa.record_batch([*keys, *lists], names=["sample", "k1", "k2", "spans", "fps", "also", "ns"])


def _kept_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Replaces the last three columns (text, spans) by n_words, n_removed, kept."""
    for batch in batches:
        texts, spans = as_bytes(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1)
        others = batch.select(range(batch.num_columns - 2))
        for a, b in slices(texts):
            total, gone, kept = [], [], []
            for i in range(a, b):
                own = (texts[i] or b"").split()
                total.append(len(own))
                if own and spans[i].is_valid:
                    span = spans[i].values.to_numpy()
                    begin, length = span >> 32, span & 0xFFFFFFFF
                    step = np.zeros(len(own) + 1, np.int64)
                    np.add.at(step, begin, 1)
                    np.add.at(step, np.minimum(begin + length + width - 1, len(own)), -1)
                    stay = np.cumsum(step[:-1]) == 0
                    own = [own[j] for j in np.flatnonzero(stay)]
                gone.append(total[-1] - len(own))
                kept.append(b" ".join(own))
            made = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            part = others.slice(a, b - a)
            yield pa.record_batch([*part.columns, *made], names=[*part.schema.names, "n_words", "n_removed", "kept"])


def repeated_samples(docs: DataFrame, log: FingerprintLog, text: str = "text", width: int = WIDTH, piece: int = PIECE, batches: int = 3) -> DataFrame:
    """``fp`` of all sampled window hashes of the texts that are repeated, among them or in the log, to which they are added in batches."""
    out = None
    for i in range(batches):
        batch = docs.where(F.pmod(F.xxhash64(text), F.lit(batches)) == i).select(text)
        new = log.add(in_batches(batch, lambda it: _sample_batches(it, width, piece), "fp long, n int"))
        out = new if out is None else out.unionByName(new)
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, batches: int = 3) -> DataFrame:
    """All rows and columns of ``docs`` and n_words, n_removed (long) and kept (string; the words left, joined by a blank).

    Words are runs outside x20 and x09-x0D. A word goes if any window over it starts more than once in the input, in
    the same text or another. Null and empty texts have no words and keep "". A text of fewer than ``width`` words
    loses none. Repeated rows are copies of each other, so windows in them repeat; rows that also share ``key`` get the
    same result. A null key counts as a key. Columns named n_words, n_removed or kept are replaced; others
    may have any names. An empty table gives an empty table.
    """
    spark: SparkSession = docs.sparkSession
    own = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    schema = StructType([*(docs.schema[c] for c in own), *StructType.fromDDL("n_words long, n_removed long, kept string").fields])
    docs = docs.select(F.struct(*[named(c) for c in own]).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    piece = min(PIECE, width)
    log = FingerprintLog(spark)
    repeated = spark.sparkContext.broadcast(bitmap(repeated_samples(docs, log, "text", width, piece, batches), BITS))
    k1, k2 = F.coalesce(F.xxhash64("key"), F.lit(0)).alias("k1"), F.xxhash64("text", F.lit(7)).alias("k2")
    rows = in_batches(docs.select("text", k1, k2), lambda it: _window_batches(it, width, piece, repeated), _ROWS)
    # one exchange by sample serves the window below, whose partitions are parts of it
    each = rows.repartition("sample").select("sample", "k1", "k2", F.explode(F.arrays_zip("spans", "fps", "also", "ns")).alias("w"))
    each = each.select("sample", "k1", "k2", F.col("w.spans").alias("span"), F.col("w.fps").alias("fp"), F.col("w.also").alias("also"), F.col("w.ns").alias("n"))
    again = each.withColumn("n", F.sum("n").over(Window.partitionBy("sample", "fp", "also"))).where("n >= 2")
    spans = again.groupBy("k1", "k2").agg(F.collect_list("span").alias("_spans"))
    whole = docs.select("row", "text", k1.alias("_k1"), k2.alias("_k2")).join(spans, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left")
    said, gone = unused(own, "_text", "_spans")
    out = whole.select(*[F.col("row").getField(c).alias(c) for c in own], F.col("text").alias(said), F.col("_spans").alias(gone))
    return in_batches(out, lambda it: _kept_batches(it, width), schema)
